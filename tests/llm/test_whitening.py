import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchstone.llm.queries import op12_whitening
from touchstone.llm.whitening import bit_planes, covariance, cross_products, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, scale=1024, offset=0, most=8):
    """{length: (n, {place: (deviation, whitened)}, explained)} by Python integers and a plain covariance."""
    usable = [(i, [int(np.floor(scale * float(np.float32(x)))) + offset for x in v]) for i, (_, v, _) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for width in {len(v) for _, v in usable}:
        own = [(i, v) for i, v in usable if len(v) == width]
        n, total = len(own), [sum(v[k] for _, v in own) for k in range(width)]
        centred = {i: [n * x - s for x, s in zip(v, total, strict=True)] for i, v in own}
        matrix = np.array([[float(x) / n for x in c] for c in centred.values()])
        values, vectors = np.linalg.eigh(matrix.T @ matrix / n)
        values, vectors = values[::-1], vectors[:, ::-1]
        kept = int((values[:most] > 1e-9 * max(values[0], 0)).sum()) if values[0] > 0 else 0
        w = matrix @ vectors[:, :kept] / np.sqrt(values[:kept])
        out[width] = (n, {i: (sum(x * x for x in c), w[k]) for k, (i, c) in enumerate(centred.items())}, values[:kept] / values.sum() if kept else [])
    return out


def check(frame, rows, **options):
    """``frame`` holds ``rows``, ids being places; compares all columns, either sign of a component."""
    got = whiten(frame, **options).collect()
    assert len({(r["vec_id"], r["component"]) for r in got}) == len(got)
    seen = 0
    for n, own, explained in plain(rows, options.get("scale", 1024), options.get("offset", 0), options.get("components", 8)).values():
        for k in range(len(explained)):
            mine = {r["vec_id"]: r for r in got if r["component"] == k + 1 and r["vec_id"] in own}
            assert mine.keys() == own.keys()
            a = np.array([mine[i]["whitened"] for i in own])
            b = np.array([own[i][1][k] for i in own])
            assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
            for i, r in mine.items():
                assert r["n"] == n and r["deviation"] == own[i][0] and r["identity_error"] < 1e-9
                assert abs(r["explained"] - explained[k]) < 1e-9
            seen += len(mine)
    assert seen == len(got)
    return got


def spread_rows(n, width=12, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(0, 1, (n, width)) * np.linspace(0.1, 2, width)
    return [(i, [float(x) for x in v], 1) for i, v in enumerate(base)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 150), st.integers(1, 5), st.integers(0, 40), st.integers(0, 2**31))
def test_cross_products_are_exact(rows, width, bits, seed):
    values = np.random.default_rng(seed).integers(0, 1 << bits, (rows, width))
    planes = np.array([max(int(v).bit_length() for v in column) for column in values.T])
    got = cross_products(values, planes)
    big = values.astype(object)
    for i in range(width):
        for j in range(i, width):
            assert got[i, j] == (big[:, i] * big[:, j]).sum()


def test_planes_pack_rows_into_words():
    values = np.zeros((70, 2), np.int64)
    values[0], values[64], values[69] = (3, 0), (1, 0), (2, 0)
    assert bit_planes(values, np.array([2, 0])).tolist() == [[1, 1], [1, 1 << 5]]


def test_centring_does_not_cancel():
    # Values far from 0 with a spread of 1: in doubles E[xx] - E[x]E[x] would be lost.
    far = 1 << 40
    x = [far, far + 1, far, far + 1]
    got = covariance(4, [sum(x)], {(0, 0): sum(v * v for v in x)})
    assert got[0, 0] == 0.25


def test_matches_plain_version(spark):
    rows = spread_rows(300)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    check(frame, rows, offset=100_000)
    check(frame, rows, components=3, block_rows=17)


def test_awkward_rows(spark):
    rows = spread_rows(40, 5) + spread_rows(9, 3, 2)
    rows += [(0, None, 1), (0, [], 1), (0, [None] * 5, 1), (0, [float("nan")] + [0.0] * 4, 1), (0, [float("-inf")] * 3, 1)]
    rows += [rows[3], rows[3], rows[4]]
    rows = [(i, v, label) for i, (_, v, label) in enumerate(rows)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit("x"), "width": F.lit(1), "v": F.lit(2), "w": F.lit(3)})
    check(frame, rows)


def test_null_and_repeated_ids_stay(spark):
    rows = [(None, v, 1) if i % 5 == 0 else (7, v, 1) for i, v, _ in spread_rows(30, 4)]
    got = whiten(spark.createDataFrame(rows, SCHEMA)).groupBy("vec_id").count().collect()
    assert {r["vec_id"]: r["count"] for r in got} == {None: 24, 7: 96}


def test_no_variance(spark):
    same = [(i, [0.5, 0.25, -1.0], 1) for i in range(4)]
    assert whiten(spark.createDataFrame(same, SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame(same[:1], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    line = [(i, [float(i), 2.0 * i, 1.0], 1) for i in range(5)]  # one direction only
    assert {r["component"] for r in check(spark.createDataFrame(line, SCHEMA), line)} == {1}


def test_large_values_and_their_bound(spark):
    rows = [(i, [float(2**28 * (i % 7)), float(i)], 1) for i in range(50)]
    check(spark.createDataFrame(rows, SCHEMA), rows, components=1)
    over = spark.createDataFrame([(1, [float(2**35), 0.0], 1)], SCHEMA)
    with pytest.raises(Exception, match="not below"):
        whiten(over).count()


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    got = op12_whitening(spark, folder)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    (n, own, explained), = plain(rows, offset=100_000).values()
    w = {(r["vec_id"], r["component"]): r for r in got.collect()}
    assert len(w) == 8 * len(rows)
    for k in range(8):
        a = np.array([w[rows[i][0], k + 1]["whitened"] for i in own])
        b = np.array([own[i][1][k] for i in own])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
    for i in own:
        r = w[rows[i][0], 1]
        assert r["deviation"] == own[i][0] and r["n"] == n and r["identity_error"] < 1e-9 and abs(r["explained"] - explained[0]) < 1e-9
