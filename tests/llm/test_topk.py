import numpy as np
import pytest
from pyspark.sql import functions as F

from touchstone.llm.topk import build, top_inner_products

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, asks):
    usable = {(i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for q, a in usable:
        if asks(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), c) for c, b in usable if c != q and len(a) == len(b))
            out |= {(q, rank, c, -s) for rank, (s, c) in enumerate(scored[:k], 1)}
    return out


def rows_of(frame):
    got = [tuple(r) for r in frame.select("query_id", "rank", "vec_id", "score").collect()]
    assert len(got) == len(set(got))
    return set(got)


def vectors(n, width=8, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, width)], 1) for i in range(n)]
    same = rows[min(7, n - 1)][1]
    return [(i, same if i % 3 == 0 else v, label) for i, v, label in rows]


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 16, "block_queries": 2}])
def test_matches_brute_force(spark, sizes):
    rows = vectors(300) + [
        (1000, None, 1), (1050, [None] * 8, 1), (1100, [float("nan")] * 8, 1), (1150, [float("inf")] + [0.0] * 7, 1),
        (None, [0.5] * 8, 1), (2000, [1.0, 2.0], 1), (2050, [0.5, -1.0], 1), (3000, [], 1), (3001, [], 2), (2050, [0.5, -1.0], 9),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "v": F.lit(1), "shard": F.lit(0)})
    found = top_inner_products(frame, F.col("vec_id") % 50 == 0, 5, **sizes)
    assert rows_of(found) == brute(rows, 5, lambda i: i % 50 == 0)


def test_few_rows_and_none(spark):
    rows = vectors(3)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(top_inner_products(frame, F.col("vec_id") == 0, 5)) == brute(rows, 5, lambda i: i == 0)
    assert top_inner_products(frame.limit(0), F.col("vec_id") == 0, 5).count() == 0
    assert top_inner_products(frame.limit(1), F.col("vec_id") == 0, 5).count() == 0


def test_large_components(spark):
    rows = [(i, [float(2.0**20 * (i + 1)), float(-(2.0**19))], 1) for i in range(6)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(top_inner_products(frame, F.col("vec_id") == 0, 2)) == brute(rows, 2, lambda i: i == 0)


def test_balls_hold_their_points():
    points = np.random.default_rng(1).normal(size=(500, 6))
    order = np.arange(500)
    stack = [build(points, order, 0, 500, 16)]
    leaves = 0
    while stack:
        node = stack.pop()
        assert np.sqrt(np.square(points[order[node.low : node.high]] - node.center).sum(axis=1)).max() <= node.radius + 1e-9
        stack += node.children or ()
        leaves += node.children is None
    assert sorted(order) == list(range(500)) and leaves >= 500 // 16
