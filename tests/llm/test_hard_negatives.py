import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchstone.llm.hard_negatives import Shard, mine_hard_negatives, score_window, top_bound, window_bound
from touchstone.llm.queries import op13_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"
OPTIONS = {"positives": 5, "negatives": 3, "low_percent": 50, "high_percent": 95}


def brute(rows, asks, positives=5, negatives=3, low_percent=50, high_percent=95):
    """[(id, vector, label)] -> the mined rows; every score is computed."""
    usable = {
        (i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v), label)
        for i, v, label in rows
        if None not in (i, v, label) and v and all(x is not None and np.isfinite(x) for x in v)
    }
    out = []
    for q, a, own in usable:
        if not asks(q):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), c, label) for c, b, label in usable if c != q and len(a) == len(b))
        for score, positive, _ in [s for s in scored if s[2] == own][:positives]:
            p = -score
            inside = [(c, -s) for s, c, label in scored if label != own and low_percent * p <= -100 * s <= high_percent * p]
            out += [(q, positive, rank, c, p, s) for rank, (c, s) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def mined(frame):
    return sorted(tuple(r) for r in frame.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(n, width=8, seed=3, labels=4):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(0.1, 0.3, width)], int(rng.integers(0, labels))) for i in range(n)]
    same = rows[min(7, n - 1)][1]
    return [(i, same if i % 6 == 0 else v, label) for i, v, label in rows]


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60), st.integers(1, 20), st.integers(1, 9), st.integers(1, 4), st.integers(0, 2**31))
def test_scans_keep_what_counts(rows, width, step, k, seed):
    rng = np.random.default_rng(seed)
    values, anchor = rng.integers(-9, 10, (rows, width)), rng.integers(-9, 10, width)
    shard = Shard(values, rng.permutation(rows), np.zeros(rows, int), 9)
    exact = values @ anchor
    order = sorted(range(rows), key=lambda r: (-exact[r], shard.ids[r]))
    found, score = shard.scan(anchor, np.arange(rows), top_bound(k), step)
    assert (score == exact[found]).all()
    assert [found[i] for i in shard.best(found, score, k)] == order[:k]
    windows = [(-20, 5), (0, 30), (100, 90)]
    found, score = shard.scan(anchor, np.arange(rows), window_bound(windows, k), step)
    assert (score == exact[found]).all()
    for low, high in windows:
        inside = np.flatnonzero((score >= low) & (score <= high))
        got = [found[inside[i]] for i in shard.best(found[inside], score[inside], k)]
        assert got == [r for r in order if low <= exact[r] <= high][:k]


def test_dimensions_are_read_for_fewer_and_fewer_rows():
    # One long component decides; after it, few candidates are left.
    values = np.random.default_rng(4).integers(-3, 4, (2000, 32))
    values[:, 5] = np.arange(2000)
    shard, anchor, left = Shard(values, np.arange(2000), np.zeros(2000, int), 1000), np.ones(32, int), []
    anchor[5] = 1000
    inner = top_bound(3)

    def prune(least, most):
        left.append(len(least))
        return inner(least, most)

    found, score = shard.scan(anchor, np.arange(2000), prune, 4)
    assert list(found[shard.best(found, score, 3)]) == [1999, 1998, 1997]
    assert left[0] == 2000 and left[1] == 2000 and left[2] < 10


@given(st.integers(-1000, 1000), st.integers(-1000, 1000))
def test_windows_are_whole_scores(p, s):
    low, high = score_window(p, 50, 95)
    assert (50 * p <= 100 * s <= 95 * p) == (low <= s <= high)


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 16, "block_anchors": 2}])
def test_matches_brute_force(spark, sizes):
    rows = vectors(300) + [
        (1000, None, 1), (1050, [None] * 8, 1), (1100, [float("nan")] * 8, 1), (1150, [float("inf")] + [0.0] * 7, 1),
        (None, [0.5] * 8, 1), (1200, [0.5] * 8, None), (2000, [1.0, 2.0], 1), (2050, [0.5, 1.0], 1), (2051, [0.4, 1.0], 2),
        (3000, [], 1), (3001, [], 2), (300, [0.25] * 8, 1), (300, [0.25] * 8, 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "v": F.lit(1), "piece": F.lit(0), "place": F.lit(9)})
    want = brute(rows, lambda i: i % 50 == 0)
    assert mined(mine_hard_negatives(frame, F.col("vec_id") % 50 == 0, **sizes)) == want
    assert len(want) > 30


def test_a_label_on_most_rows(spark):
    rows = [(i, v, 0 if i % 3 else label) for i, v, label in vectors(240)]
    found = mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, shard_rows=20)
    assert mined(found) == brute(rows, lambda i: i % 20 == 0)


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = vectors(60)
    rows += [(i, rows[(i + 13) % 60][1], 3 - label) for i, _, label in rows[:25]]
    found = mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, positives=3, negatives=2)
    want = brute(rows, lambda i: i % 10 == 0, 3, 2)
    assert mined(found) == want and want


def test_few_rows_and_none(spark):
    rows = vectors(4, labels=2)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert mined(mine_hard_negatives(frame, F.col("vec_id") == 0)) == brute(rows, lambda i: i == 0)
    assert mined(mine_hard_negatives(frame, F.col("vec_id") == 99)) == []
    assert mined(mine_hard_negatives(frame.limit(0), F.col("vec_id") == 0)) == []


def test_large_components(spark):
    rows = [(i, [float(2.0**18 * (i + 1)), float(2.0**17)], i % 2) for i in range(9)]
    found = mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 6)
    want = brute(rows, lambda i: i == 6)
    assert mined(found) == want and want


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = mined(op13_hard_negatives(spark, folder))
    assert got == brute(rows, lambda i: i % 50 == 0) and got
