"""Interval operators against brute force, with and without hot groups."""

import random

import pytest
from pyspark.sql import functions as F

from touchstone.functions import UNBOUNDED_US
from touchstone.operators import (
    OrderedScan,
    adjacent,
    conflict_counts,
    conflict_pairs,
    overlapping,
    period_conflicts,
)

HOT = [4_000_000, 7]  # ordinary plan; every group above 7 rows split by range


def intervals(seed, n=120, keys=(None, "", "a", "a", "a", "b")):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = rng.randint(0, 300)
        end = UNBOUNDED_US if rng.random() < 0.03 else start + rng.randint(1, 12)
        rows.append((i, rng.choice(keys), rng.choice("xyz"), start, end))
    return rows


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_overlap_and_adjacency_match_pair_loops(spark, seed, hot):
    rows = intervals(seed)
    frame = spark.createDataFrame(rows, "i long, k string, g string, s long, e long")
    overlap, touch = set(), set()
    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[1] == b[1]:
                if a[3] < b[4] and b[3] < a[4]:
                    overlap |= {a[0], b[0]}
                elif a[4] == b[3] or b[4] == a[3]:
                    touch |= {a[0], b[0]}
    got = overlapping(frame, ["k"], "s", "e", "i", hot_rows=hot)
    assert {r.i for r in got.collect()} == overlap
    got = [r.i for r in adjacent(frame, ["k"], "s", "e").collect()]
    assert len(got) == len(set(got)) and set(got) == touch


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("seed", [4, 5, 6])
def test_period_conflicts_match_pair_loops(spark, seed, hot):
    rng = random.Random(seed)
    rows = []
    for i in range(110):
        start = rng.randint(0, 80)
        length = rng.randint(-15, -1) if rng.random() < 0.15 else rng.randint(0, 6)
        rows.append((i, rng.choice([None, "a", "a", "b"]), rng.choice([None, "p", "q", "r"]), start, start + length))
    overlap, conflict = set(), set()
    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[1] == b[1] and a[3] <= b[4] and b[3] <= a[4]:
                overlap |= {a[0], b[0]}
                if a[2] != b[2]:
                    conflict |= {a[0], b[0]}
    frame = spark.createDataFrame(rows, "i long, k string, p string, s long, e long")
    got = period_conflicts(frame, ["k"], "s", "e", "p", "i", hot_rows=hot).collect()
    assert len(got) == len(rows)
    assert {r.i for r in got if r.overlaps} == overlap
    assert {r.i for r in got if r.conflicts} == conflict


@pytest.mark.parametrize("hot", HOT)
def test_conflict_pairs_and_counts(spark, hot):
    rows = [r for r in intervals(9) if r[4] != UNBOUNDED_US]
    frame = spark.createDataFrame(rows, "i long, k string, g string, s long, e long")
    pairs = set()
    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[1] == b[1] and a[2] != b[2]:
                if a[3] < b[4] and b[3] < a[4]:
                    pairs.add((a[0], b[0], "overlap"))
                elif a[4] == b[3] or b[4] == a[3]:
                    pairs.add((a[0], b[0], "back_to_back"))
    got = [tuple(r) for r in conflict_pairs(frame, ["k"], "s", "e", "g", "i", cell=10).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    counts = conflict_counts(frame, ["k"], "s", "e", "g", "i", hot_rows=hot).collect()
    expected = {r[0]: 0 for r in rows}
    for a, b, kind in pairs:
        if kind == "overlap":
            expected[a] += 1
            expected[b] += 1
    assert {r.i: r.overlaps for r in counts} == expected


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_ordered_scan_matches_sequential_walk(spark, hot, keys):
    rng = random.Random(7)
    rows = [(i, rng.choice(["a", "a", "b", None]), rng.randint(0, 20), rng.choice([None, *range(50)])) for i in range(100)]
    frame = spark.createDataFrame(rows, "i long, k string, t long, v long")
    for reverse in (False, True):
        scan = OrderedScan(frame, keys, ["t", "i"], hot_rows=hot).add(
            reverse=reverse,
            max_before={"mb": F.col("v")},
            max_to={"mt": F.col("v")},
            sum_to={"st": F.lit(1)},
            previous={"pv": F.col("v")},
        )
        got = {r.i: (r.mb, r.mt, r.st, r.pv) for r in scan.rows.collect()}
        state, expected = {}, {}
        for i, k, t, v in sorted(rows, key=lambda r: (r[2], r[0]), reverse=reverse):
            g = k if keys else 0
            best, n, last = state.get(g, (None, 0, None))
            now = v if best is None else best if v is None else max(best, v)
            expected[i] = (best, now, n + 1, last)
            state[g] = (now, n + 1, v)
        assert got == expected
