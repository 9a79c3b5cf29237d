import random

import pytest

from touchstone.operators import (
    chain_summary,
    chains,
    closed_predecessors,
    cycle_members,
    looping_roots,
    without_successor,
)
from touchstone.operators import lineage
from touchstone.session import materialize

SCHEMA = "i long, id string, pred string, status string, at string"


def brute_cycles(rows):
    step = {r[1]: r[2] for r in rows if r[1] not in (None, "")}
    found = set()
    for begin in step:
        seen, current = [], begin
        while current in step and current not in (None, ""):
            if current in seen:
                found |= set(seen[seen.index(current):])
                break
            seen.append(current)
            current = step[current]
    return found


@pytest.mark.parametrize("seed", range(5))
def test_cycle_members_match_path_walk(spark, seed):
    rng = random.Random(seed)
    ids = [str(i) for i in range(40)]
    rows = []
    for i in range(50):
        node = rng.choice([*ids, None, ""]) if i >= 40 else ids[i]
        pred = rng.choice(["", None, "zz"]) if rng.random() < 0.35 else rng.choice(ids)
        rows.append((i, node, pred, "x", "t"))
    got = cycle_members(spark.createDataFrame(rows, SCHEMA), "id", "pred", "i").collect()
    assert {r.node for r in got} == brute_cycles(rows)


def test_long_chain_and_long_cycle(spark):
    rows = [(i, str(i), str(i - 1) if i else "", "x", "t") for i in range(700)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert cycle_members(frame, "id", "pred", "i").isEmpty()
    rows[0] = (0, "0", "499", "x", "t")
    got = cycle_members(spark.createDataFrame(rows, SCHEMA), "id", "pred", "i").collect()
    assert {r.node for r in got} == {str(i) for i in range(500)}


@pytest.mark.parametrize("seed", range(3))
def test_closed_predecessors_multiplicity(spark, seed):
    rng = random.Random(seed)
    rows = [
        (i, str(rng.randint(0, 12)), rng.choice(["", None, *map(str, range(14))]), rng.choice(["Completed", "Scheduled"]), "t")
        for i in range(40)
    ]
    by_id, followers = {}, {}
    for r in rows:
        by_id.setdefault(r[1], []).append(r)
        if r[2] not in (None, ""):
            followers.setdefault(r[2], []).append(r[0])
    expected = {}
    for pred, nexts in followers.items():
        for r in by_id.get(pred, ()):
            if r[3] == "Completed":
                for i in {r[0], *nexts}:
                    expected[i] = expected.get(i, 0) + 1
    got = closed_predecessors(spark.createDataFrame(rows, SCHEMA), "id", "pred", "status", "Completed").collect()
    assert {r.i: r.occurrences for r in got} == expected


def test_without_successor(spark):
    rows = [(0, "1", "", "Rescheduled", "t"), (1, "2", "1", "Rescheduled", "t"), (2, None, "", "Rescheduled", "t"), (3, "4", "4", "Rescheduled", "t")]
    got = without_successor(spark.createDataFrame(rows, SCHEMA), "id", "pred", "status", "Rescheduled").collect()
    assert {r.i for r in got} == {1, 2}


def test_chains(spark):
    links = {"242": "1", "243": "2", "244": "3", "245": "244", "248": "5", "249": "248", "250": "249", "300": "301", "301": "300"}
    ids = {*links, *links.values()}
    heads = set(links.values())
    rows = [(int(i), i, links.get(i, ""), "Rescheduled" if i in heads else "Scheduled", "same" if i in ("2", "243") else i) for i in ids]
    frame = spark.createDataFrame(rows, SCHEMA)
    members = chains(frame, "id", "pred", "status", "Rescheduled", "i")
    got = {}
    for r in members.collect():
        got.setdefault(r.root, []).append((r.depth, r.node))
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == {
        "1": ["1", "242"],
        "2": ["2", "243"],
        "3": ["3", "244", "245"],
        "5": ["5", "248", "249", "250"],
    }
    totals = {r.root: (r.links, r.distinct_moments) for r in chain_summary(members, frame, "id", "at").collect()}
    assert totals == {"1": (1, 2), "2": (1, 1), "3": (2, 3), "5": (3, 4)}


def test_chain_of_many_links(spark):
    rows = [(i, str(i), str(i - 1) if i else "", "Rescheduled", "t") for i in range(37)]
    got = chains(spark.createDataFrame(rows, SCHEMA), "id", "pred", "status", "Rescheduled", "i").collect()
    assert sorted((r.root, r.depth, int(r.node)) for r in got) == [("0", i, i) for i in range(37)]


def walked(rows):
    """(root, depth, node, in_loop) by walking from every root until a member comes again."""
    after = {}
    for i, node, pred, _, _ in rows:
        if pred and i >= after.get(pred, (-1,))[0]:
            after[pred] = (i, node)
    step = {pred: node for pred, (_, node) in after.items() if node is not None}
    out = set()
    for root in {r[1] for r in rows if r[3] == "Rescheduled"} - set(step.values()):
        seen = [root]
        while seen[-1] in step and step[seen[-1]] not in seen:
            seen.append(step[seen[-1]])
        entry = seen.index(step[seen[-1]]) if seen[-1] in step else len(seen)
        out |= {(root, k, node, k >= entry) for k, node in enumerate(seen)}
    return out


def test_loop_at_the_end_of_a_chain(spark):
    # 2 -> 3 -> 1 -> 0 -> 3: all four belong to the chain of 2.
    rows = [(i, a, b, "Rescheduled", "t") for i, (a, b) in enumerate([("3", "0"), ("0", "1"), ("3", "2"), ("1", "3"), ("2", "")])]
    found = chains(spark.createDataFrame(rows, SCHEMA), "id", "pred", "status", "Rescheduled", "i")
    assert {tuple(r) for r in found.collect()} == {("2", 0, "2", False), ("2", 1, "3", True), ("2", 2, "1", True), ("2", 3, "0", True)} == walked(rows)
    assert [tuple(r) for r in looping_roots(found).collect()] == [("2", 3, 1)]


@pytest.mark.parametrize("seed", range(6))
def test_chains_with_tails_loops_and_repeated_ids(spark, seed):
    rng = random.Random(seed)
    ids = [str(i) for i in range(30)]
    rows = []
    for i in range(55):  # some ids stand on several rows, so nodes have several predecessors
        node = rng.choice(ids)
        pred = rng.choice(["", None]) if rng.random() < 0.2 else rng.choice(ids)
        rows.append((i, node, pred, rng.choice(["Rescheduled", "Rescheduled", "Scheduled"]), "t"))
    got = [tuple(r) for r in chains(spark.createDataFrame(rows, SCHEMA), "id", "pred", "status", "Rescheduled", "i").collect()]
    assert len(got) == len(set(got))
    assert set(got) == walked(rows)


def test_many_tails_into_a_long_loop(spark):
    rows = [(i, str(i), str((i - 1) % 300), "Rescheduled", "t") for i in range(300)]
    rows += [(1000 + i, str(i), f"t{i}", "Scheduled", "t") for i in range(0, 300, 100)]
    rows += [(2000 + i, f"t{i}", "", "Rescheduled", "t") for i in range(0, 300, 100)]
    got = [tuple(r) for r in chains(spark.createDataFrame(rows, SCHEMA), "id", "pred", "status", "Rescheduled", "i").collect()]
    assert len(got) == 3 * 301 and set(got) == walked(rows)


def test_rounds_hold_a_row_a_link_at_most(spark, monkeypatch):
    # A long tail keeps rounds going while forty short chains have entered their loops.
    pairs = [(f"t{i}", f"t{i - 1}" if i else "") for i in range(260)]
    for k in range(40):
        pairs += [(f"r{k}", ""), (f"a{k}", f"r{k}"), (f"b{k}", f"a{k}"), (f"a{k}", f"b{k}")]
    pairs += [(f"l{i}", f"l{(i - 1) % 50}") for i in range(50)]  # a loop without a way in
    rows = [(i, node, pred, "Rescheduled", "t") for i, (node, pred) in enumerate(pairs)]
    sizes = []

    def counted(frame):
        kept = materialize(frame)
        sizes.append(kept.count())
        return kept

    monkeypatch.setattr(lineage, "materialize", counted)
    got = [tuple(r) for r in chains(spark.createDataFrame(rows, SCHEMA), "id", "pred", "status", "Rescheduled", "i").collect()]
    assert len(got) == 260 + 3 * 40 and set(got) == walked(rows)
    links = len([1 for _, pred in pairs if pred])
    assert max(sizes) <= links
