import random

import pytest
from helpers import AWKWARD, SCHEMA, plain_words, targets
from hypothesis import given, settings
from hypothesis import strategies as st

from touchstone.llm.mixing import flight, land, mix, mix_decisions


def documents(n=900, seed=5):
    rng = random.Random(seed)
    sources = ["a", "b", "c", "Z", "ß", None]
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(1.1) * 5)), "en", rng.choices(sources, (30, 1, 5, 9, 2, 3))[0], 1) for i in range(n)]
    return rows + [(7_000, "", "en", "empty", 0), (7_001, None, "en", "empty", 0)] + AWKWARD


def taken(frame):
    return sorted(((r["id"], r["source"], r["size"], r["rows"], r["copies"]) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("bucket", [1024, 128])
def test_targets_and_totals(spark, bucket):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA)
    found = mix_decisions(docs, bucket=bucket).collect()
    sizes: dict = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(plain_words(text))
    want = targets(sizes)
    assert sum(r["rows"] for r in found) == len(rows)
    total, got = {}, {}
    for r in found:
        assert 0 <= r["copies"] <= 3
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-9)
        got[r["source"]] = got.get(r["source"], 0) + r["copies"] * r["size"] * r["rows"]
        if r["source_size"]:  # no fewer whole copies than the ratio has
            ratio = r["target"] / r["source_size"]
            assert ratio - 1 < r["copies"] < ratio + 1
        total[r["source"]] = total.get(r["source"], 0) + 1
    for source, n in got.items():
        if total[source] > 50:
            assert n == pytest.approx(want[source], abs=0.02 * sizes[source] + 10)


def test_reruns_agree(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    first = taken(mix_decisions(docs, bucket=32))
    assert first == taken(mix_decisions(docs.repartition(5, "text"), bucket=32))


def test_documents_of_the_mix(spark):
    docs = spark.createDataFrame(documents(200), SCHEMA)
    found = mix(docs)
    assert found.columns == [*docs.columns, "copies"]
    copies = {(r["id"], r["source"], r["size"]): r["copies"] for r in mix_decisions(docs).collect()}
    kept = sorted(((r["doc_id"], r["source"], len(plain_words(r["text"])), r["copies"]) for r in found.collect()), key=repr)
    want = [(i, s, len(plain_words(t)), copies[i, s, len(plain_words(t))]) for i, t, _, s, _ in documents(200)]
    assert kept == sorted((w for w in want if w[3]), key=repr)
    assert mix(docs.limit(0)).count() == 0
    assert set(mix(docs.withColumnRenamed("n_chars", "copies")).columns) == {"doc_id", "text", "lang", "source", "copies"}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 3), st.integers(0, 50)), max_size=40), st.integers(0, 99))
def test_flight_keeps_both_totals(units, seed):
    prob, rows, size = [p for p, _, _ in units], [r for _, r, _ in units], [s for _, _, s in units]
    before = [sum(p * x for p, x in zip(prob, y, strict=True)) for y in (rows, size)]
    flight(prob, rows, size, seed)
    after = [sum(p * x for p, x in zip(prob, y, strict=True)) for y in (rows, size)]
    assert after == pytest.approx(before, abs=1e-5)
    assert sum(1e-9 < p < 1 - 1e-9 for p in prob) <= 2 or len({(r, s) for r, s in zip(rows, size, strict=True)}) < 3
    land(prob, rows, size)
    assert all(p <= 1e-9 or p >= 1 - 1e-9 for p in prob)


def test_flight_is_fair():
    size = [3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14] * 4
    want = [0.2, 0.5, 0.3, 0.6] * 12
    taken = [0.0] * len(size)
    for seed in range(1_000):
        prob = list(want)
        flight(prob, [1] * len(size), size, seed)
        land(prob, [1] * len(size), size)
        taken = [t + p for t, p in zip(taken, prob, strict=True)]
    assert [t / 1_000 for t in taken[:-4]] == pytest.approx(want[:-4], abs=0.1)
