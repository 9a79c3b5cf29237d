import pytest
from helpers import AWKWARD, LONG, SCHEMA, benchmark_hits
from pyspark.sql import functions as F

from touchstone.llm.decontaminate import cut_words, decontaminate, match_benchmark

ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog while twelve cats watch it from a wall"),
    (10, "two three"),
    (2, "one two Three"),
    (3, None),
    (4, "  ...  "),
    (None, "Seven words that nobody will ever name"),
    (5, " ".join(f"w{i}" for i in range(40))),
    (5, " ".join(f"w{i}" for i in range(40))),
    (6, "w20 w21 w22 w23 w24 w25 w26 w27 w28 w29 other"),
]
DOCS = AWKWARD + [
    (20, "Before. THE quick, brown fox jumps over the lazy dog while twelve... After all of it", "en", "s", 1),
    (21, "quick brown fox jumps over the lazy dog while", "en", "s", 1),
    (22, " ".join(f"w{i}" for i in range(5, 33)) + " stop " + " ".join(f"W{i}!" for i in range(30, 40)), "en", "s", 1),
    (23, "seven words that nobody will ever name", "en", "s", 1),
    (24, "w35 w36 w37 w38 w39", "en", "s", 1),
    (25, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9", "en", "s", 1),
    (26, LONG + " one two three " + LONG, "en", "s", 1),
]


def hits(frame):
    return sorted(((r["doc_id"], r["text"], r["_n_words"], sum(b - a for a, b in r["_spans"]), tuple(r["_items"])) for r in frame.collect()), key=repr)


def tables(spark):
    return spark.createDataFrame(DOCS, SCHEMA).withColumn("_spans", F.lit("old")), spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("block_words", [2_000_000, 12])
def test_matches_plain_version(spark, block_words):
    docs, items = tables(spark)
    want = []
    for doc, text, *_ in DOCS:
        n, hit, names = benchmark_hits(text, ITEMS)
        want.append((doc, text, n, len(hit), tuple(sorted(str(x) for x in names if x is not None))))
    assert hits(match_benchmark(docs, items, block_words=block_words)) == sorted(want, key=repr)


def test_actions(spark):
    docs, items = tables(spark)
    clean = decontaminate(docs, items)
    assert clean.columns == docs.columns
    expected = sorted((d[0] for d in DOCS if not benchmark_hits(d[1], ITEMS)[1]), key=repr)
    assert sorted((r[0] for r in clean.select("doc_id").collect()), key=repr) == expected
    cut = {r["doc_id"]: r["text"] for r in decontaminate(docs, items, action="spans").collect()}
    assert cut[20] == "Before. ... After all of it"
    assert cut[24] == "w35 w36 w37 w38 w39" and cut[1] is None and cut[25] == ""
    with pytest.raises(ValueError):
        decontaminate(docs, items, action="other")


def test_cut_words():
    assert cut_words("a, b c; d.", [[1, 3]]) == "a, ; d."


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert match_benchmark(docs.limit(0), items).count() == 0
    assert decontaminate(docs, items.limit(0)).count() == len(DOCS)
