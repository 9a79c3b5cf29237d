import hashlib

from helpers import AWKWARD, LONG, SCHEMA, line_dedup
from pyspark.sql import functions as F

from touchstone.llm.line_dedup import dedup_lines

SHARED = "This line stands in many of the documents, word for word"
MIXED = [
    (100 + i, f"own {i}\n  {SHARED.upper() if i % 2 else SHARED}\t\n\nlast {i}\n{'ÄÖ short' if i < 3 else 'x' * 45}", "en", "s", 1) for i in range(9)
]


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_matches_plain_version(spark):
    rows = AWKWARD + MIXED + [(200, SHARED + "\n" + SHARED, "en", "s", 1), (None, SHARED, "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = dedup_lines(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    want = line_dedup([(r[0], r[1]) for r in rows])
    assert rows_of(found.select("doc_id", "n_lines", "n_dropped", "text")) == sorted(want, key=repr)
    assert found.where("n_dropped > 0").count() >= 8


def test_rows_that_repeat_an_id_lose_their_own_lines(spark):
    rows = [(i, SHARED, "en", "s", 1) for i in range(6)] + [(1, "short\n" + SHARED, "en", "s", 1)]
    want = line_dedup([(r[0], r[1]) for r in rows])
    found = dedup_lines(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(found.select("doc_id", "n_lines", "n_dropped", "text")) == sorted(want, key=repr)


def test_many_lines_and_clashing_columns(spark):
    text = "\n".join([SHARED + f" {i % 50}" for i in range(20_000)] + [LONG])
    rows = [(i, text, "x", "y") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string, pos string").withColumns({"h1": F.lit(1), "n_dropped": F.lit("old"), "_gone": F.lit(2)})
    found = dedup_lines(docs).orderBy("doc_id").collect()
    assert [r["n_dropped"] for r in found] == [20_001] * 4 + [0]
    assert found[4]["text"] == text and found[0]["text"] == "" and found[0]["_id"] == "x"
    assert hashlib.sha256(found[4]["text"].encode()).hexdigest() == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_and_plan(spark):
    docs = spark.createDataFrame([], SCHEMA)
    found = dedup_lines(docs)
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))
