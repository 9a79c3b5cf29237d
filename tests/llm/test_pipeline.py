"""The pipeline against plain versions of its stages, each on its own input."""

import duckdb
import pytest
from helpers import SCHEMA, AWKWARD, benchmark_hits, line_dedup, near, plain_words, targets
from pyspark.sql import functions as F

import corpus_pipeline
from touchstone.llm.queries import ORACLES, QUERIES
from touchstone.llm.toxicity import toxicity_scores
from workload.check import rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs[-1], FOLDER)
        docs.append(spark.createDataFrame(made.collect(), made.schema))
    return docs


def texts(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def test_stages_in_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "decontamination", "source_mix"]
    for frame in stages[:-1]:
        assert frame.columns == stages[0].columns
    assert stages[-1].columns == [*stages[0].columns, "copies"]


def test_each_stage(spark, stages):
    raw, civil, lines, once, clean, mixed = stages
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scores = toxicity_scores(raw, labels).where("score < 0.5").select("doc_id")
    assert sorted(r[0] for r in scores.collect()) == sorted(i for i, _ in texts(civil))
    assert 0 < raw.count() - civil.count() < 0.3 * raw.count()
    assert sorted(texts(lines)) == sorted((i, t) for i, _, _, t in line_dedup(texts(civil)))
    classes = near(texts(lines))
    assert sorted(i for i, _ in texts(once)) == sorted({c for c, _ in classes.values()})
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert sorted(texts(clean)) == sorted((i, t) for i, t in texts(once) if not benchmark_hits(t, items)[1])
    sizes, took = {}, {}
    for r in clean.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(plain_words(r["text"]))
    for r in mixed.collect():
        took[r["source"]] = took.get(r["source"], 0) + r["copies"] * len(plain_words(r["text"]))
    largest = max(len(plain_words(t)) for _, t in texts(clean))
    for source, target in targets(sizes).items():
        assert abs(took.get(source, 0) - target) <= largest


def test_run_gives_the_same_rows(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(tuple, stages[-1].collect()))


def test_awkward_documents(spark):
    docs = spark.createDataFrame(AWKWARD, SCHEMA).withColumn("score", F.lit("mine"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    assert {r["doc_id"] for r in docs.collect()} >= {1, 2, 3, 6, None}
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty.select("doc_id", "text", "lang", "source", "n_chars"), FOLDER)
        assert empty.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, name):
    base = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    frame = QUERIES[name](spark, FOLDER)
    cursor = base.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(columns, cursor.fetchall())


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
