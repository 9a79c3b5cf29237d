"""From raw documents to a training mix: five stages, each on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchstone.llm.common import fresh_name, shared_folder
from touchstone.llm.decontaminate import decontaminate
from touchstone.llm.jaccard_join import keep_one
from touchstone.llm.line_dedup import dedup_lines
from touchstone.llm.mixing import mix
from touchstone.llm.toxicity import toxicity_scores

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = fresh_name(docs.columns, "toxicity")
    return toxicity_scores(docs, labels, score_col=score).where(F.col(score) < 0.5).select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share."""
    counts = [fresh_name(docs.columns, c) for c in ("n_lines", "n_dropped")]
    return dedup_lines(docs, counts=counts).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), action="documents")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with ``copies``: how often each is taken."""
    return mix(docs, copies_col=fresh_name(docs.columns, "copies"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("source_mix", mix_sources),
]

#: Two stages (a fitted classifier and balanced sampling) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        place = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
