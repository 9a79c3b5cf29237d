"""One key holds most rows: joins must be split by adaptive execution."""

import pytest
from pyspark.sql import functions as F

from touchstone.operators import closed_predecessors, duplicates, lookup, referenced, unresolved
from touchstone.operators.keys import duplicates_by

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def split_settings(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_hot_child_key_is_split(spark, split_settings):
    rows = spark.range(0, 40000, 1, 8).select(
        F.col("id").alias("i"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 500).cast("string").alias("fk"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    parents = spark.range(0, 400, 1, 4).select(F.col("id").cast("string").alias("id"), F.col("id").alias("r"), F.lit("x").alias("a"))
    cases = {
        "lookup": lookup(rows, "fk", parents, "id", {"b": "a"}, found="hit", order="r"),
        "unresolved": unresolved(rows, "fk", parents, "id"),
        "duplicates": duplicates(rows.withColumn("fk", F.coalesce("fk", F.lit("hot"))), "fk"),
        "duplicates_by": duplicates_by(rows, ["fk"]),
        "referenced": referenced(rows.withColumn("fk", F.coalesce("fk", F.lit("1"))), "fk", parents, "id"),
    }
    for name, frame in cases.items():
        plan = final_plan(frame)
        assert "skew=true" in plan, (name, plan)
    assert cases["unresolved"].count() == rows.where("fk IS NULL OR CAST(fk AS INT) >= 400").count()


def test_hot_predecessor_is_split(spark, split_settings):
    rows = spark.range(0, 30000, 1, 8).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 2 == 0, F.lit("7")).otherwise((F.col("id") % 900).cast("string")).alias("pred"),
        F.lit("Completed").alias("status"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    plan = final_plan(closed_predecessors(rows, "id", "pred", "status", "Completed"))
    assert "skew=true" in plan, plan
