import random

import pytest
from pyspark.sql import functions as F

from touchstone.operators import (
    UpsertError,
    duplicates,
    lookup,
    multiset_difference,
    referenced,
    unreferenced,
    unresolved,
    upsert,
    upserted,
)


def test_duplicates_flag_every_member_and_skip_missing(spark):
    rows = [(0, "a"), (1, "a"), (2, "b"), (3, ""), (4, ""), (5, None), (6, None), (7, "A"), (8, "a")]
    got = duplicates(spark.createDataFrame(rows, "i long, k string"), "k").collect()
    assert {r.i for r in got} == {0, 1, 8}


@pytest.mark.parametrize("nullable", [False, True])
@pytest.mark.parametrize("target", [["a", "b"], ["a", None, ""]])
def test_unresolved_null_semantics(spark, nullable, target):
    values = ["a", "b", "c", "", None, "a"]
    child = spark.createDataFrame(list(enumerate(values)), "i long, fk string")
    parent = spark.createDataFrame([(t,) for t in target], "id string")
    expected = {
        i for i, v in enumerate(values) if not (nullable and v in (None, "")) and v not in target
    }
    got = unresolved(child, "fk", parent, "id", nullable=nullable)
    assert {r.i for r in got.collect()} == expected


def test_lookup_last_parent_wins_and_nulls_meet(spark):
    parents = spark.createDataFrame(
        [(0, "a", "old"), (1, "a", "new"), (2, None, "none"), (3, "b", None)], "r long, id string, x string"
    )
    child = spark.createDataFrame([(0, "a"), (1, None), (2, "b"), (3, "z")], "i long, fk string")
    got = lookup(child, "fk", parents, "id", {"x2": "x"}, found="hit", order="r").collect()
    assert {(r.i, r.hit, r.x2) for r in got} == {
        (0, True, "new"), (1, True, "none"), (2, True, None), (3, False, None),
    }


def test_referenced_and_unreferenced(spark):
    parents = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    children = spark.createDataFrame([("a",), ("a",), (None,)], "fk string")
    assert [r.id for r in referenced(parents, "id", children, "fk").collect()] == ["a"]
    assert {r.id for r in unreferenced(parents, "id", children, "fk").collect()} == {"b", None}


def test_multiset_difference_counts_copies(spark):
    left = spark.createDataFrame([("a", None)] * 2 + [("b", "x")], "k string, v string")
    right = spark.createDataFrame([("a", None), ("b", "x"), ("c", "y")], "k string, v string")
    got = {tuple(r) for r in multiset_difference(left, right).collect()}
    assert got == {("a", None, 2, 1), ("c", "y", 0, 1)}
    assert multiset_difference(left, left).isEmpty()


@pytest.mark.parametrize("partition_by", [(), ("run",)])
def test_upsert_create_merge_and_repeat(spark, partition_by):
    table = f"upsert_{len(partition_by)}_{random.randrange(10**9)}"
    schema = "run string, k long, v string"

    def frame(rows):
        return spark.createDataFrame(rows, schema)

    keys = ["run", "k"]
    first = upsert(frame([("r1", 1, "a"), ("r1", 2, "b"), ("r2", 1, "c")]), table, keys, partition_by=partition_by)
    assert (first.write_action, first.row_count) == ("created", 3)
    change = frame([("r1", 2, "B"), ("r3", 9, "n"), (None, 1, "x")])
    for _ in range(2):
        assert upsert(change.where("run is not null"), table, keys).write_action == "merged"
    expected = {("r1", 1, "a"), ("r1", 2, "B"), ("r2", 1, "c"), ("r3", 9, "n")}
    assert {(r.run, r.k, r.v) for r in spark.table(table).collect()} == expected
    # A null key never matches, so it is inserted every time.
    for _ in range(2):
        upsert(change.where("run is null"), table, keys)
    assert spark.table(table).where("run is null").count() == 2
    assert spark.table(table).count() == 6
    with pytest.raises(UpsertError, match="several source rows"):
        upsert(frame([("r1", 1, "p"), ("r1", 1, "q")]), table, keys)
    # Repeated keys that match nothing are plain inserts.
    upsert(frame([("r8", 1, "p"), ("r8", 1, "q")]), table, keys)
    assert spark.table(table).where("run = 'r8'").count() == 2
    spark.sql(f"DROP TABLE {table}")


def test_upsert_rejects_bad_input(spark):
    good = spark.createDataFrame([(1, "a")], "k long, v string")
    with pytest.raises(UpsertError):
        upsert(good, "  ", ["k"])
    with pytest.raises(UpsertError):
        upsert(good.where("k > 1"), "never_made", ["k"])
    with pytest.raises(UpsertError):
        upsert(good, "never_made", ["z"])


def test_upsert_rewrites_only_the_buckets_it_touches(spark):
    table = f"bucketed_{random.randrange(10**9)}"
    frame = spark.createDataFrame([(i, f"v{i}") for i in range(200)], "k long, v string")
    assert upsert(frame, table, ["k"], buckets=32).write_action == "created"

    def files():
        return {r.f: r.b for r in spark.table(table).select(F.input_file_name().alias("f"), F.col("_bucket").alias("b")).distinct().collect()}

    before = files()
    assert len(set(before.values())) == 32
    # Keys of another type fall into the same buckets.
    change = spark.createDataFrame([(3, "new"), (1000, "more")], "k int, v string")
    assert upsert(change, table, ["k"]).write_action == "merged"
    after = files()
    touched = {r["_bucket"] for r in spark.table(table).where("k IN (3, 1000)").collect()}
    assert {f for f in before if before[f] not in touched} <= set(after)
    assert not {f for f in before if before[f] in touched} & set(after)
    got = {r.k: r.v for r in upserted(spark, table).collect()}
    assert got == {i: f"v{i}" for i in range(200)} | {3: "new", 1000: "more"}
    assert upserted(spark, table).columns == ["k", "v"]
    with pytest.raises(UpsertError, match="keys of"):
        upsert(frame, table, ["v"])
    with pytest.raises(UpsertError, match="several source rows"):
        upsert(spark.createDataFrame([(3, "a"), (3, "b")], "k long, v string"), table, ["k"])
    with pytest.raises(UpsertError):
        upsert(frame, "never_made", ["k"], buckets=5000)
    spark.sql(f"DROP TABLE {table}")


def test_a_failing_write_leaves_the_table_as_it_was(spark):
    table = f"switched_{random.randrange(10**9)}"
    old = [(1, "a"), (2, "b")]
    upsert(spark.createDataFrame(old, "k long, v string"), table, ["k"])
    broken = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    broken = broken.withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("no value"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no value"):
        upsert(broken, table, ["k"], settled=True)
    spark.catalog.refreshTable(table)
    assert {tuple(r) for r in spark.table(table).collect()} == set(old)
    # A reader that began before the switch keeps its files.
    reader = spark.read.format("parquet").load([r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location"][0])
    for value in ("B", "BB"):
        upsert(spark.createDataFrame([(2, value), (3, "c")], "k long, v string"), table, ["k"])
        assert {tuple(r) for r in spark.table(table).collect()} == {(1, "a"), (2, value), (3, "c")}
        if value == "B":
            assert reader.count() == 2
    spark.sql(f"DROP TABLE {table}")
