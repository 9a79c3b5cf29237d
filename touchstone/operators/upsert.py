"""Keyed, idempotent upsert: update what matches, insert the rest.

A catalog with row-level operations gets one MERGE.  Plain file tables get the
same result by rewriting only the partitions the source touches: partition
columns are part of the key, or a bucket of its hash, so no row outside them can
match.  A table without such partitions is written anew beside itself and then
switched over, so it can be read as it was until the new state is complete.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchstone.operators.keys import null_safe
from touchstone.session import ensure_checkpoint_dir, materialize

_MERGE_PROVIDERS = ("delta", "iceberg", "hudi")

#: Partition column that holds the bucket of a row's key, and the most buckets.
BUCKET, MAX_BUCKETS = "_bucket", 4096
_KEYS, _BUCKETS, _BEFORE = "touchstone.keys", "touchstone.buckets", "touchstone.before"


class UpsertError(RuntimeError):
    """The upsert cannot be carried out."""


@dataclass(frozen=True)
class UpsertResult:
    table_name: str
    row_count: int
    write_action: str


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    # Plain equality: a null key matches nothing and is inserted.
    return reduce(lambda a, b: a & b, (left[k] == right[k] for k in keys))


def bucketed(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``rows`` with the bucket of their key as the last column."""
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def upserted(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now, without the bucket column."""
    return spark.table(table).drop(BUCKET)


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after the upsert.  Source keys are unique, see ``ambiguous``."""
    kept = target.join(source, _same_keys(target, source, keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def ambiguous(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in the source and also in the target."""
    repeated = source.groupBy(*keys).count().where("count > 1")
    return repeated.join(target, _same_keys(repeated, target, keys), "left_semi")


def _folder(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _replace_parts(spark: SparkSession, name: str, state: DataFrame, mode: str) -> None:
    """Write ``state`` to the shared folder, then put it in place of what it replaces.

    ``mode`` ``dynamic`` replaces the partitions that ``state`` holds, ``static`` all.

    The overwrite runs in a session of its own, so no setting of this one
    changes under other writers.  If it fails, the error names the folder with
    the complete new state, from which the overwrite can be repeated.
    """
    stage = f"{ensure_checkpoint_dir(spark).rstrip('/')}/upsert-{uuid.uuid4().hex}"
    state.write.parquet(stage)
    child = spark.newSession()
    child.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        child.read.schema(state.schema).parquet(stage).write.mode("overwrite").insertInto(name)
    except Exception as exc:
        raise UpsertError(f"{name} could not be replaced; its new state is complete in {stage}") from exc
    spark.catalog.refreshTable(name)
    system, path = _folder(spark, stage)
    system.delete(path, True)


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    marks = [i for i, r in enumerate(rows) if r["col_name"] == "# Detailed Table Information"]
    return {r["col_name"]: r["data_type"] for r in rows[marks[0] + 1 :]} if marks else {}


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _set(spark: SparkSession, table: str, **values: str) -> None:
    shown = ", ".join("'{}' = '{}'".format(k, v.replace("'", "\\'")) for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({shown})")


def _replace_whole(spark: SparkSession, name: str, state: DataFrame) -> None:
    """Write ``state`` into a folder beside the table's, then point the table there.

    Until then the table is what it was, and a write that fails leaves it so.
    Readers that have begun keep their files: the former folder goes when the
    next state is in place.
    """
    known = _described(spark, name)
    now, before = known["Location"], _properties(spark, name).get(_BEFORE)
    base = re.sub(r"-[0-9a-f]{32}$", "", now.rstrip("/"))
    new = f"{base}-{uuid.uuid4().hex}"
    state.write.format(known["Provider"]).save(new)
    spark.sql("ALTER TABLE {} SET LOCATION '{}'".format(name, new.replace("'", "\\'")))
    spark.catalog.refreshTable(name)
    if before and before != now:
        system, path = _folder(spark, before)
        system.delete(path, True)
    _set(spark, name, **{_BEFORE: now})


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def upsert(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    *,
    partition_by: Sequence[str] = (),
    buckets: int = 0,
    location: str | None = None,
    settled: bool = False,
) -> UpsertResult:
    """Create ``table`` from ``source``, or merge ``source`` into it by ``keys``.

    ``partition_by`` (a part of ``keys``) and ``buckets`` apply when the table is
    created, ``location`` says where.  With ``buckets`` the table has one more
    column, ``_bucket``, by which it is partitioned: the hash of the key, modulo
    ``buckets``.  A source then rewrites only the buckets its keys fall into, and
    the keys of the table are fixed; ``upserted`` reads it without that column.
    ``settled`` says that the source is already checkpointed or written, so it
    may be read several times without being kept once more.
    """
    name = table.strip() if isinstance(table, str) else ""
    if not name:
        raise UpsertError("table name must be a non-empty string")
    if not keys or not set(keys) <= set(source.columns):
        raise UpsertError("keys must be columns of the source")
    if not set(partition_by) <= set(keys):
        raise UpsertError("partition columns must be part of the key")
    if not 0 <= buckets <= MAX_BUCKETS or BUCKET in source.columns:
        raise UpsertError(f"buckets number at most {MAX_BUCKETS}, and {BUCKET} is no column of a source")
    spark = source.sparkSession
    source = source if settled else materialize(source)
    count = source.count()
    if count == 0:
        raise UpsertError("the source holds no rows")
    if not spark.catalog.tableExists(name):
        rows = bucketed(source, keys, buckets) if buckets else source
        writer = rows.write.mode("errorifexists")
        if location:
            writer = writer.option("path", location)
        if partition_by or buckets:
            writer = writer.partitionBy(*partition_by, *([BUCKET] if buckets else []))
        writer.saveAsTable(name)
        if buckets:
            _set(spark, name, **{_KEYS: ",".join(keys), _BUCKETS: str(buckets)})
        return UpsertResult(name, count, "created")
    target = spark.table(name)
    columns = [c for c in target.columns if c != BUCKET]
    if set(columns) != set(source.columns):
        raise UpsertError(f"columns of the source differ from those of {name}")
    if _described(spark, name).get("Provider", "").lower() in _MERGE_PROVIDERS:
        condition = reduce(
            lambda a, b: a & b, (F.col(f"source.{k}") == F.col(f"{name}.{k}") for k in keys)
        )
        (
            source.alias("source")
            .mergeInto(name, condition)
            .whenMatched()
            .updateAll()
            .whenNotMatched()
            .insertAll()
            .merge()
        )
        return UpsertResult(name, count, "merged")
    parts = _partition_columns(spark, name)
    if BUCKET in parts:
        own = _properties(spark, name)
        if set(own[_KEYS].split(",")) != set(keys):
            raise UpsertError(f"the keys of {name} are {own[_KEYS]}")
        # Hashes depend on types, so keys get those of the table first.
        kinds = {f.name: f.dataType for f in target.schema}
        source = source.select(*[F.col(c).cast(kinds[c]) for c in columns])
        source = bucketed(source, own[_KEYS].split(","), int(own[_BUCKETS]))
        touched = [r[BUCKET] for r in source.select(BUCKET).distinct().collect()]  # at most MAX_BUCKETS
        target = target.where(F.col(BUCKET).isin(touched))
    given = [p for p in parts if p != BUCKET]
    if given and set(given) <= set(keys):
        touched = source.select(*[F.col(p).alias(f"_touched_{p}") for p in given]).distinct()
        pairs = [(p, f"_touched_{p}") for p in given]
        target = target.join(touched, null_safe(target, touched, pairs), "left_semi")
    if not ambiguous(target, source, keys).isEmpty():
        raise UpsertError("several source rows match one target row")
    state = merged(target, source, keys).select(*spark.table(name).columns)
    if parts:
        _replace_parts(spark, name, state, "dynamic" if set(given) <= set(keys) else "static")
    else:
        _replace_whole(spark, name, state)
    return UpsertResult(name, count, "merged")
