"""Set rules over keys: duplicates, foreign keys, parent lookups.

All of them are equi-joins against a per-key aggregate, so the aggregated side
never holds a key twice whatever the copies in the table.  A key that holds a
large share of the *other* side is left to adaptive skew-join splitting, which
needs a plain shuffle on both sides.  ``_spread`` arranges that: the join also
compares a hash of the key, which the aggregate is not partitioned by.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchstone.functions import missing, present


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Equality in which two nulls are equal; still planned as a hash join."""
    return reduce(
        lambda a, b: a & b, (left[one].eqNullSafe(right[other]) for one, other in pairs)
    )


def _spread(frame: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return frame.withColumn(name, F.hash(*[F.col(k) for k in keys]))


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """Every row whose key value occurs more than once; missing keys are not keys."""
    rows = rows.where(present(F.col(key).cast("string")))
    repeated = (
        rows.groupBy(F.col(key).alias("_key")).count().where("count > 1").select("_key")
    )
    left, right = _spread(rows, [key], "_spread"), _spread(repeated, ["_key"], "_spread_key")
    return left.join(
        right, (left[key] == right["_key"]) & (left["_spread"] == right["_spread_key"]), "left_semi"
    ).drop("_spread")


def duplicates_by(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key combination occurs more than once; nulls group together."""
    named = [F.col(k).alias(f"_key_{k}") for k in keys]
    repeated = rows.groupBy(*named).count().where("count > 1").drop("count")
    left = _spread(rows, keys, "_spread")
    right = _spread(repeated, [f"_key_{k}" for k in keys], "_spread_key")
    same = null_safe(left, right, [(k, f"_key_{k}") for k in keys])
    return left.join(right, same & (left["_spread"] == right["_spread_key"]), "left_semi").drop(
        "_spread"
    )


def lookup(
    rows: DataFrame,
    field: str,
    parents: DataFrame,
    parent_key: str,
    attributes: Mapping[str, str],
    *,
    found: str,
    order: str | None = None,
) -> DataFrame:
    """Attach parent attributes and a found flag; the last parent row per key wins.

    ``attributes`` maps new column names to parent columns, ``order`` names the
    column that says which of several parents with one key is last (without it
    a hash of the attributes decides).  A null field resolves exactly when a parent
    has a null key.
    """
    key = F.col(parent_key).alias("_parent_key")
    if attributes:
        carried = [F.col(src).alias(name) for name, src in attributes.items()]
        place = F.col(order) if order else F.xxhash64(*[F.col(src) for src in attributes.values()])
        # One aggregate, whose size Spark can tell from the parents': where they
        # are few it broadcasts them, and the rows are not shuffled at all.
        last = F.max(F.struct(place.alias("_place"), *carried))
        known = parents.groupBy(key).agg(last.alias("_carried"))
    else:
        known = parents.select(key).distinct().withColumn("_carried", F.lit(None))
    left = _spread(rows, [field], "_spread")
    right = _spread(known, ["_parent_key"], "_spread_key").withColumn("_hit", F.lit(True))
    joined = left.join(
        right,
        left[field].eqNullSafe(right["_parent_key"]) & (left["_spread"] == right["_spread_key"]),
        "left",
    )
    return joined.select(
        *[left[c] for c in rows.columns],
        F.coalesce(F.col("_hit"), F.lit(False)).alias(found),
        *[F.col("_carried")[name].alias(name) for name in attributes],
    )


def unresolved(
    rows: DataFrame, field: str, parents: DataFrame, parent_key: str, *, nullable: bool = False
) -> DataFrame:
    """Rows whose foreign key is not among the parent keys (raw batch, no cascade)."""
    if nullable:
        rows = rows.where(~missing(F.col(field).cast("string")))
    known = parents.select(F.col(parent_key).alias("_parent_key")).distinct()
    left, right = _spread(rows, [field], "_spread"), _spread(known, ["_parent_key"], "_spread_key")
    return left.join(
        right,
        left[field].eqNullSafe(right["_parent_key"]) & (left["_spread"] == right["_spread_key"]),
        "left_anti",
    ).drop("_spread")


def _by_children(parents: DataFrame, key: str, children: DataFrame, field: str, how: str) -> DataFrame:
    used = children.select(F.col(field).alias("_child_key")).distinct()
    left, right = _spread(parents, [key], "_spread"), _spread(used, ["_child_key"], "_spread_key")
    return left.join(
        right,
        (left[key] == right["_child_key"]) & (left["_spread"] == right["_spread_key"]),
        how,
    ).drop("_spread")


def referenced(parents: DataFrame, key: str, children: DataFrame, field: str) -> DataFrame:
    """Parents that some child points to."""
    return _by_children(parents, key, children, field, "left_semi")


def unreferenced(parents: DataFrame, key: str, children: DataFrame, field: str) -> DataFrame:
    """Parents that no child points to."""
    return _by_children(parents, key, children, field, "left_anti")
