"""Mixing sources to target weights by balanced sampling (the cube method).

Every source has a target; the ratio of target to size splits into whole copies,
which every document gets, and a fraction, which is an inclusion probability.
The flight phase moves the probabilities along directions that leave the document
total and the token total unchanged, until one of them reaches 0 or 1: a document
moves, and the others of its bucket make up for it together.  Large documents go
first, while many are left to make up for them.  Sources are cut into buckets of a bounded
number of documents; the at most two documents a bucket leaves open go on to the
next level, where far fewer buckets are left, and the last ten of a source are landed
on the choice that misses the totals least.  So each source misses its target by
less than a small document, whatever its size.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchstone.llm.common import NON_SPACE
from touchstone.session import materialize

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
BUCKET = 1024
#: Open documents of a source that are landed by trying every choice.
LANDING = 10
_UNIT = "id {id}, source {source}, size long, rows long, hash long, prob double, whole int, picked int, last boolean"


def word_count(text: Column) -> Column:
    """Words of a text between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(NON_SPACE)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place (from 0) by code point, null last, without one task for all."""
    ranged = materialize(
        sources.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id())
    )
    before, start = 0, []
    for row in ranged.groupBy("part").count().orderBy("part").collect():  # one row per partition
        start.append((row["part"], before))
        before += row["count"]
    offset = F.lit(0)
    for part, rows in start:
        offset = F.when(F.col("part") == part, F.lit(rows)).otherwise(offset)
    order = Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")
    return ranged.withColumn("place", F.row_number().over(order) - 1 + offset).drop("part")


def source_targets(units: DataFrame, weights: Sequence[float] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """``(source, source_size, units, target)``: shares by weight, capped and reshared.

    ``units`` has ``source``, ``size`` and ``rows``.  Weights go to the sources
    in code-point order, null last, and repeat.  No target is above
    ``most_copies`` times its source's size; the excess goes to the others by
    weight.  One small aggregate a round, until no source is above its cap.
    """
    sources = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("units")
    )
    turn = F.col("place") % len(weights)
    weight = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        weight = F.when(turn == i, F.lit(float(w))).otherwise(weight)
    cap = (F.col("source_size") * most_copies).cast("double")
    ranked = materialize(_ranked(sources).withColumns({"weight": weight, "cap": cap}).drop("place"))
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, closed = 0.0, -1
    while True:
        above = F.col("cap") < F.col("weight") * level
        row = ranked.agg(
            F.count_if(above).alias("closed"),
            F.sum(F.when(above, F.col("cap"))).alias("caps"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
        ).first()
        if row["closed"] == closed or not row["open"]:
            break
        closed, level = row["closed"], (total - (row["caps"] or 0.0)) / row["open"]
    return ranked.select("source", "source_size", "units", F.least("cap", F.col("weight") * level).alias("target"))


def _steps(prob: np.ndarray, move: np.ndarray) -> tuple[float, float]:
    """How far ``prob`` can go along ``move`` and against it within [0, 1]."""
    with np.errstate(divide="ignore", invalid="ignore"):
        to_one, to_zero = (1 - prob) / np.abs(move), prob / np.abs(move)
    ahead = np.where(move > 0, to_one, to_zero)[move != 0]
    behind = np.where(move > 0, to_zero, to_one)[move != 0]
    return float(ahead.min()), float(behind.min())


def _direction(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A direction that keeps both totals and moves the first unit, if the others can make up for it.

    The others share the counter-movement by least squares, so they move little
    and the first unit is the one to be decided.  Failing that, the normal of the
    first three units (or the swap of two alike) is taken.
    """
    totals = np.vstack([rows, size])
    own, rest = totals[:, 0], totals[:, 1:]
    (a, b), (_, d) = rest @ rest.T
    det = a * d - b * b
    if det > 1e-9 * a * d:
        x, y = (d * own[0] - b * own[1]) / det, (a * own[1] - b * own[0]) / det
        return np.concatenate([[1.0], -(x * rest[0] + y * rest[1])])
    move = np.zeros(len(rows))
    if rows[0] * size[1] == rows[1] * size[0]:
        move[:2] = rows[1], -rows[0]
    elif len(rows) > 2:
        move[:3] = np.cross(totals[0, :3], totals[1, :3])
    return move


def flight(prob: list[float], rows: list[int], size: list[int], seed: int, leave: int = 2) -> None:
    """Move ``prob`` in place to 0 or 1, all but at most ``leave`` (2 at least), keeping both totals.

    Units are decided in the order given; each step decides at least one, up or
    down by a fair draw.  Only a unit so large that all others together could
    not make up for it one way goes the other way.
    """
    rng, tiny = random.Random(seed), 1e-9
    p = np.array(prob, float)
    r, s = np.array(rows, float), np.array(size, float)
    active = np.nonzero((p > tiny) & (p < 1 - tiny))[0]
    while len(active) > max(leave, 1):
        move = _direction(r[active], s[active])
        if not move.any():
            break
        own, weight = p[active], s[active]
        up, down = _steps(own, move)
        rise = rng.random() * (up + down) < down
        taken, left = own * weight, (1 - own) * weight
        no_rise, no_fall = left[0] > taken[1:].sum(), taken[0] > left[1:].sum()
        if no_rise != no_fall and move[0]:
            rise = no_fall == (move[0] > 0)
        moved = own + move * (up if rise else -down)
        moved[moved <= tiny] = 0.0
        moved[moved >= 1 - tiny] = 1.0
        p[active] = moved
        active = active[(moved > 0.0) & (moved < 1.0)]
    prob[:] = p.tolist()


def land(prob: list[float], rows: list[int], size: list[int]) -> None:
    """Decide the few open units: least miss of the token total, a missed document counting half its mean size."""
    open_units = [i for i, p in enumerate(prob) if 0.0 < p < 1.0]
    p, r, s = (np.array([x[i] for i in open_units], float) for x in (prob, rows, size))
    choices = (np.arange(1 << len(open_units))[:, None] >> np.arange(len(open_units))) & 1
    miss = np.abs(choices @ s - p @ s) + 0.5 * (s.mean() if len(s) else 0.0) * np.abs(choices @ r - p @ r)
    best = choices[np.argmin(np.round(miss, 6))]
    for i, choice in zip(open_units, best.tolist(), strict=True):
        prob[i] = float(choice)


def _level(table: pa.Table) -> pa.Table:
    """One bucket of one source: flight, and the landing if it is the source's last."""
    columns = table.to_pydict()
    # Large documents are decided first, so that the ones left open are small.
    ids = [repr(x) for x in columns["id"]]
    order = sorted(range(len(ids)), key=lambda i: (-columns["size"][i] * columns["rows"][i], columns["hash"][i], ids[i]))
    prob = [columns["prob"][i] for i in order]
    rows = [columns["rows"][i] for i in order]
    size = [columns["size"][i] * columns["rows"][i] for i in order]
    last = columns["last"][0]
    seed = zlib.crc32(repr((columns["source"][0], len(ids), columns["hash"][order[0]])).encode())
    flight(prob, rows, size, seed, LANDING if last else 2)
    if last:
        land(prob, rows, size)
    picked = [None if 0.0 < p < 1.0 else int(p) for p in prob]
    moved = table.take(pa.array(order, pa.int64()))
    moved = moved.set_column(moved.schema.get_field_index("prob"), "prob", pa.array(prob, pa.float64()))
    return moved.set_column(moved.schema.get_field_index("picked"), "picked", pa.array(picked, pa.int32())).select(
        ["id", "source", "size", "rows", "hash", "prob", "whole", "picked", "last"]
    )


def mix_decisions(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    most_copies: int = MOST_COPIES,
    bucket: int = BUCKET,
) -> DataFrame:
    """``(id, source, size, rows, copies, source_size, target)``: what the mix takes.

    One row per unit: documents that agree in id, source and size, ``rows`` of
    them, are decided together.  Each is taken ``copies`` times.  Decisions
    depend on the rows alone, not on their order or partitions.

    Defined cases: a null text has size 0; a null source is a source of its own,
    last in order; a null id is an id like any other; a source or table of size 0
    has target 0; an empty table gives no rows.
    """
    size = word_count(F.col("text")) if size is None else size
    units = materialize(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"))
        .groupBy("id", "source", "size")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    kinds = {f.name: f.dataType.simpleString() for f in units.schema}
    schema = _UNIT.format(id=kinds["id"], source=kinds["source"])
    targets = materialize(source_targets(units, weights, most_copies))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    left = targets.select(
        F.col("source").alias("of"), F.floor(ratio).cast("int").alias("whole"), (ratio - F.floor(ratio)).alias("prob")
    )
    # Sources are few and their table small; where it is not, Spark joins by shuffle.
    pending = (
        units.join(left, F.col("source").eqNullSafe(F.col("of")))
        .withColumns({"hash": F.xxhash64("id", "size"), "picked": F.lit(None).cast("int"), "last": F.lit(False)})
        .select("id", "source", "size", "rows", "hash", "prob", "whole", "picked", "last")
    )
    done = [pending.where("prob <= 1e-9").withColumn("picked", F.lit(0))]
    pending = pending.where("prob > 1e-9")
    number = 0
    while True:
        counts = pending.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / bucket).alias("buckets"))
        counts = counts.withColumnRenamed("source", "of")
        dealt = (
            pending.join(counts, F.col("source").eqNullSafe(F.col("of")))
            .withColumn("bucket", F.pmod(F.xxhash64("hash", F.lit(number)), F.col("buckets")))
            .withColumn("last", F.col("buckets") == 1)
            .drop("of", "buckets")
        )
        decided = materialize(
            dealt.groupBy("source", "bucket").applyInArrow(lambda table: _level(table), schema)
        )
        done.append(decided.where("picked is not null"))
        pending = decided.where("picked is null")
        number += 1
        if pending.isEmpty():
            break
    settled = done[0]
    for part in done[1:]:
        settled = settled.unionByName(part)
    return settled.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "id", "source", "size", "rows", (F.col("whole") + F.col("picked")).cast("long").alias("copies"), "source_size", "target"
    )


def mix(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None, copies_col: str = "copies", **options: object) -> DataFrame:
    """The documents that the mix takes, each row once, with how often (``copies_col``).

    Texts move once, to meet the decisions.  Cases as in ``mix_decisions``.
    """
    size = word_count(F.col("text")) if size is None else size
    decided = mix_decisions(docs, id_col=id_col, source_col=source_col, size=size, **options)
    taken = decided.where("copies > 0").select(
        F.col("id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"),
        F.hash("id").alias("_spread"), F.col("copies").alias("_copies"),
    )
    kept = [c for c in docs.columns if c != copies_col]
    rows = docs.select(*[F.col(c).alias(f"c_{c}") for c in kept], F.col(id_col).alias("_i"), F.col(source_col).alias("_s"), size.alias("_n"), F.hash(id_col).alias("_h"))
    same = (
        F.col("_i").eqNullSafe(F.col("_id")) & F.col("_s").eqNullSafe(F.col("_source"))
        & (F.col("_n") == F.col("_size")) & (F.col("_h") == F.col("_spread"))
    )
    return rows.join(taken, same).select(*[F.col(f"c_{c}").alias(c) for c in kept], F.col("_copies").alias(copies_col))
