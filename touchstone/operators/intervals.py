"""Overlap, adjacency and conflict of intervals, without comparing all pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchstone.functions import UNBOUNDED_US
from touchstone.operators.keys import null_safe
from touchstone.operators.scan import HOT_ROWS, OrderedScan


def overlapping(
    rows: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    row: str,
    *,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows whose half-open ``[start, end)`` meets another of the same keys.

    ``start`` and ``end`` are ordered numbers with ``end > start``; use
    ``UNBOUNDED_US`` for an open end.  In start order an interval overlaps an
    earlier one when the furthest end so far lies beyond its start, and a later
    one when the next start lies before its end.
    """
    scan = OrderedScan(rows, keys, [start, row], hot_rows=hot_rows)
    scan.add(max_before={"_reach": F.col(end)})
    scan.add(reverse=True, previous={"_next": F.col(start)})
    meets = (F.col("_reach") > F.col(start)) | (F.col("_next") < F.col(end))
    return scan.rows.where(F.coalesce(meets, F.lit(False))).drop("_reach", "_next")


def adjacent(rows: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Rows that end where another of the same keys starts, or start where one ends."""

    def boundary(column: str, tag: str) -> DataFrame:
        return (
            rows.where(F.col(column) < UNBOUNDED_US)
            .groupBy(*[F.col(k).alias(f"_{tag}_{k}") for k in keys], F.col(column).alias(f"_{tag}_at"))
            .agg(F.lit(True).alias(f"_{tag}_hit"))
            .withColumn(f"_{tag}_spread", F.hash(f"_{tag}_at"))
        )

    out = rows
    for column, other, tag in ((end, start, "begins"), (start, end, "ends")):
        side = boundary(other, tag)
        same = null_safe(out, side, [(k, f"_{tag}_{k}") for k in keys])
        out = out.join(
            side,
            same & (out[column] == side[f"_{tag}_at"]) & (F.hash(out[column]) == side[f"_{tag}_spread"]),
            "left",
        )
    return out.where("_begins_hit OR _ends_hit").select(*rows.columns)


def period_conflicts(
    rows: DataFrame,
    scope: Sequence[str],
    start: str,
    end: str,
    payload: str,
    row: str,
    *,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Flag closed periods ``[start, end]`` that overlap inside a scope.

    Adds ``overlaps`` and ``conflicts`` (overlap with a different payload).  An
    inverted period (end before start) meets exactly the regular periods that
    contain all of ``[end, start]``; it takes its place in the scan at its
    ``end``, after the regular periods that start there.
    """
    start_c, end_c = F.col(start), F.col(end)
    rows = rows.withColumns(
        {"_inverted": (end_c < start_c).cast("int"), "_at": F.least(start_c, end_c)}
    )
    scan = OrderedScan(rows, scope, ["_at", "_inverted", row], hot_rows=hot_rows)
    regular = F.col("_inverted") == 0
    reach = F.when(regular, end_c)
    next_start = F.when(regular, -start_c)
    inner_end = F.when(~regular, -start_c)
    scan.add(max_before={"_reach": reach})
    scan.add(reverse=True, max_before={"_next": next_start, "_inner": inner_end})
    label = F.col(payload)
    scan.add_best_other("_other_reach", reach, label)
    scan.add_best_other("_other_next", next_start, label, reverse=True)
    scan.add_best_other("_other_inner", inner_end, label, reverse=True)

    def met(reached: str, following: str, inside: str):
        earlier = F.col(reached) >= start_c
        later = regular & (-F.col(following) <= end_c)
        inner = regular & (-F.col(inside) <= end_c)
        return (
            F.coalesce(earlier, F.lit(False))
            | F.coalesce(later, F.lit(False))
            | F.coalesce(inner, F.lit(False))
        )

    return scan.rows.withColumns(
        {
            "overlaps": met("_reach", "_next", "_inner"),
            "conflicts": met("_other_reach", "_other_next", "_other_inner"),
        }
    ).select(*[c for c in rows.columns if c not in ("_inverted", "_at")], "overlaps", "conflicts")


def conflict_pairs(
    rows: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    group: str,
    row: str,
    *,
    cell: int,
    most_cells: int = 100_000,
) -> DataFrame:
    """Pairs of one key and different group that overlap or touch.

    Returns ``first_row < second_row`` and ``kind`` (``overlap`` or
    ``back_to_back``).  Only intervals that share a time cell meet in the join:
    the later one sits in the cell of its start, the earlier one in every cell
    it spans, so each pair is found once and distant intervals never meet.
    Intervals must have an end: one that spans more than ``most_cells`` cells is
    an error, as it would be copied into each.  Choose ``cell`` near their usual
    length; where only numbers are needed, ``conflict_counts`` lists no pair.
    """
    names = [*keys, start, end, group, row]
    low = F.floor(F.col(f"e_{start}") / cell).cast("long")
    high = F.floor(F.col(f"e_{end}") / cell).cast("long")
    open_end = F.raise_error(F.lit(f"an interval spans more than {most_cells} cells; give it an end or choose a larger cell"))
    cells = F.when(high - low >= most_cells, open_end.cast("array<bigint>")).otherwise(F.sequence(low, high))
    early = rows.select(*[F.col(c).alias(f"e_{c}") for c in names]).withColumn("_cell", F.explode(cells))
    late = rows.select(*[F.col(c).alias(f"l_{c}") for c in names]).withColumn(
        "_late_cell", F.floor(F.col(f"l_{start}") / cell).cast("long")
    )
    first_start, first_end = F.col(f"e_{start}"), F.col(f"e_{end}")
    second_start = F.col(f"l_{start}")
    in_order = (first_start < second_start) | (
        (first_start == second_start) & (F.col(f"e_{row}") < F.col(f"l_{row}"))
    )
    joined = early.join(
        late,
        null_safe(early, late, [(f"e_{k}", f"l_{k}") for k in keys])
        & (early["_cell"] == late["_late_cell"])
        & ~F.col(f"e_{group}").eqNullSafe(F.col(f"l_{group}"))
        & in_order
        & (second_start <= first_end),
    )
    return joined.select(
        F.least(f"e_{row}", f"l_{row}").alias("first_row"),
        F.greatest(f"e_{row}", f"l_{row}").alias("second_row"),
        F.when(second_start < first_end, "overlap").otherwise("back_to_back").alias("kind"),
    )


def conflict_counts(
    rows: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    group: str,
    row: str,
    *,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per row: how many intervals of the key but another group overlap it.

    The counts of ``conflict_pairs`` without listing a pair: intervals that
    start before my end, less those that end by my start, taken for the key and
    again for the key and group.
    """
    points = rows.select(
        *keys,
        group,
        row,
        F.explode(
            F.array(
                F.struct(F.col(start).alias("at"), F.lit(1).alias("opens")),
                F.struct(F.col(end).alias("at"), F.lit(0).alias("opens")),
            )
        ).alias("_point"),
    ).select(*keys, group, row, "_point.at", "_point.opens")
    # At one instant ends come before starts, so touching intervals do not count.
    scan = OrderedScan(points, keys, ["at", "opens", row], hot_rows=hot_rows)
    opened, ended = F.col("opens").cast("long"), (1 - F.col("opens")).cast("long")
    scan.add(sum_to={"_opened": opened, "_ended": ended})
    # The group's own counts are a scan of their own: groups lie scattered over a
    # hot key's ranges, so within its scan every group would be carried on.
    own = OrderedScan(points, [*keys, group], ["at", "opens", row], hot_rows=hot_rows)
    own.add(sum_to={"_opened": opened, "_ended": ended})
    at_end, at_start = F.col("opens") == 0, F.col("opens") == 1
    sign = F.col("_sign")
    both = scan.rows.withColumn("_sign", F.lit(1)).unionByName(own.rows.withColumn("_sign", F.lit(-1)))
    per_row = both.groupBy(row).agg(
        F.sum(F.when(at_end, sign * F.col("_opened"))).alias("_opened"),
        F.sum(F.when(at_start, sign * F.col("_ended"))).alias("_ended"),
    )
    return per_row.select(row, (F.col("_opened") - F.col("_ended")).alias("overlaps"))
