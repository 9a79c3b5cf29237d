"""Running values over ordered groups, safe for groups of any size.

A window function sends each group to one task.  That is right for ordinary
groups and wrong for a group that holds a third of the table.  ``OrderedScan``
keeps ordinary groups on plain windows, cuts the groups above ``hot_rows`` into
range partitions of the order, runs the same windows inside each piece, and
carries the result of the earlier pieces over.  The carried table has at most
two rows per range partition, so broadcasting it is bounded by construction.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchstone.operators.keys import null_safe
from touchstone.session import materialize

HOT_ROWS = 4_000_000
_BROADCAST_KEYS = 100_000
_PIECE = "_piece"


def _split(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int
) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of ordinary groups, and rows of hot groups numbered by range partition."""
    if keys:
        sizes = rows.groupBy(*keys).count()
    else:
        sizes = rows.agg(F.count(F.lit(1)).alias("count"))
    over = F.col("count") > hot_rows
    stats = sizes.agg(
        F.count_if(over).alias("groups"), F.sum(F.when(over, F.col("count"))).alias("rows")
    ).first()
    if not stats["groups"]:
        return rows, None
    ordinary, hot = None, rows
    if keys:
        # At most rows / hot_rows keys; frozen so both sides of the split agree.
        names = [(k, f"_hot_{k}") for k in keys]
        chosen = materialize(sizes.where(over).select(*[F.col(k).alias(h) for k, h in names]))
        side = F.broadcast(chosen) if stats["groups"] <= _BROADCAST_KEYS else chosen
        same = null_safe(rows, side, names)
        ordinary = rows.join(side, same, "left_anti")
        hot = rows.join(side, same, "left_semi")
    # Range bounds are sampled, so the numbering is computed once and kept.
    pieces = 2 * (stats["rows"] // hot_rows + 1)
    ranged = hot.repartitionByRange(pieces, *keys, *order)
    return ordinary, materialize(ranged.withColumn(_PIECE, F.spark_partition_id()))


class OrderedScan:
    """Rows grouped by ``keys`` in the total order ``order``."""

    def __init__(
        self,
        rows: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        *,
        hot_rows: int = HOT_ROWS,
    ) -> None:
        self.keys = list(keys)
        self.order = list(order)
        self._ordinary, self._hot = _split(rows, self.keys, self.order, hot_rows)

    @property
    def rows(self) -> DataFrame:
        if self._hot is None:
            return self._ordinary
        hot = self._hot.drop(_PIECE)
        return hot if self._ordinary is None else self._ordinary.unionByName(hot)

    def _each(self, change: Callable[[DataFrame], DataFrame]) -> None:
        if self._ordinary is not None:
            self._ordinary = change(self._ordinary)
        if self._hot is not None:
            self._hot = change(self._hot)

    def with_columns(self, columns: Mapping[str, Column]) -> OrderedScan:
        self._each(lambda rows: rows.withColumns(dict(columns)))
        return self

    def add(
        self,
        *,
        reverse: bool = False,
        within: Sequence[str] = (),
        max_before: Mapping[str, Column] | None = None,
        max_to: Mapping[str, Column] | None = None,
        sum_to: Mapping[str, Column] | None = None,
        previous: Mapping[str, Column] | None = None,
    ) -> OrderedScan:
        """Append running columns.

        ``max_before`` excludes the row itself, ``max_to`` and ``sum_to``
        include it, ``previous`` is the value one row earlier.  ``reverse``
        walks the order backwards; ``within`` splits groups further.
        """
        max_before, max_to = dict(max_before or {}), dict(max_to or {})
        sum_to, previous = dict(sum_to or {}), dict(previous or {})
        groups = [*self.keys, *within]
        steps = [F.col(c).desc() if reverse else F.col(c).asc() for c in self.order]

        def running(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
            window = Window.partitionBy(*parts).orderBy(*steps)
            before = window.rowsBetween(Window.unboundedPreceding, -1)
            upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            columns = {name: F.max(value).over(before) for name, value in max_before.items()}
            columns |= {name: F.max(value).over(upto) for name, value in max_to.items()}
            columns |= {name: F.sum(value).over(upto) for name, value in sum_to.items()}
            columns |= {
                name: F.lag(F.struct(value.alias("value"))).over(window)
                for name, value in previous.items()
            }
            return rows.withColumns(columns)

        if self._ordinary is not None:
            self._ordinary = running(self._ordinary, groups)
        if self._hot is not None:
            carried = self._carried(groups, reverse, max_before | max_to, sum_to, previous)
            local = running(self._hot, [*groups, _PIECE])
            names = [(g, f"_group_{i}") for i, g in enumerate([*groups, _PIECE])]
            joined = local.join(carried, null_safe(local, carried, names), "left")
            whole = {n: F.greatest(F.col(n), F.col(f"_from_{n}")) for n in max_before | max_to}
            whole |= {n: F.col(n) + F.coalesce(F.col(f"_from_{n}"), F.lit(0)) for n in sum_to}
            whole |= {n: F.coalesce(F.col(n), F.col(f"_from_{n}")) for n in previous}
            self._hot = materialize(joined.withColumns(whole).select(*local.columns))
        if previous:
            self.with_columns({name: F.col(name)["value"] for name in previous})
        return self

    def _carried(
        self,
        groups: Sequence[str],
        reverse: bool,
        maxima: Mapping[str, Column],
        sums: Mapping[str, Column],
        previous: Mapping[str, Column],
    ) -> DataFrame:
        """What the earlier pieces of a group hand to each later one."""
        place = F.struct(*[F.col(c) for c in self.order])
        last = F.min_by if reverse else F.max_by
        totals = [F.max(v).alias(f"_of_{n}") for n, v in maxima.items()]
        totals += [F.sum(v).alias(f"_of_{n}") for n, v in sums.items()]
        totals += [
            last(F.struct(v.alias("value")), place).alias(f"_of_{n}") for n, v in previous.items()
        ]
        summary = self._hot.groupBy(*groups, _PIECE).agg(*totals)
        walk = Window.partitionBy(*groups).orderBy(
            F.col(_PIECE).desc() if reverse else F.col(_PIECE).asc()
        )
        earlier = walk.rowsBetween(Window.unboundedPreceding, -1)
        carried = summary.select(
            *[F.col(g).alias(f"_group_{i}") for i, g in enumerate([*groups, _PIECE])],
            *[F.max(f"_of_{n}").over(earlier).alias(f"_from_{n}") for n in maxima],
            *[F.sum(f"_of_{n}").over(earlier).alias(f"_from_{n}") for n in sums],
            *[F.lag(f"_of_{n}").over(walk).alias(f"_from_{n}") for n in previous],
            F.count(F.lit(1)).over(Window.partitionBy(*groups)).alias("_pieces"),
        ).where("_pieces > 1")
        # Only groups that cross a range bound are left: at most two rows per bound.
        return F.broadcast(carried.drop("_pieces"))

    def add_best_other(
        self, name: str, value: Column, label: Column, *, reverse: bool = False
    ) -> OrderedScan:
        """Largest earlier ``value`` among rows whose ``label`` differs from this row's.

        Walk the running maximum with its label.  While the leading label stays
        the same, the best value of any other label is the maximum of what the
        previous leader had reached and the other labels seen since.
        """
        lead, past, turn, rival, mark = (f"_{part}_{name}" for part in ("lead", "past", "turn", "rival", "mark"))
        entry = F.when(value.isNotNull(), F.struct(value.alias("value"), label.alias("label")))
        self.with_columns({mark: label})
        self.add(reverse=reverse, max_before={past: entry}, max_to={lead: entry})
        changed = F.col(lead).isNotNull() & (
            F.col(past).isNull() | ~F.col(lead)["label"].eqNullSafe(F.col(past)["label"])
        )
        self.add(reverse=reverse, sum_to={turn: changed.cast("long")})
        other = F.when(changed, F.col(past)["value"]).when(
            value.isNotNull() & ~F.col(mark).eqNullSafe(F.col(lead)["label"]), value
        )
        self.add(reverse=reverse, within=[turn], max_before={rival: other})
        best = F.when(
            F.col(past).isNotNull() & ~F.col(past)["label"].eqNullSafe(F.col(mark)),
            F.col(past)["value"],
        ).otherwise(F.col(rival))
        self.with_columns({name: best})
        self._each(lambda rows: rows.drop(lead, past, turn, rival, mark))
        return self


def running_before(rows: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over all rows before each in ``order``.

    Rows are cut into range partitions, each of which sums its own; what the
    partitions before it hold is carried in, one number per partition.  No task
    sees more than one partition.  ``order`` must tell all rows apart.
    """
    ranged = rows.repartitionByRange(*order).withColumn(_PIECE, F.spark_partition_id())
    ranged = materialize(ranged)
    totals = ranged.groupBy(_PIECE).agg(F.sum(value).alias("total")).collect()  # a row per partition
    carried, held = 0, []
    for row in sorted(totals):
        held.append((row[_PIECE], carried))
        carried += row["total"] or 0
    bases = F.broadcast(rows.sparkSession.createDataFrame(held, f"{_PIECE} int, _carried long"))
    inside = Window.partitionBy(_PIECE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return summed.join(bases, _PIECE).withColumn(name, F.col(name) + F.col("_carried")).drop("_carried", _PIECE)
