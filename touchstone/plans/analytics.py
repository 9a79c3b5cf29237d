"""Coverage and conflict questions over schedules and assignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchstone.operators.keys import unreferenced
from touchstone.operators.scan import HOT_ROWS, OrderedScan


def load_dispersion(rows: DataFrame, field: str) -> DataFrame:
    """How evenly rows spread over the values of a field: one row."""
    counts = rows.groupBy(field).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).alias("groups"),
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.stddev_pop("n").alias("deviation"),
    )


def uncovered(population: DataFrame, key: str, rows: DataFrame, field: str) -> DataFrame:
    """Members of the population that no row refers to."""
    return unreferenced(population, key, rows, field)


def exposed(
    subjects: DataFrame,
    windows: DataFrame,
    subject_span: tuple[str, str],
    window_span: tuple[str, str],
    row: str,
    *,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Subjects with the number of windows their half-open span overlaps, if any.

    There is no key to join on.  Windows that start before a subject ends, less
    those that end by its start, are counted in one walk over time, so no
    subject is paired with a window.
    """
    start, end = subject_span
    begin, finish = window_span

    # At one instant: ends, subject ends, subject starts, window starts.
    def point(at: str, rank: int, source: DataFrame, key: Column) -> DataFrame:
        return source.select(key.alias(row), F.col(at).alias("_at"), F.lit(rank).alias("_rank"))

    nothing = F.lit(None).cast(subjects.schema[row].dataType)
    points = (
        point(finish, 0, windows, nothing)
        .unionByName(point(begin, 3, windows, nothing))
        .unionByName(point(end, 1, subjects, F.col(row)))
        .unionByName(point(start, 2, subjects, F.col(row)))
    )
    scan = OrderedScan(points, [], ["_at", "_rank", row], hot_rows=hot_rows)
    scan.add(
        sum_to={
            "_ended": (F.col("_rank") == 0).cast("long"),
            "_begun": (F.col("_rank") == 3).cast("long"),
        }
    )
    met = (
        scan.rows.where(F.col(row).isNotNull())
        .groupBy(row)
        .agg(
            F.max(F.when(F.col("_rank") == 1, F.col("_begun"))).alias("_begun"),
            F.max(F.when(F.col("_rank") == 2, F.col("_ended"))).alias("_ended"),
        )
        .select(row, (F.col("_begun") - F.col("_ended")).alias("windows"))
        .where("windows > 0")
    )
    return subjects.join(met, row)


def high_exposure(
    assignments: DataFrame, equipment: DataFrame, types: DataFrame, category: str = "High Exposure"
) -> DataFrame:
    """Assignments of equipment whose type is in the category."""
    kinds = types.where(F.col("equipment_category") == category).select("equipment_type_id")
    units = equipment.join(kinds, "equipment_type_id", "left_semi").select("equipment_id")
    return assignments.join(units, "equipment_id", "left_semi")


def reassignments(
    rows: DataFrame, key: str, site: str, order: str, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys with more than one row: first and second site, and the step between keys.

    ``sequential`` tells whether the second site is one above that of the key
    before it, keys taken in the order of their first rows.  The rank filter
    lets Spark keep two rows per key before the shuffle.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(order))
    ranked = rows.select(key, site, order).withColumn("_place", place).where("_place <= 2")
    pairs = (
        ranked.groupBy(key)
        .agg(
            F.max(F.when(F.col("_place") == 1, F.col(site))).alias("first_site"),
            F.max(F.when(F.col("_place") == 2, F.col(site))).alias("second_site"),
            F.min(order).alias("_first"),
            F.max("_place").alias("_places"),
        )
        .where("_places = 2")
    )
    scan = OrderedScan(pairs, [], ["_first", key], hot_rows=hot_rows)
    scan.add(previous={"_before": F.col("second_site")})
    return scan.rows.select(
        key,
        "first_site",
        "second_site",
        (~F.col("first_site").eqNullSafe(F.col("second_site"))).alias("moved"),
        F.coalesce(
            F.col("second_site").cast("long") == F.col("_before").cast("long") + 1, F.lit(False)
        ).alias("sequential"),
    )
