"""Checks of the location table."""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchstone.operators.keys import duplicates

COLUMNS = ("location_id", "location_name", "latitude", "longitude", "timezone", "active")


def out_of_range(value, low: float, high: float):
    """Not a number, or outside the closed range."""
    number = value.try_cast("double")
    return ~F.coalesce((number >= low) & (number <= high), F.lit(False))


def location_violations(locations: DataFrame) -> DataFrame:
    """One row per location and reason; empty when the table is sound, which an empty table is not."""
    absent = [c for c in COLUMNS if c not in locations.columns]
    if absent:
        raise ValueError(f"locations are missing required fields: {sorted(absent)}")
    # The zone names come from the time zone database: a few hundred, whatever the table.
    zones = locations.sparkSession.createDataFrame(
        [(z,) for z in sorted(available_timezones())], "_zone string"
    )
    known = locations.join(F.broadcast(zones), locations["timezone"] == zones["_zone"], "left")

    def blank(name: str):
        return F.coalesce(F.trim(F.col(name).cast("string")) == "", F.lit(True))

    flag = F.lower(F.col("active").cast("string"))
    reasons = [
        (blank("location_id"), "location_id must be a non-empty string."),
        (blank("location_name"), "location_name must be a non-empty string."),
        (out_of_range(F.col("latitude"), -90, 90), "latitude must be between -90 and 90."),
        (out_of_range(F.col("longitude"), -180, 180), "longitude must be between -180 and 180."),
        (blank("timezone"), "timezone must be a non-empty string."),
        (~blank("timezone") & F.col("_zone").isNull(), "timezone is not valid."),
        (~F.coalesce(flag.isin("true", "false"), F.lit(False)), "active must be true or false."),
    ]
    entries = F.array_compact(F.array(*[F.when(bad, F.lit(text)) for bad, text in reasons]))
    broken = known.select("location_id", F.explode(entries).alias("reason"))
    repeated = duplicates(locations.select("location_id"), "location_id")
    none = locations.agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    none = none.select(F.lit(None).cast(locations.schema["location_id"].dataType).alias("location_id"), F.lit("no location is configured").alias("reason"))
    return broken.unionByName(repeated.withColumn("reason", F.lit("Duplicate location_id found."))).unionByName(none)


def active_locations(locations: DataFrame) -> DataFrame:
    return locations.where(F.lower(F.col("active").cast("string")) == "true")
