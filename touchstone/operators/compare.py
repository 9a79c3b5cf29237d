"""Expected-against-actual comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multiset_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with both counts; empty when equal.

    One shuffle with map-side combination, whatever the number of copies.
    """
    columns = expected.columns
    tagged = expected.select(*columns, F.lit(1).alias("_e"), F.lit(0).alias("_a")).unionByName(
        actual.select(*columns, F.lit(0).alias("_e"), F.lit(1).alias("_a"))
    )
    return (
        tagged.groupBy(*columns)
        .agg(F.sum("_e").alias("expected_count"), F.sum("_a").alias("actual_count"))
        .where("expected_count <> actual_count")
    )
