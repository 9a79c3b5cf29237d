"""Outputs of a validation run, as folders or catalog tables, in any format Spark writes.

A place with a slash is a folder, any other a table.  Findings and quarantine are
partitioned by run, and a run replaces only its own partition, so repeating it
changes nothing.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchstone.plans.engine import Result


def _is_folder(place: str) -> bool:
    return "/" in place


def write_accepted(result: Result, place: str, *, source_format: str = "parquet") -> None:
    """Replace each entity's accepted rows, also when none are left.

    Folders get one subfolder per entity; tables are named ``<place>_<entity>``.
    """
    for name in result.entities:
        writer = result.accepted(name).write.mode("overwrite").format(source_format)
        if _is_folder(place):
            writer.save(f"{place}/{name}")
        else:
            writer.saveAsTable(f"{place}_{name}")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _write_run(rows: DataFrame, run_id: str, place: str, source_format: str) -> None:
    if _is_folder(place):
        rows.drop("run_id").write.mode("overwrite").format(source_format).partitionBy("entity").save(f"{place}/run_id={run_id}")
        return
    spark = rows.sparkSession
    if spark.catalog.tableExists(place):
        run = _literal(run_id)
        # One partition per entity of the run, dropped by its full name.
        for row in spark.sql(f"SHOW PARTITIONS {place} PARTITION (run_id = {run})").collect():
            entity = _literal(unquote(row["partition"].rsplit("entity=", 1)[1]))
            spark.sql(f"ALTER TABLE {place} DROP PARTITION (run_id = {run}, entity = {entity})")
    columns = [c for c in rows.columns if c not in ("run_id", "entity")]
    keyed = rows.select(*columns, F.lit(run_id).alias("run_id"), "entity")
    keyed.write.mode("append").format(source_format).partitionBy("run_id", "entity").saveAsTable(place)


def write_findings(result: Result, place: str, *, source_format: str = "parquet") -> None:
    _write_run(result.evidence(), result.run_id, place, source_format)


def write_quarantine(result: Result, place: str, *, source_format: str = "parquet") -> None:
    _write_run(result.quarantine(), result.run_id, place, source_format)
