"""Incremental form of the forecast run: only files not seen before are read.

The batch form reads every file on every run and relies on the keyed upsert to
change nothing twice.  The stream keeps the same upsert, so a batch that is
repeated after a failure has no effect, and adds the file source's memory of
what was read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchstone.operators.upsert import upsert
from touchstone.plans.weather import KEYS, flatten
from touchstone.sources.weather_json import RECORD_FILE, split_records


def upsert_new_forecasts(
    spark: SparkSession,
    root: str,
    table: str,
    checkpoint: str,
    *,
    mode: str = "strict",
    rejected_root: str | None = None,
    max_files: int = 10_000,
) -> StreamingQuery:
    """Read the new files below ``root`` and upsert their hours into ``table``.

    Ends when everything there has been read.  Batches run in a session of their
    own, so refresh the table before reading it in this one.  In ``quarantine`` mode the
    reasons of kept-out records go to ``rejected_root``, one folder per batch; it
    must be given.  A backlog is read ``max_files`` files at a time.
    """
    if mode == "quarantine" and not rejected_root:
        raise ValueError("quarantine mode needs a folder for the rejected records")
    texts = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(root)
        .select("value", F.col("_metadata.file_path").alias(RECORD_FILE))
    )
    records = split_records(texts)

    def store(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        split = flatten(batch, mode)
        if rejected_root:
            split.rejected.write.mode("overwrite").parquet(f"{rejected_root}/batch={number}")
        if not split.rows.isEmpty():
            upsert(split.rows, table, KEYS, partition_by=["pipeline_run_id"], settled=True)

    return (
        records.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
