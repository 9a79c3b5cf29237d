"""Per-entity ingestion records, run status, and queries over them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchstone.operators.upsert import upsert
from touchstone.plans.rules import Pack
from touchstone.sources.landing import LandingError, destination, iso_day, land, source_checksum

MONITORING_TABLE = "monitoring_operational_ingestion_runs"
MONITORING_KEYS = ("run_id", "ingestion_date", "entity_name")
MONITORING_SCHEMA = (
    "run_id string, ingestion_date date, entity_name string, source_path string, "
    "destination_path string, row_count long, checksum_sha256 string, status string, "
    "error_type string, error_message string, started_at timestamp, completed_at timestamp, "
    "duration_seconds double"
)


@dataclass(frozen=True)
class IngestionReport:
    """One record per entity, as stored in the monitoring table; counts follow from them."""

    records: tuple[dict, ...]

    @property
    def landed(self) -> int:
        return len([r for r in self.records if r["status"] == "SUCCEEDED"])

    @property
    def failed(self) -> int:
        return len(self.records) - self.landed

    @property
    def status(self) -> str:
        if self.landed and self.failed:
            return "PARTIAL_SUCCESS"
        return "SUCCEEDED" if self.landed else "FAILED"


class NothingLandedError(LandingError):
    """No entity of a run could be landed; its records are stored all the same."""

    def __init__(self, report: IngestionReport) -> None:
        super().__init__("no entity was landed: " + "; ".join(f"{r['entity_name']}: {r['error_message']}" for r in report.records))
        self.report = report


def _now() -> datetime:
    return datetime.now(timezone.utc)


@contextmanager
def _timed(record: dict, clock: Callable[[], datetime]) -> Iterator[None]:
    """Times of one attempt; an error becomes part of the record."""
    record["started_at"] = clock()
    try:
        yield
        record["status"] = "SUCCEEDED"
    except Exception as exc:  # One entity's failure must not stop the others.
        record.update(status="FAILED", error_type=type(exc).__name__, error_message=str(exc))
    record["completed_at"] = clock()
    record["duration_seconds"] = max(0.0, (record["completed_at"] - record["started_at"]).total_seconds())


def land_monitored(
    spark: SparkSession,
    pack: Pack,
    sources: Mapping[str, str],
    ingestion_date: date | str,
    run_id: str,
    *,
    root: str,
    table: str = MONITORING_TABLE,
    overwrite: bool = False,
    clock: Callable[[], datetime] = _now,
    parallel: int = 4,
) -> IngestionReport:
    """Try every entity, store one record each, and fail only when all failed.

    Entities are independent jobs, so a few are submitted at a time.  A checksum
    that can't be taken does not undo a landing: the record tells the error.
    """
    day = date.fromisoformat(iso_day(ingestion_date))
    columns = [part.split()[0] for part in MONITORING_SCHEMA.split(", ")]

    def try_entity(name: str) -> dict:
        path = str(sources.get(name) or "")
        record = dict.fromkeys(columns) | {
            "run_id": run_id, "ingestion_date": day, "entity_name": name, "source_path": path, "destination_path": "",
        }
        with _timed(record, clock):
            record["destination_path"] = destination(pack.entity(name), day, run_id, root)
            if not path:
                raise LandingError(f"the run names no source of {name}")
            record["row_count"] = land(spark, pack, name, path, day, run_id, root=root, overwrite=overwrite).row_count
            try:
                record["checksum_sha256"] = source_checksum(spark, path)
            except Exception as exc:  # The rows are landed whatever becomes of the checksum.
                record.update(error_type="Checksum" + type(exc).__name__, error_message=str(exc))
        return record

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        report = IngestionReport(tuple(pool.map(try_entity, pack.entities)))
    rows = [tuple(map(record.get, columns)) for record in report.records]
    upsert(spark.createDataFrame(rows, MONITORING_SCHEMA), table, MONITORING_KEYS, partition_by=["ingestion_date"])
    if not report.landed:
        raise NothingLandedError(report)
    return report


def run_status(records: DataFrame) -> DataFrame:
    """Status of each run from its entity records."""
    good = F.count_if(F.col("status") == "SUCCEEDED")
    return (
        records.groupBy("run_id", "ingestion_date")
        .agg(good.alias("succeeded_count"), (F.count(F.lit(1)) - good).alias("failed_count"))
        .withColumn(
            "status",
            F.when(F.col("failed_count") == 0, "SUCCEEDED")
            .when(F.col("succeeded_count") > 0, "PARTIAL_SUCCESS")
            .otherwise("FAILED"),
        )
    )


def complete_runs(records: DataFrame, ingestion_date: date | str, entities: int) -> DataFrame:
    """The newest run of a date in which every entity succeeded, at most one row."""
    good = records.where(
        (F.col("ingestion_date") == F.lit(iso_day(ingestion_date)).cast("date"))
        & (F.col("status") == "SUCCEEDED")
    )
    return (
        good.groupBy("run_id")
        .agg(
            F.max("completed_at").alias("completed_at"),
            F.count_distinct("entity_name").alias("_entities"),
        )
        .where(F.col("_entities") == entities)
        .drop("_entities")
        .orderBy(F.desc("completed_at"), F.desc("run_id"))
        .limit(1)
    )


def latest_complete_run(
    spark: SparkSession, pack: Pack, ingestion_date: date | str, table: str = MONITORING_TABLE
) -> str:
    found = complete_runs(spark.table(table), ingestion_date, len(pack.entities)).first()
    if found is None:
        raise RuntimeError(
            f"No successful complete Bronze run was found in {table} for ingestion_date={iso_day(ingestion_date)}"
        )
    return found["run_id"]


def status_rollup(records: DataFrame, run_id: str | None = None) -> DataFrame:
    rows = records if run_id is None else records.where(F.col("run_id") == run_id)
    return rows.groupBy("status").agg(
        F.count(F.lit(1)).alias("entity_count"), F.sum("row_count").alias("row_count")
    )


def severity_rollup(findings: DataFrame, run_id: str | None = None) -> DataFrame:
    rows = findings if run_id is None else findings.where(F.col("run_id") == run_id)
    return rows.groupBy("severity").agg(F.sum("occurrences").alias("finding_count"))


def finding_evidence(findings: DataFrame, run_id: str) -> DataFrame:
    """The findings of a run in reading order; ``occurrences`` says how often each applies."""
    return (
        findings.where(F.col("run_id") == run_id)
        .select("entity", "record_id", "rule_id", "error_code", "severity", "outcome", "occurrences")
        .orderBy("entity", "record_id", "rule_id")
    )
