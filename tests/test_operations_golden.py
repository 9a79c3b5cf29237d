"""A 921-row batch with four mutations: nine findings, three quarantined rows.

``GOLDEN_OPERATIONS_DIR`` runs the same checks on CSV files instead.
"""

import os
from datetime import datetime, timezone

import pytest
from golden_data import mutated_batch
from operations_data import frames
from pyspark.sql import functions as F

from touchstone.operators import multiset_difference
from touchstone.plans.engine import validate
from touchstone.plans.operations import OPERATIONS
from touchstone.plans.rules import ROW

FOLDER = os.environ.get("GOLDEN_OPERATIONS_DIR")

EXPECTED = [
    ("regions", "1", "REG-003", "Warning"),
    ("job_sites", "1", "JBS-004", "Critical"),
    ("job_sites", "1", "XEN-007", "Critical"),
    ("equipment_assignments", "1", "EQA-004", "Info"),
    ("equipment_assignments", "2", "EQA-003", "Critical"),
    ("equipment_assignments", "2", "XEN-005", "Critical"),
    ("equipment_assignments", "81", "EQA-004", "Info"),
    ("equipment_assignments", "82", "EQA-003", "Critical"),
    ("equipment_assignments", "82", "XEN-005", "Critical"),
]


@pytest.fixture(scope="module")
def result(spark):
    if FOLDER:
        tables = {
            name: spark.read.option("header", True)
            .csv(f"{FOLDER}/{name}.csv")
            .coalesce(1)
            .withColumn(ROW, F.monotonically_increasing_id())
            for name in OPERATIONS.entities
        }
    else:
        tables = frames(spark, mutated_batch())
    return validate(
        tables, OPERATIONS, "golden", validation_timestamp=datetime(2026, 8, 3, tzinfo=timezone.utc)
    )


def test_nine_findings(spark, result):
    expected = spark.createDataFrame(EXPECTED, "entity string, record_id string, rule_id string, severity string")
    assert multiset_difference(expected, result.findings.select(*expected.columns)).isEmpty()


def test_totals(result):
    run = result.run_summary().first()
    assert (run.rows_read, run.rows_accepted, run.rows_quarantined) == (921, 918, 3)
    assert (run.critical_result_count, run.warning_result_count, run.info_result_count) == (6, 1, 2)
    assert run.status == "PARTIAL_SUCCESS"
    accepted = {n: result.accepted(n).count() for n in ("job_sites", "equipment_assignments", "regions")}
    assert accepted == {"job_sites": 119, "equipment_assignments": 118, "regions": 4}


def test_quarantine_records(result):
    rows = {(r.entity, r.record_id): r for r in result.quarantine().collect()}
    assert set(rows) == {("job_sites", "1"), ("equipment_assignments", "2"), ("equipment_assignments", "82")}
    assert rows["job_sites", "1"].critical_rule_ids == '["JBS-004","XEN-007"]'
    assert '"weather_location_code":"TX-UNKNOWN"' in rows["job_sites", "1"].source_record_json
