"""Gates, coverage analytics, locations and the incremental forecast run."""

import json
import random
import statistics

import pytest
from golden_data import COUNTS, clean_batch, mutated_batch
from operations_data import clean, frames
from pyspark.sql import functions as F
from test_weather import record, store

from touchstone.plans.analytics import exposed, high_exposure, load_dispersion, reassignments, uncovered
from touchstone.plans.gates import GateError, accepted_dataset, require_accepted
from touchstone.plans.locations import active_locations, location_violations
from touchstone.streaming import upsert_new_forecasts


def test_gate_accepts_the_clean_batch_and_rejects_two_mutations(spark):
    assert accepted_dataset(frames(spark, clean_batch()), row_counts=COUNTS).isEmpty()
    got = accepted_dataset(frames(spark, mutated_batch()), row_counts={**COUNTS, "regions": 5}).collect()
    assert {(r.entity, r.reason): r.failures for r in got} == {
        ("job_sites", "invalid weather location"): 1,
        ("equipment_assignments", "overlapping equipment assignment"): 2,
        ("regions", "regions expected 5 rows"): 4,
    }


def test_gate_reasons(spark):
    data = clean()
    data["projects"][0] |= {"project_start_date": "2026-02-01", "project_end_date": "2026-01-01"}
    data["crews"][0]["crew_lead_employee_id"] = ""
    data["field_schedules"][0] |= {"project_id": "999", "planned_crew_hours": "7", "rescheduled_from_schedule_id": "1"}
    data["safety_thresholds"].append(data["safety_thresholds"][0] | {"threshold_id": "2", "is_active": "False"})
    data["regions"].append(dict(region_id="", region_code="R-1", region_name=""))
    tables = frames(spark, data)
    got = {(r.entity, r.reason): r.failures for r in accepted_dataset(tables, scenarios=("normal_operations",)).collect()}
    assert got == {
        ("projects", "invalid project dates"): 1,
        ("crews", "crew lead must be active"): 1,
        ("field_schedules", "field_schedules.project_id does not resolve to projects.project_id"): 1,
        ("field_schedules", "schedule project/site mismatch"): 1,
        ("field_schedules", "crew hours differ from duration"): 1,
        ("field_schedules", "invalid planned labor hours"): 1,
        ("field_schedules", "invalid reschedule predecessor"): 1,
        ("field_schedules", "predecessor must be Rescheduled"): 1,
        ("field_schedules", "cyclic reschedule lineage"): 1,
        ("field_schedules", "missing scenario coverage: normal_operations"): 1,
        ("equipment_assignments", "missing relocation scenario: equipment_relocation"): 1,
        ("safety_thresholds", "overlapping/ambiguous active threshold"): 2,
        ("regions", "regions.region_id is required"): 1,
        ("regions", "duplicate regions.region_code"): 2,
    }
    with pytest.raises(GateError):
        require_accepted(tables, scenarios=())
    with pytest.raises(GateError):
        accepted_dataset({"regions": tables["regions"]})


@pytest.mark.parametrize("hot", [4_000_000, 5])
def test_exposed_and_reassignments(spark, hot):
    rng = random.Random(3)
    subjects = [(i, (s := rng.randint(0, 200)), s + rng.randint(1, 9)) for i in range(40)]
    windows = [(i, (s := rng.randint(0, 200)), s + rng.randint(1, 5)) for i in range(30)]
    left = spark.createDataFrame(subjects, "i long, s long, e long")
    right = spark.createDataFrame(windows, "w long, b long, f long")
    got = exposed(left, right, ("s", "e"), ("b", "f"), "i", hot_rows=hot).collect()
    expected = {i: sum(s < f and b < e for _, b, f in windows) for i, s, e in subjects}
    assert {r.i: r.windows for r in got} == {i: n for i, n in expected.items() if n}

    rows = [(i, f"k{rng.randint(0, 20)}", str(rng.randint(1, 6))) for i in range(60)]
    got = reassignments(spark.createDataFrame(rows, "i long, k string, site string"), "k", "site", "i", hot_rows=hot)
    # The rank filter works before the shuffle, so a hot key sends two rows per task.
    assert hot == 5 or "WindowGroupLimit" in got._jdf.queryExecution().toString()
    by_key = {}
    for _, k, site in rows:
        by_key.setdefault(k, []).append(site)
    kept = [(k, v) for k, v in by_key.items() if len(v) > 1]
    expected = {
        k: (v[0], v[1], v[0] != v[1], n > 0 and int(v[1]) == int(kept[n - 1][1][1]) + 1)
        for n, (k, v) in enumerate(kept)
    }
    assert {r.k: (r.first_site, r.second_site, r.moved, r.sequential) for r in got.collect()} == expected


def test_dispersion_coverage_and_category(spark):
    rows = [(random.Random(n).choice("aabcc"), n) for n in range(40)]
    frame = spark.createDataFrame(rows, "k string, n int")
    sizes = [sum(k == c for k, _ in rows) for c in set(k for k, _ in rows)]
    one = load_dispersion(frame, "k").first()
    assert (one.groups, one.least, one.most) == (len(sizes), min(sizes), max(sizes))
    assert one.deviation == pytest.approx(statistics.pstdev(sizes))
    population = spark.createDataFrame([("a",), ("z",)], "id string")
    assert [r.id for r in uncovered(population, "id", frame, "k").collect()] == ["z"]
    tables = frames(spark, clean())
    types = tables["equipment_types"].withColumn("equipment_category", F.lit("High Exposure"))
    assert high_exposure(tables["equipment_assignments"], tables["equipment"], types).count() == 1
    assert high_exposure(tables["equipment_assignments"], tables["equipment"], types, "Standard").isEmpty()


def test_locations(spark):
    rows = [
        ("A", "Dallas", 32.7, -96.8, "America/Chicago", True),
        ("B", " ", 91.0, -181.0, "Mars/Base", True),
        ("C", "x", None, 0.0, "", None),
        ("D", "x", 0.0, 0.0, "UTC", False),
        ("D", "x", 0.0, 0.0, "UTC", False),
    ]
    frame = spark.createDataFrame(rows, "location_id string, location_name string, latitude double, longitude double, timezone string, active boolean")
    got = sorted((r.location_id, r.reason) for r in location_violations(frame).collect())
    assert got == sorted(
        [
            ("B", "location_name must be a non-empty string."), ("B", "latitude must be between -90 and 90."),
            ("B", "longitude must be between -180 and 180."), ("B", "timezone is not valid."),
            ("C", "latitude must be between -90 and 90."), ("C", "timezone must be a non-empty string."),
            ("C", "active must be true or false."),
            ("D", "Duplicate location_id found."), ("D", "Duplicate location_id found."),
        ]
    )
    assert [r.location_id for r in active_locations(frame).collect()] == ["A", "B"]
    with pytest.raises(ValueError, match="timezone"):
        location_violations(frame.drop("timezone"))
    assert [(r.location_id, r.reason) for r in location_violations(frame.limit(0)).collect()] == [(None, "no location is configured")]


def test_incremental_forecasts(spark, tmp_path):
    root, table = tmp_path / "w", "stream_hours"
    rejected, checkpoint = str(tmp_path / "rejected"), str(tmp_path / "progress")
    store(root, [record(), record(pipeline_run_id="run-2")])

    def go():
        upsert_new_forecasts(spark, str(root), table, checkpoint, mode="quarantine", rejected_root=rejected).awaitTermination()
        spark.catalog.refreshTable(table)  # batches write from a session of their own
        return spark.table(table)

    assert go().count() == 6
    (root / "late.json").write_text(json.dumps(record(pipeline_run_id="run-3")))
    (root / "again.json").write_text(json.dumps(record(payload__hourly__weather_code=[7, 7, 7])))
    (root / "bad.json").write_text('{"location_id": 1}')
    rows = go()
    assert rows.count() == 9
    assert {r.weather_code for r in rows.where("pipeline_run_id = 'run-1'").collect()} == {7}
    assert spark.read.parquet(rejected).count() == 1
    spark.sql(f"DROP TABLE {table}")
