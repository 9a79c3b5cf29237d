"""Every rule of the pack on one batch of mutated rows, and engine invariants."""

from datetime import datetime, timezone

import pytest
from operations_data import assignment, clean, frames, schedule, threshold

from touchstone.plans.engine import expanded, validate
from touchstone.plans.operations import LINKS, OPERATIONS
from touchstone.plans.rules import Pack, Rule

MOMENT = datetime(2026, 8, 3, 12, tzinfo=timezone.utc)


def batch():
    """Rows that do not disturb each other, each with the rules it must raise."""
    data, expected = clean(), {}

    def add(entity, row, *rules):
        data[entity].append(row)
        expected[entity, len(data[entity]) - 1] = sorted(rules)

    base = {name: rows[0] for name, rows in data.items()}
    add("regions", base["regions"] | {"region_id": "2", "region_code": ""}, "REG-001", "XEN-010")
    add("regions", base["regions"] | {"region_id": "3", "region_code": "R-3", "region_name": ""}, "REG-003")
    add("regions", base["regions"] | {"region_id": "4", "region_code": "R-4", "region_name": "   "})
    for key in ("5", "6"):
        add("regions", base["regions"] | {"region_id": key, "region_code": "R-5"}, "REG-002", "XEN-009")
    add("regions", base["regions"] | {"region_id": "", "region_code": "R-7"}, "XEN-010")
    add("offices", base["offices"] | {"office_id": "11", "office_code": "", "office_name": ""}, "OFF-001", "OFF-004", "XEN-010")
    add("offices", base["offices"] | {"office_id": "12", "office_code": "O-12", "region_id": "99"}, "OFF-002", "XEN-001")
    add("offices", base["offices"] | {"office_id": "13", "office_code": "O-13", "region_id": None}, "OFF-002", "XEN-001", "XEN-010")
    for key in ("14", "15"):
        add("offices", base["offices"] | {"office_id": key, "office_code": "O-14"}, "OFF-003", "XEN-009")
    add("employees", base["employees"] | {"employee_id": "102", "employee_number": "", "home_office_id": "99"}, "EMP-001", "EMP-002", "XEN-001", "XEN-010")
    for key in ("103", "104"):
        add("employees", base["employees"] | {"employee_id": key, "employee_number": "E-3"}, "EMP-003", "XEN-009")
    add("employees", base["employees"] | {"employee_id": "105", "employee_number": "E-5", "employment_status": "Terminated", "home_office_id": "999"}, "EMP-002", "EMP-004", "XEN-001")
    add("employees", base["employees"] | {"employee_id": "106", "employee_number": "E-6", "employment_status": "Terminated"})
    add("projects", base["projects"] | {"project_id": "21", "project_code": "", "project_name": ""}, "PRJ-001", "PRJ-003", "XEN-010")
    for key in ("22", "23"):
        add("projects", base["projects"] | {"project_id": key, "project_code": "P-2"}, "PRJ-002", "XEN-009")
    add("projects", base["projects"] | {"project_id": "24", "project_code": "P-4", "office_id": "99", "project_manager_employee_id": "x", "field_manager_employee_id": "y"}, "XEN-001", "XEN-001", "XEN-001")
    add("job_sites", base["job_sites"] | {"job_site_id": "31", "job_site_code": "", "project_id": "999", "weather_location_code": "TX-UNKNOWN"}, "JBS-001", "JBS-002", "JBS-004", "XEN-001", "XEN-007", "XEN-010")
    for key in ("32", "33"):
        add("job_sites", base["job_sites"] | {"job_site_id": key, "job_site_code": "S-3"}, "JBS-003", "XEN-009")
    add("job_sites", base["job_sites"] | {"job_site_id": "34", "job_site_code": "S-4", "weather_location_code": None}, "JBS-004", "XEN-007", "XEN-010")
    add("crews", base["crews"] | {"crew_id": "41", "crew_code": "C-41", "crew_lead_employee_id": ""}, "CRW-006")
    add("crews", base["crews"] | {"crew_id": "42", "crew_code": "", "home_office_id": "99", "crew_lead_employee_id": "none"}, "CRW-001", "CRW-002", "CRW-004", "XEN-001", "XEN-001", "XEN-010")
    add("crews", base["crews"] | {"crew_id": "43", "crew_code": "C-43", "crew_lead_employee_id": "105"}, "CRW-004", "CRW-005", "XEN-008")
    for key in ("44", "45"):
        add("crews", base["crews"] | {"crew_id": key, "crew_code": "C-44"}, "CRW-003", "XEN-009")
    add("activities", base["activities"] | {"activity_id": "51", "activity_code": "", "activity_name": ""}, "ACT-001", "ACT-003", "XEN-010")
    for key in ("52", "53"):
        add("activities", base["activities"] | {"activity_id": key, "activity_code": "A-2"}, "ACT-002", "XEN-009")
    add("equipment_types", base["equipment_types"] | {"equipment_type_id": "61", "equipment_type_code": None, "equipment_type_name": None}, "EQT-001", "EQT-003", "XEN-010")
    for key in ("62", "63"):
        add("equipment_types", base["equipment_types"] | {"equipment_type_id": key, "equipment_type_code": "T-2"}, "EQT-002", "XEN-009")
    add("equipment", base["equipment"] | {"equipment_id": "71", "equipment_code": "", "equipment_status": ""}, "EQP-001", "EQP-004", "XEN-010")
    add("equipment", base["equipment"] | {"equipment_id": "72", "equipment_code": "Q-2", "equipment_type_id": "999"}, "EQP-002", "XEN-001")
    for key in ("73", "74"):
        add("equipment", base["equipment"] | {"equipment_id": key, "equipment_code": "Q-3"}, "EQP-003", "XEN-009")

    s = "field_schedules"
    for key, end in enumerate(("2026-02-01T07:00:00", "2026-02-01T06:59:59", "not-a-timestamp", "2026-02-01T15:00:00+00:00"), 2):
        add(s, schedule(key, scheduled_end_timestamp=end), "FSD-001")
    add(s, schedule(6, scheduled_date="2026-02-02"), "FSD-002")
    add(s, schedule(7, scheduled_date="02/01/2026"), "FSD-002")
    add(s, schedule(8, planned_crew_hours="7.999", planned_labor_hours="39.995"), "FSD-003")
    add(s, schedule(9, planned_crew_hours="8.0000004", planned_labor_hours="40"), "FSD-004")
    add(s, schedule(10, planned_crew_hours="8.0000001"))
    add(s, schedule(11, planned_labor_hours="39"), "FSD-004")
    add(s, schedule(12, planned_crew_hours="NaN"), "FSD-003", "FSD-004")
    add(s, schedule(13, project_id="24"), "FSD-005", "XEN-002")
    add(s, schedule(14, status="Unknown"), "FSD-010")
    add(s, schedule(15, status="Rescheduled"), "FSD-007")
    add(s, schedule(16, status="Completed"), "FSD-006")
    add(s, schedule(17, rescheduled_from_schedule_id="16"), "FSD-006")
    add(s, schedule(18, status="Rescheduled"))
    add(s, schedule(19, rescheduled_from_schedule_id="18"))
    add(s, schedule(20, rescheduled_from_schedule_id="20"), "FSD-009", "XEN-004")
    add(s, schedule(21, rescheduled_from_schedule_id="22"), "FSD-009", "XEN-004")
    add(s, schedule(22, rescheduled_from_schedule_id="21"), "FSD-009", "XEN-004")
    add(s, schedule(23, rescheduled_from_schedule_id="22"))
    add(s, schedule(24, rescheduled_from_schedule_id="nowhere"), "XEN-001", "XEN-004")
    add(s, schedule(25, crew_id=None), "XEN-001", "XEN-010")
    for _ in range(2):
        add(s, schedule(26, status="Completed"), "FSD-006", "XEN-009")
    add(s, schedule(27, rescheduled_from_schedule_id="26"), "FSD-006", "FSD-006")
    add(s, schedule(28, scheduled_start_timestamp="2026-02-01T07:00:00+02:00", scheduled_end_timestamp="2026-02-01T13:00:00Z"))

    # Assignments share the open-ended first row's equipment only where they should.
    a = "equipment_assignments"
    for n, end in enumerate(("2026-02-01T06:00:00", "2026-01-31T23:00:00", "bad"), 2):
        add(a, assignment(n, equipment_id="70", assignment_end_timestamp=end), "EQA-001")
    add(a, assignment(5, equipment_id="72", assignment_end_timestamp=""))
    add(a, assignment(6, equipment_id="73", project_id="24"), "EQA-002", "XEN-003")
    add(a, assignment(7, equipment_id="71"), "EQA-003", "XEN-005")
    add(a, assignment(8, equipment_id="71", assignment_start_timestamp="2026-02-01T12:00:00", assignment_end_timestamp=""), "EQA-003", "XEN-005")
    add(a, assignment(9, equipment_id="74"), "EQA-004")
    add(a, assignment(10, equipment_id="74", assignment_start_timestamp="2026-02-01T16:00:00", assignment_end_timestamp="2026-02-02T02:00:00"), "EQA-004")
    add(a, assignment(11, equipment_id="74", assignment_start_timestamp="2026-02-01T06:00:00Z", assignment_end_timestamp="2026-02-01T16:00:00Z"))
    add(a, assignment("", equipment_id="none"), "XEN-001", "XEN-010")

    t = "safety_thresholds"
    add(t, threshold(2, severity="S2", effective_end_date="2025-12-31"), "SFT-001")
    add(t, threshold(3, severity="S3", effective_end_date="2026-01-31"))
    add(t, threshold(4, severity="S3", effective_start_date="2026-02-01"))
    for n, kind in ((5, ""), (7, "60")):
        add(t, threshold(n, severity="S5", equipment_type_id=kind), "SFT-002", "XEN-006")
        add(t, threshold(n + 1, severity="S5", equipment_type_id=kind, effective_start_date="2026-02-01"), "SFT-002", "XEN-006")
    code = dict(metric_code="WEATHER_CODE", comparison_operator="IN", unit="wmo_code", threshold_value_or_code_set="95|96", threshold_value="", weather_code_set="95|96", override_flag="True")
    add(t, threshold(9, severity="CRITICAL", **code))
    add(t, threshold(10, severity="S10", **code | {"comparison_operator": ">="}), "SFT-003")
    add(t, threshold(11, severity="S11", **code | {"weather_code_set": "", "threshold_value": "95"}), "SFT-004")
    add(t, threshold(12, severity="S12", threshold_value="not-numeric"), "SFT-005")
    add(t, threshold(13, severity="S13", weather_code_set="95"), "SFT-005")
    add(t, threshold(14, severity="S14", recommended_action_code=""), "SFT-006", "XEN-010")
    add(t, threshold(15, severity="CRITICAL"), "SFT-007")
    add(t, threshold(16, severity="S16"), "SFT-002", "SFT-008", "XEN-006")
    add(t, threshold(17, severity="S16", threshold_value="40"), "SFT-002", "SFT-008", "XEN-006")
    add(t, threshold(18, severity="S16", is_active="true"))
    add(t, threshold(19, severity="S19", metric_code="OTHER", comparison_operator="<"))
    add(t, threshold(20, severity="S20", comparison_operator="<"), "SFT-003")
    add(t, threshold(21, severity="S21", equipment_type_id="999"), "XEN-001")
    return data, expected


@pytest.fixture(scope="module")
def outcome(spark):
    data, expected = batch()
    tables = frames(spark, data)
    return data, expected, validate(tables, OPERATIONS, "rules", validation_timestamp=MOMENT)


def test_each_row_raises_exactly_its_rules(outcome):
    data, expected, result = outcome
    actual = {}
    for r in expanded(result.findings).collect():
        actual.setdefault((r.entity, r._row_index), []).append(r.rule_id)
    actual = {k: sorted(v) for k, v in actual.items()}
    assert actual == {k: v for k, v in expected.items() if v}
    seen = {rule for rules in actual.values() for rule in rules}
    assert seen == {r.rule_id for r in OPERATIONS.rules}


def test_messages_and_record_ids(outcome):
    _, _, result = outcome
    rows = {(r.entity, r.record_id, r.rule_id): r.message for r in result.findings.collect()}
    assert rows["regions", "5", "REG-002"] == "duplicate regions.region_code: 'R-5'"
    assert rows["regions", "5", "XEN-009"] == "duplicate business key regions.region_code: 'R-5'"
    assert ("regions", "row:6", "XEN-010") in rows
    assert rows["offices", "12", "OFF-002"] == "offices.region_id does not resolve to regions.region_id"


def test_disposition_and_summaries_agree(outcome):
    data, expected, result = outcome
    critical = {r.rule_id for r in OPERATIONS.rules if r.severity == "Critical"}
    summary = {r.entity: r for r in result.summary().collect()}
    for name, rows in data.items():
        bad = {i for (e, i), rules in expected.items() if e == name and critical & set(rules)}
        line = summary[name]
        assert (line.rows_read, line.rows_quarantined, line.rows_accepted) == (len(rows), len(bad), len(rows) - len(bad))
        assert line.critical_result_count == sum(r in critical for (e, _), rules in expected.items() if e == name for r in rules)
        assert line.status == ("PARTIAL_SUCCESS" if bad else "SUCCEEDED")
    run = result.run_summary().first()
    assert run.rows_read == sum(len(rows) for rows in data.values())
    accepted = result.accepted("regions").collect()
    assert {r.region_id for r in accepted} == {"1", "3", "4"}
    assert set(accepted[0].asDict()) == {"_row_index", "region_id", "region_code", "region_name"}
    quarantine = {r.record_id: r for r in result.quarantine("job_sites").collect()}
    assert quarantine["31"].critical_rule_ids == '["JBS-001","JBS-002","JBS-004","XEN-001","XEN-007","XEN-010"]'
    evidence = result.evidence().where("rule_id = 'REG-003'").first()
    assert evidence.outcome == "FLAGGED"
    assert evidence.source_record == '{"region_code":"R-3","region_id":"3","region_name":""}'


def test_registry_contract():
    assert len(OPERATIONS.rules) == 65 and len(LINKS) == 19
    assert sum(link.nullable for link in LINKS) == 3
    by_severity = [sum(r.severity == s for r in OPERATIONS.rules) for s in ("Critical", "Warning", "Info")]
    assert by_severity == [53, 11, 1]
    with pytest.raises(ValueError):
        OPERATIONS.rule("FSD-008")
    assert OPERATIONS.entity("  Regions ").name == "regions"
    with pytest.raises(ValueError):
        OPERATIONS.entity("unknown")
    rule = Rule("A", "e", "Critical", "x", "C")
    with pytest.raises(RuntimeError):
        Pack([rule, rule], [])


def test_scope_and_argument_errors(spark):
    tables = frames(spark, clean())
    with pytest.raises(ValueError, match="run_id"):
        validate(tables, OPERATIONS, "")
    master = {k: v for k, v in tables.items() if k in OPERATIONS.scopes["master"]}
    with pytest.raises(ValueError, match="field_schedules"):
        validate(master, OPERATIONS, "r")
    result = validate(master, OPERATIONS, "r", scope="master", keep=False)
    assert result.entities == OPERATIONS.scopes["master"]
