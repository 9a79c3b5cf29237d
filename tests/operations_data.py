"""Clean one-row tables of the operations pack, and helpers to change them."""

from touchstone.plans.operations import OPERATIONS
from touchstone.plans.rules import ROW


def schedule(key=1, **changes):
    row = dict(
        field_schedule_id=str(key), project_id="20", job_site_id="30", crew_id="40", activity_id="50",
        scheduled_start_timestamp="2026-02-01T07:00:00", scheduled_end_timestamp="2026-02-01T15:00:00",
        scheduled_date="2026-02-01", planned_crew_hours="8", planned_crew_size="5",
        planned_labor_hours="40", status="Scheduled", rescheduled_from_schedule_id="",
    )
    return row | changes


def assignment(key=1, **changes):
    row = dict(
        assignment_id=str(key), equipment_id="70", job_site_id="30", project_id="20",
        assignment_start_timestamp="2026-02-01T06:00:00", assignment_end_timestamp="2026-02-01T16:00:00",
    )
    return row | changes


def threshold(key=1, **changes):
    row = dict(
        threshold_id=str(key), activity_id="50", equipment_type_id="", metric_code="WIND_GUST_MPH",
        comparison_operator=">=", unit="mph", threshold_value_or_code_set="35", threshold_value="35",
        weather_code_set="", severity="HIGH", recommended_action_code="DELAY_WORK",
        effective_start_date="2026-01-01", effective_end_date="", is_active="True", override_flag="False",
    )
    return row | changes


def clean():
    return {
        "regions": [dict(region_id="1", region_code="R-1", region_name="North")],
        "offices": [dict(office_id="10", office_code="O-1", office_name="Main", region_id="1")],
        "employees": [
            dict(employee_id="100", employee_number="E-1", employee_name="Lead", home_office_id="10", employment_status="Active"),
            dict(employee_id="101", employee_number="E-2", employee_name="Manager", home_office_id="10", employment_status="Active"),
        ],
        "projects": [dict(project_id="20", project_code="P-1", project_name="Project", office_id="10", project_manager_employee_id="101", field_manager_employee_id="101", status="Active")],
        "job_sites": [dict(job_site_id="30", job_site_code="S-1", job_site_name="Site", project_id="20", weather_location_code="TX-DAL")],
        "crews": [dict(crew_id="40", crew_code="C-1", home_office_id="10", crew_lead_employee_id="100", crew_status="Active")],
        "activities": [dict(activity_id="50", activity_code="A-1", activity_name="Work")],
        "equipment_types": [dict(equipment_type_id="60", equipment_type_code="T-1", equipment_type_name="Crane")],
        "equipment": [dict(equipment_id="70", equipment_code="Q-1", equipment_type_id="60", equipment_status="Available")],
        "field_schedules": [schedule()],
        "equipment_assignments": [assignment()],
        "safety_thresholds": [threshold()],
    }


def frames(spark, data):
    out = {}
    for name, rows in data.items():
        columns = list(rows[0]) if rows else list(OPERATIONS.entity(name).columns)
        for row in rows:
            columns += [c for c in row if c not in columns]
        schema = f"{ROW} long, " + ", ".join(f"{c} string" for c in columns)
        out[name] = spark.createDataFrame(
            [(i, *[r.get(c) for c in columns]) for i, r in enumerate(rows)], schema
        )
    return out
