"""A clean 921-row batch of the 12 operations tables and its four mutations."""

from datetime import date, datetime, timedelta

from touchstone.plans.gates import SCENARIOS
from touchstone.plans.operations import WEATHER_LOCATIONS

COUNTS = {
    "regions": 4, "offices": 12, "employees": 150, "projects": 75, "job_sites": 120, "crews": 40,
    "activities": 20, "equipment_types": 10, "equipment": 80, "field_schedules": 250,
    "equipment_assignments": 120, "safety_thresholds": 40,
}
# Predecessor -> successor.
LINKS = {1: 242, 2: 243, 3: 244, 244: 245, 4: 246, 246: 247, 5: 248, 248: 249, 249: 250}


def _text(moment):
    return moment.strftime("%Y-%m-%dT%H:%M:%S")


def clean_batch():
    def rows(name, make):
        return [{k: str(v) for k, v in make(i).items()} for i in range(1, COUNTS[name] + 1)]

    def office(i):
        return (i - 1) % 12 + 1

    def project(site):
        return (site - 1) % 75 + 1

    def schedule(i):
        site = (i - 1) % 120 + 1
        day = date(2026, 1, 5) + timedelta(days=i)
        before = {b: a for a, b in LINKS.items()}
        return dict(
            field_schedule_id=i, project_id=project(site), job_site_id=site, crew_id=(i - 1) % 40 + 1,
            activity_id=(i - 1) % 20 + 1, scheduled_start_timestamp=f"{day}T07:00:00",
            scheduled_end_timestamp=f"{day}T15:00:00", scheduled_date=day, planned_crew_hours=8,
            planned_crew_size=4, planned_labor_hours=32, status="Rescheduled" if i in LINKS else "Scheduled",
            rescheduled_from_schedule_id=before.get(i, ""), scenario_id=SCENARIOS[i % len(SCENARIOS)],
        )

    def assignment(i):
        site, start = (i * 7) % 120 + 1, datetime(2026, 2 + (i > 80), 1, 6) + timedelta(days=i % 20)
        return dict(
            assignment_id=i, equipment_id=(i - 1) % 80 + 1, job_site_id=site, project_id=project(site),
            assignment_start_timestamp=_text(start), assignment_end_timestamp=_text(start + timedelta(hours=10)),
            assignment_note="planned", scenario_id="equipment_relocation" if i == 1 else "normal_operations",
        )

    def threshold(i):
        by_code = i > 20
        return dict(
            threshold_id=i, activity_id=(i - 1) % 20 + 1, equipment_type_id="",
            metric_code="WEATHER_CODE" if by_code else "WIND_GUST_MPH", comparison_operator="IN" if by_code else ">=",
            unit="wmo_code" if by_code else "mph", threshold_value_or_code_set="95|96" if by_code else 35,
            threshold_value="" if by_code else 35, weather_code_set="95|96" if by_code else "",
            severity="CRITICAL" if by_code else "HIGH", recommended_action_code="STOP" if by_code else "DELAY",
            effective_start_date="2026-01-01", effective_end_date="", is_active="True", override_flag=by_code,
        )

    return {
        "regions": rows("regions", lambda i: dict(region_id=i, region_code=f"R{i}", region_name=f"Region {i}")),
        "offices": rows("offices", lambda i: dict(office_id=i, office_code=f"O{i}", office_name=f"Office {i}", region_id=(i - 1) % 4 + 1)),
        "employees": rows("employees", lambda i: dict(employee_id=i, employee_number=f"E{i}", employee_name=f"Person {i}", home_office_id=office(i), employment_status="Active")),
        "projects": rows("projects", lambda i: dict(project_id=i, project_code=f"P{i}", project_name=f"Project {i}", office_id=office(i), project_manager_employee_id=i, field_manager_employee_id=i + 75, status="Active", project_start_date="2026-01-01", project_end_date="2026-12-31")),
        "job_sites": rows("job_sites", lambda i: dict(job_site_id=i, job_site_code=f"S{i}", job_site_name=f"Site {i}", project_id=project(i), weather_location_code=WEATHER_LOCATIONS[i % 3])),
        "crews": rows("crews", lambda i: dict(crew_id=i, crew_code=f"C{i}", home_office_id=office(i), crew_lead_employee_id=i, crew_status="Active")),
        "activities": rows("activities", lambda i: dict(activity_id=i, activity_code=f"A{i}", activity_name=f"Work {i}")),
        "equipment_types": rows("equipment_types", lambda i: dict(equipment_type_id=i, equipment_type_code=f"T{i}", equipment_type_name=f"Type {i}", equipment_category="High Exposure" if i == 1 else "Standard")),
        "equipment": rows("equipment", lambda i: dict(equipment_id=i, equipment_code=f"Q{i}", equipment_type_id=(i - 1) % 10 + 1, equipment_status="Available")),
        "field_schedules": rows("field_schedules", schedule),
        "equipment_assignments": rows("equipment_assignments", assignment),
        "safety_thresholds": rows("safety_thresholds", threshold),
    }


def mutated_batch():
    """A name is blank, a location unknown, one assignment touches and one overlaps another."""
    data = clean_batch()
    data["regions"][0]["region_name"] = ""
    data["job_sites"][0]["weather_location_code"] = "TX-UNKNOWN"
    jobs = data["equipment_assignments"]
    touching = datetime.fromisoformat(jobs[0]["assignment_end_timestamp"])
    meeting = datetime.fromisoformat(jobs[1]["assignment_start_timestamp"]) + timedelta(hours=5)
    for job, start in ((jobs[80], touching), (jobs[81], meeting)):
        job |= {
            "assignment_start_timestamp": _text(start),
            "assignment_end_timestamp": _text(start + timedelta(hours=10)),
        }
    return data
