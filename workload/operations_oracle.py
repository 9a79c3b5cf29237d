"""The 65 rules over the derived operations tables, written once more in SQL."""

from __future__ import annotations

from workload.views import operations_ctes


def _missing(column: str) -> str:
    return f"({column} IS NULL OR {column} = '')"


def _stamp(column: str) -> str:
    shape = r"^\d{4}-\d{2}-\d{2}T([01]\d|2[0-3]):[0-5]\d(:[0-5]\d)?(Z|\+00:00)?$"
    return (
        f"CASE WHEN regexp_matches({column}, '{shape}') "
        rf"THEN CAST(regexp_replace({column}, '(Z|\+00:00)$', '') AS TIMESTAMP) END"
    )


def _aware(column: str) -> str:
    return rf"regexp_matches({column}, '(Z|\+00:00)$')"


def _day(column: str) -> str:
    return rf"CASE WHEN regexp_matches({column}, '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN TRY_CAST({column} AS DATE) END"


_KEYS = {
    "regions": "region_id", "offices": "office_id", "employees": "employee_id", "projects": "project_id",
    "job_sites": "job_site_id", "crews": "crew_id", "activities": "activity_id",
    "equipment_types": "equipment_type_id", "equipment": "equipment_id",
    "field_schedules": "field_schedule_id", "equipment_assignments": "assignment_id",
    "safety_thresholds": "threshold_id",
}


class _Findings:
    def __init__(self, entity: str) -> None:
        self.entity = entity
        self.parts: list[str] = []

    def when(self, condition: str, rules: str, message: str, *, source: str | None = None, times: str = "1") -> None:
        key = _KEYS[self.entity]
        for rule in rules.split():
            self.parts.append(
                f"SELECT t._row_index AS row_index, CASE WHEN {_missing('t.' + key)} "
                f"THEN CONCAT('row:', t._row_index) ELSE t.{key} END AS record_id, '{rule}' AS rule_id, "
                f"{message} AS message, CAST({times} AS BIGINT) AS occurrences "
                f"FROM {source or self.entity + ' t'} WHERE {condition}"
            )

    def critical(self, fields: str) -> None:
        for field in fields.split():
            self.when(_missing(f"t.{field}"), "XEN-010", f"'Critical value {self.entity}.{field} is null or empty'")

    def required(self, field: str, rule: str) -> None:
        self.when(_missing(f"t.{field}"), rule, f"'{self.entity}.{field} is null or empty'")

    def unique(self, key: str, rule: str | None = None) -> None:
        repeated = (
            f"t.{key} IN (SELECT {key} FROM {self.entity} WHERE NOT {_missing(key)} GROUP BY {key} HAVING COUNT(*) > 1)"
        )
        shown = (
            f"CASE WHEN contains(t.{key}, chr(39)) THEN CONCAT('\"', t.{key}, '\"') "
            f"ELSE CONCAT(chr(39), t.{key}, chr(39)) END"
        )
        if rule:
            self.when(repeated, rule, f"CONCAT('duplicate {self.entity}.{key}: ', {shown})")
        self.when(repeated, "XEN-009", f"CONCAT('duplicate business key {self.entity}.{key}: ', {shown})")

    def link(self, field: str, target: str, key: str, rules: str = "XEN-001", nullable: bool = False) -> None:
        condition = f"NOT EXISTS (SELECT 1 FROM {target} p WHERE p.{key} IS NOT DISTINCT FROM t.{field})"
        if nullable:
            condition += f" AND NOT {_missing('t.' + field)}"
        self.when(condition, rules, f"'{self.entity}.{field} does not resolve to {target}.{key}'")

    def sql(self, extra: str = "", recursive: bool = False) -> str:
        ctes = operations_ctes() + (",\n" + extra if extra else "")
        start = "WITH RECURSIVE " if recursive else "WITH "
        return start + ctes + "\n" + "\nUNION ALL\n".join(self.parts)


def _master(entity: str, code: str, required: str, duplicate: str, critical: str, label: tuple[str, str] | None = None) -> _Findings:
    f = _Findings(entity)
    f.required(code, required)
    f.unique(code, duplicate)
    f.critical(critical)
    if label:
        f.required(*label)
    return f


def _last(table: str, key: str, columns: str) -> str:
    return f"(SELECT {key}, {columns} FROM {table} QUALIFY ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY _row_index DESC) = 1)"


def _parsed_schedules(name: str) -> str:
    start, end = "scheduled_start_timestamp", "scheduled_end_timestamp"
    return f"""{name} AS (SELECT *, {_stamp(start)} AS s, {_stamp(end)} AS e, {_aware(start)} AS sa, {_aware(end)} AS ea,
        TRY_CAST(planned_crew_hours AS DECIMAL(20,9)) AS h, TRY_CAST(planned_crew_size AS DECIMAL(10,0)) AS n,
        TRY_CAST(planned_labor_hours AS DECIMAL(20,9)) AS l FROM field_schedules)"""


def _cycles() -> str:
    return f"""step AS (SELECT field_schedule_id AS n, rescheduled_from_schedule_id AS p FROM
            {_last('field_schedules', 'field_schedule_id', 'rescheduled_from_schedule_id')} WHERE field_schedule_id <> ''),
        image AS (SELECT DISTINCT p AS n FROM step),
        walk(n, p) AS (SELECT step.n, step.p FROM step JOIN image USING (n)
            UNION SELECT walk.n, step.p FROM walk JOIN step ON step.n = walk.p),
        cycle AS (SELECT DISTINCT n FROM walk WHERE n = p)"""


def _valid_assignments() -> str:
    start, end = "assignment_start_timestamp", "assignment_end_timestamp"
    return f"""assignments AS (SELECT *, {_stamp(start)} AS s, {_stamp(end)} AS e0, {_aware(start)} AS sa, {_aware(end)} AS ea,
        {_missing(end)} AS open FROM equipment_assignments),
        valid AS (SELECT _row_index, equipment_id, sa, s, open, CASE WHEN open THEN TIMESTAMP '9999-12-31 23:59:59' ELSE e0 END AS e
        FROM assignments WHERE s IS NOT NULL AND (open OR COALESCE(e0 > s AND sa = ea, FALSE)))"""


def _schedules() -> str:
    f = _Findings("field_schedules")
    f.unique("field_schedule_id")
    f.critical(
        "field_schedule_id project_id job_site_id crew_id activity_id scheduled_start_timestamp scheduled_end_timestamp "
        "scheduled_date planned_crew_hours planned_crew_size planned_labor_hours status"
    )
    for field, target in (("project_id", "projects"), ("job_site_id", "job_sites"), ("crew_id", "crews"), ("activity_id", "activities")):
        f.link(field, target, _KEYS[target])
    f.link("rescheduled_from_schedule_id", "field_schedules", "field_schedule_id", nullable=True)
    parsed = _parsed_schedules("parsed")
    src = "parsed t"
    valid = "COALESCE(s < e AND sa = ea, FALSE)"
    f.when(f"NOT {valid}", "FSD-001", "'schedule timestamps are malformed or end is not greater than start'", source=src)
    f.when(
        f"NOT COALESCE(CAST(s AS DATE) = {_day('scheduled_date')}, FALSE)", "FSD-002",
        "'scheduled_date does not equal the start timestamp date'", source=src,
    )
    f.when(
        f"{valid} AND NOT COALESCE(ABS(h * 3600 - CAST(epoch(e) - epoch(s) AS DECIMAL(20,3))) <= 0.0036, FALSE)", "FSD-003",
        "'planned_crew_hours differs from schedule duration'", source=src,
    )
    f.when(
        "NOT COALESCE(ABS(l - h * n) <= 0.000001, FALSE)", "FSD-004",
        "'planned_labor_hours does not equal planned_crew_hours multiplied by planned_crew_size'", source=src,
    )
    f.when(
        "t.status IS NULL OR t.status NOT IN ('Scheduled', 'In Progress', 'Completed', 'Delayed', 'Cancelled', 'Rescheduled')",
        "FSD-010", "'status is outside the approved Field Schedule domain'",
    )
    f.when(
        "p.project_id IS DISTINCT FROM t.project_id", "FSD-005 XEN-002",
        "'Field Schedule project_id differs from the resolved Job Site project_id'",
        source=f"field_schedules t JOIN {_last('job_sites', 'job_site_id', 'project_id')} p ON p.job_site_id = t.job_site_id",
    )
    before, own = "t.rescheduled_from_schedule_id", "t.field_schedule_id"
    f.when(
        f"NOT {_missing(before)} AND {before} NOT IN (SELECT field_schedule_id FROM field_schedules)",
        "XEN-004", "'reschedule predecessor does not resolve'",
    )
    f.when(f"NOT {_missing(own)} AND {before} = {own}", "FSD-009 XEN-004", "'reschedule lineage self-references'")
    f.when(
        f"t.status = 'Rescheduled' AND NOT EXISTS (SELECT 1 FROM field_schedules n WHERE n.rescheduled_from_schedule_id = {own} AND {own} <> '')",
        "FSD-007", "'Rescheduled schedule has no resolving successor'",
    )
    # Every (closed predecessor row, affected row) once, then counted per affected row.
    touched = """closed AS (SELECT DISTINCT p._row_index AS p, p.field_schedule_id AS id FROM field_schedules p
            JOIN field_schedules n ON n.rescheduled_from_schedule_id = p.field_schedule_id
            WHERE p.status = 'Completed' AND p.field_schedule_id <> ''),
        touched AS (SELECT r, COUNT(*) AS c FROM (
            SELECT p, p AS r FROM closed UNION SELECT p, n._row_index FROM closed JOIN field_schedules n
            ON n.rescheduled_from_schedule_id = closed.id) GROUP BY r)"""
    f.when(
        "TRUE", "FSD-006", "'Completed schedule is referenced as a reschedule predecessor'",
        source="field_schedules t JOIN touched c ON c.r = t._row_index", times="c.c",
    )
    walk = _cycles()
    f.when(
        f"{own} IN (SELECT n FROM cycle) AND {before} IS DISTINCT FROM {own}", "FSD-009 XEN-004",
        "'reschedule predecessor traversal contains a cycle'",
    )
    return f.sql(f"{parsed},\n{touched},\n{walk}", recursive=True)


def _assignments() -> str:
    f = _Findings("equipment_assignments")
    f.unique("assignment_id")
    f.critical("assignment_id equipment_id job_site_id project_id assignment_start_timestamp")
    for field, target in (("equipment_id", "equipment"), ("job_site_id", "job_sites"), ("project_id", "projects")):
        f.link(field, target, _KEYS[target])
    parsed = _valid_assignments()
    f.when(
        "t._row_index NOT IN (SELECT _row_index FROM valid)", "EQA-001",
        "'assignment timestamps are malformed or end is not greater than start'",
    )
    f.when(
        "p.project_id IS DISTINCT FROM t.project_id", "EQA-002 XEN-003",
        "'Equipment Assignment project_id differs from the resolved Job Site project_id'",
        source=f"equipment_assignments t JOIN {_last('job_sites', 'job_site_id', 'project_id')} p ON p.job_site_id = t.job_site_id",
    )
    other = "b.equipment_id IS NOT DISTINCT FROM a.equipment_id AND b.sa = a.sa AND b._row_index <> a._row_index"
    f.when(
        f"t._row_index IN (SELECT a._row_index FROM valid a JOIN valid b ON {other} AND a.s < b.e AND b.s < a.e)",
        "EQA-003 XEN-005", "'equipment assignment overlaps another period for the same equipment'",
    )
    f.when(
        f"t._row_index IN (SELECT a._row_index FROM valid a JOIN valid b ON {other} AND (a.e = b.s OR b.e = a.s))",
        "EQA-004", "'equipment assignment has an accepted adjacent boundary'",
    )
    return f.sql(parsed)


def _thresholds() -> str:
    f = _Findings("safety_thresholds")
    f.unique("threshold_id")
    f.critical(
        "threshold_id activity_id metric_code comparison_operator unit threshold_value_or_code_set severity "
        "recommended_action_code effective_start_date is_active override_flag"
    )
    f.link("activity_id", "activities", "activity_id")
    f.link("equipment_type_id", "equipment_types", "equipment_type_id", nullable=True)
    payload = (
        "comparison_operator", "unit", "threshold_value_or_code_set", "threshold_value",
        "weather_code_set", "recommended_action_code", "override_flag",
    )
    parsed = f"""parsed AS (SELECT *, {_day('effective_start_date')} AS s, {_day('effective_end_date')} AS e0,
            {_missing('effective_end_date')} AS open FROM safety_thresholds),
        active AS (SELECT *, CASE WHEN open THEN DATE '9999-12-31' ELSE e0 END AS e, NULLIF(equipment_type_id, '') AS et FROM parsed
            WHERE is_active = 'True' AND s IS NOT NULL AND (open OR e0 IS NOT NULL)),
        met AS (SELECT a._row_index, BOOL_OR({' OR '.join(f'a.{c} IS DISTINCT FROM b.{c}' for c in payload)}) AS differs
            FROM active a JOIN active b ON a._row_index <> b._row_index AND a.activity_id IS NOT DISTINCT FROM b.activity_id
            AND a.metric_code IS NOT DISTINCT FROM b.metric_code AND a.severity IS NOT DISTINCT FROM b.severity
            AND a.et IS NOT DISTINCT FROM b.et AND a.s <= b.e AND b.s <= a.e GROUP BY a._row_index)"""
    f.when(
        "t.s IS NULL OR (NOT t.open AND (t.e0 IS NULL OR t.e0 < t.s))", "SFT-001",
        "'effective dates are malformed or end precedes start'", source="parsed t",
    )
    f.when(
        "t._row_index IN (SELECT _row_index FROM met)", "SFT-002 XEN-006",
        "'active safety threshold period overlaps another rule in the same scope'",
    )
    f.when(
        "t._row_index IN (SELECT _row_index FROM met WHERE differs)", "SFT-008",
        "'simultaneously active same-scope safety rules have conflicting payloads'",
    )
    code = "COALESCE(t.metric_code = 'WEATHER_CODE', FALSE)"
    f.when(
        f"({code} AND t.comparison_operator IS DISTINCT FROM 'IN') OR (t.metric_code IN ('WIND_GUST_MPH', 'HEAT_INDEX_F', "
        "'PRECIPITATION_IN') AND t.comparison_operator IS DISTINCT FROM '>=')", "SFT-003",
        "'comparison_operator is incompatible with the verified metric structure'",
    )
    value, codes = _missing("t.threshold_value"), _missing("t.weather_code_set")
    f.when(f"{code} AND ({codes} OR NOT {value})", "SFT-004", "'WEATHER_CODE threshold payload is invalid'")
    f.when(
        f"NOT {code} AND (TRY_CAST(t.threshold_value AS DECIMAL(20,9)) IS NULL OR NOT {codes})", "SFT-005",
        "'numeric threshold payload is invalid'",
    )
    f.when(_missing("t.recommended_action_code"), "SFT-006", "'recommended_action_code is null or empty'")
    f.when(
        "t.severity = 'CRITICAL' AND t.override_flag IS DISTINCT FROM 'True'", "SFT-007",
        "'CRITICAL threshold does not set override_flag to true'",
    )
    return f.sql(parsed)


def operations_oracles() -> dict[str, str]:
    regions = _master("regions", "region_code", "REG-001", "REG-002", "region_id region_code", ("region_name", "REG-003"))
    offices = _master("offices", "office_code", "OFF-001", "OFF-003", "office_id office_code region_id", ("office_name", "OFF-004"))
    offices.link("region_id", "regions", "region_id", "XEN-001 OFF-002")
    employees = _master("employees", "employee_number", "EMP-001", "EMP-003", "employee_id employee_number employee_name home_office_id employment_status")
    employees.link("home_office_id", "offices", "office_id", "XEN-001 EMP-002")
    employees.when(
        "t.employment_status = 'Terminated' AND EXISTS (SELECT 1 FROM crews c WHERE c.crew_lead_employee_id IS NOT DISTINCT FROM t.employee_id)",
        "EMP-004", "'Terminated employee is referenced as a crew lead'",
        source=f"{_last('employees', 'employee_id', '_row_index, employment_status')} t",
    )
    projects = _master("projects", "project_code", "PRJ-001", "PRJ-002", "project_id project_code office_id project_manager_employee_id field_manager_employee_id status", ("project_name", "PRJ-003"))
    projects.link("office_id", "offices", "office_id")
    projects.link("project_manager_employee_id", "employees", "employee_id")
    projects.link("field_manager_employee_id", "employees", "employee_id")
    sites = _master("job_sites", "job_site_code", "JBS-001", "JBS-003", "job_site_id job_site_code job_site_name project_id weather_location_code")
    sites.link("project_id", "projects", "project_id", "XEN-001 JBS-002")
    sites.when(
        "t.weather_location_code IS NULL OR t.weather_location_code NOT IN ('TX-DAL', 'TX-HOU', 'TX-AUS')",
        "JBS-004 XEN-007", "'weather_location_code is outside the approved domain'",
    )
    crews = _master("crews", "crew_code", "CRW-001", "CRW-003", "crew_id crew_code home_office_id crew_status")
    crews.link("home_office_id", "offices", "office_id", "XEN-001 CRW-002")
    crews.link("crew_lead_employee_id", "employees", "employee_id", nullable=True)
    crews.when(_missing("t.crew_lead_employee_id"), "CRW-006", "'crew_lead_employee_id is null or empty'")
    lead = f"crews t LEFT JOIN {_last('employees', 'employee_id', 'employment_status, home_office_id')} e ON e.employee_id = t.crew_lead_employee_id"
    named = f"NOT {_missing('t.crew_lead_employee_id')}"
    crews.when(f"{named} AND e.employment_status IS DISTINCT FROM 'Active'", "CRW-004", "'crew lead does not resolve to an Active employee'", source=lead)
    crews.when(
        f"{named} AND e.employee_id IS NOT NULL AND e.home_office_id IS DISTINCT FROM t.home_office_id",
        "CRW-005 XEN-008", "'crew lead home office differs from crew home office'", source=lead,
    )
    activities = _master("activities", "activity_code", "ACT-001", "ACT-002", "activity_id activity_code", ("activity_name", "ACT-003"))
    types = _master("equipment_types", "equipment_type_code", "EQT-001", "EQT-002", "equipment_type_id equipment_type_code", ("equipment_type_name", "EQT-003"))
    equipment = _master("equipment", "equipment_code", "EQP-001", "EQP-003", "equipment_id equipment_code equipment_type_id", ("equipment_status", "EQP-004"))
    equipment.link("equipment_type_id", "equipment_types", "equipment_type_id", "XEN-001 EQP-002")
    simple = (regions, offices, employees, projects, sites, crews, activities, types, equipment)
    return {f.entity: f.sql() for f in simple} | {
        "field_schedules": _schedules(),
        "equipment_assignments": _assignments(),
        "safety_thresholds": _thresholds(),
    }


_CODES = {
    "regions": "region_code", "offices": "office_code", "employees": "employee_number",
    "projects": "project_code", "job_sites": "job_site_code", "crews": "crew_code",
    "activities": "activity_code", "equipment_types": "equipment_type_code", "equipment": "equipment_code",
}
_LINKS = """offices region_id regions region_id
employees home_office_id offices office_id
projects office_id offices office_id
projects project_manager_employee_id employees employee_id
projects field_manager_employee_id employees employee_id
job_sites project_id projects project_id
crews home_office_id offices office_id
crews crew_lead_employee_id employees employee_id nullable
field_schedules project_id projects project_id
field_schedules job_site_id job_sites job_site_id
field_schedules crew_id crews crew_id
field_schedules activity_id activities activity_id
field_schedules rescheduled_from_schedule_id field_schedules field_schedule_id nullable
equipment equipment_type_id equipment_types equipment_type_id
equipment_assignments equipment_id equipment equipment_id
equipment_assignments job_site_id job_sites job_site_id
equipment_assignments project_id projects project_id
safety_thresholds activity_id activities activity_id
safety_thresholds equipment_type_id equipment_types equipment_type_id nullable"""
_SCENARIOS = (
    "normal_operations", "moderate_weather", "high_wind_equipment", "extreme_heat", "heavy_precipitation",
    "lightning_override", "crew_reschedule", "equipment_relocation", "multiple_project_conflict",
)


def gate_oracle() -> str:
    """Every gate reason with the number of rows behind it."""
    parts: list[str] = []

    def reject(entity: str, reason: str, condition: str, source: str | None = None) -> None:
        parts.append(
            f"SELECT '{entity}' AS entity, '{reason}' AS reason, COUNT(*) AS failures "
            f"FROM {source or entity + ' t'} WHERE {condition} HAVING COUNT(*) > 0"
        )

    for entity, key in _KEYS.items():
        for column in [key, *([_CODES[entity]] if entity in _CODES else [])]:
            reject(entity, f"{entity}.{column} is required", _missing(f"t.{column}"))
            repeated = f"SELECT {column} FROM {entity} WHERE {column} <> '' GROUP BY {column} HAVING COUNT(*) > 1"
            reject(entity, f"duplicate {entity}.{column}", f"t.{column} IN ({repeated})")
    for line in _LINKS.splitlines():
        entity, field, target, key, *nullable = line.split()
        condition = f"NOT EXISTS (SELECT 1 FROM {target} p WHERE p.{key} IS NOT DISTINCT FROM t.{field})"
        if nullable:
            condition += f" AND NOT {_missing('t.' + field)}"
        reject(entity, f"{entity}.{field} does not resolve to {target}.{key}", condition)
    reject("projects", "invalid project status", "COALESCE(t.status NOT IN ('Planned', 'Active', 'Closed', 'Cancelled'), TRUE)")
    reject("projects", "invalid project dates", "NOT COALESCE(CAST(t.project_end_date AS DATE) >= CAST(t.project_start_date AS DATE), FALSE)")
    reject("job_sites", "invalid weather location", "COALESCE(t.weather_location_code NOT IN ('TX-DAL', 'TX-HOU', 'TX-AUS'), TRUE)")
    reject(
        "crews", "crew lead must be active", f"{_missing('t.crew_lead_employee_id')} OR e.employment_status IS DISTINCT FROM 'Active'",
        f"crews t LEFT JOIN {_last('employees', 'employee_id', 'employment_status')} e ON e.employee_id = t.crew_lead_employee_id",
    )
    s, before, own = "field_schedules", "t.rescheduled_from_schedule_id", "t.field_schedule_id"
    site = f"JOIN {_last('job_sites', 'job_site_id', 'project_id')} p ON p.job_site_id = t.job_site_id"
    window = f"s < e AND sa = ea AND CAST(s AS DATE) = {_day('scheduled_date')}"
    reject(s, "invalid schedule timestamps/date", f"NOT COALESCE({window}, FALSE)", "schedules t")
    reject(s, "crew hours differ from duration", "NOT COALESCE(h * 3600 = CAST(epoch(e) - epoch(s) AS DECIMAL(20,3)), FALSE)", "schedules t")
    reject(s, "invalid planned labor hours", "NOT COALESCE(ABS(l - h * n) <= 0.000001, FALSE)", "schedules t")
    reject(s, "schedule project/site mismatch", "p.project_id IS DISTINCT FROM t.project_id", f"field_schedules t {site}")
    reject(
        s, "invalid schedule status",
        "t.status NOT IN ('Scheduled', 'In Progress', 'Completed', 'Delayed', 'Cancelled', 'Rescheduled')",
    )
    reject(s, "invalid reschedule predecessor", f"NOT {_missing(before)} AND {before} = {own}")
    reject(
        s, "predecessor must be Rescheduled", f"NOT {_missing(before)} AND p.status IS DISTINCT FROM 'Rescheduled'",
        f"field_schedules t JOIN {_last(s, 'field_schedule_id', 'status')} p ON p.field_schedule_id = {before}",
    )
    reject(s, "cyclic reschedule lineage", f"{own} IN (SELECT n FROM cycle)")
    reject(
        s, "rescheduled row lacks successor",
        f"t.status = 'Rescheduled' AND NOT EXISTS (SELECT 1 FROM {s} n WHERE n.rescheduled_from_schedule_id = {own} AND {own} <> '')",
    )
    a = "equipment_assignments"
    reject(a, "invalid assignment window", "t._row_index NOT IN (SELECT _row_index FROM valid WHERE NOT open)")
    reject(a, "assignment project/site mismatch", "p.project_id IS DISTINCT FROM t.project_id", f"{a} t {site}")
    other = "y.equipment_id IS NOT DISTINCT FROM x.equipment_id AND y.sa = x.sa AND y._row_index <> x._row_index"
    reject(
        a, "overlapping equipment assignment",
        f"t._row_index IN (SELECT x._row_index FROM valid x JOIN valid y ON {other} AND x.s < y.e AND y.s < x.e)",
    )
    t = "safety_thresholds"
    code, value, codes = "COALESCE(t.metric_code = 'WEATHER_CODE', FALSE)", _missing("t.threshold_value"), _missing("t.weather_code_set")
    reject(t, "threshold action required", _missing("t.recommended_action_code"))
    reject(t, "critical threshold must override", "t.severity = 'CRITICAL' AND t.override_flag IS DISTINCT FROM 'True'")
    reject(t, "incompatible threshold structure", f"NOT (({code} AND NOT {codes} AND {value}) OR (NOT {code} AND NOT {value} AND {codes}))")
    reject(
        t, "overlapping/ambiguous active threshold", "c > 1",
        f"(SELECT COUNT(*) OVER (PARTITION BY activity_id, metric_code, severity, equipment_type_id) AS c FROM {t}) t",
    )
    for entity, reason, wanted in (
        (s, "missing scenario coverage", _SCENARIOS),
        (a, "missing relocation scenario", ("equipment_relocation",)),
    ):
        for name in wanted:
            parts.append(
                f"SELECT '{entity}', '{reason}: {name}', 1 WHERE NOT EXISTS (SELECT 1 FROM {entity} WHERE scenario_id = '{name}')"
            )
    ctes = ",\n".join((operations_ctes(), _parsed_schedules("schedules"), _cycles(), _valid_assignments()))
    return f"WITH RECURSIVE {ctes}\n" + "\nUNION ALL\n".join(parts)
