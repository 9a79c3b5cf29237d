"""The operations pack: 12 entities, 19 foreign keys, 65 rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchstone.functions import (
    finite_decimal,
    interval_end_us,
    iso_date,
    iso_timestamp,
    missing,
    one_of,
    present,
    within_tolerance,
)
from touchstone.functions.values import DAY_US, HOUR_US, TOLERANCE
from touchstone.operators.intervals import adjacent, overlapping, period_conflicts
from touchstone.operators.keys import lookup
from touchstone.operators.lineage import closed_predecessors, cycle_members, without_successor
from touchstone.plans.rules import ROW, Check, Entity, Link, Pack, Rule, Unique, flagged

# The approved domains.
WEATHER_LOCATIONS = ("TX-DAL", "TX-HOU", "TX-AUS")
SCHEDULE_STATUSES = ("Scheduled", "In Progress", "Completed", "Delayed", "Cancelled", "Rescheduled")
NUMERIC_METRICS = ("WIND_GUST_MPH", "HEAT_INDEX_F", "PRECIPITATION_IN")

# The action texts that several rules share.
QUARANTINE = "Quarantine and log."
DUPLICATE = "Quarantine duplicate-key records and log."
LINEAGE = "Quarantine affected lineage record(s) and log."
RETAIN = "Retain, attach warning, log; no source change."

# Rule id, entity, severity, action, code.
RULES = tuple(
    Rule(*values)
    for values in (
        ("REG-001", "regions", "Critical", QUARANTINE, "ERR_REGION_CODE_REQUIRED"),
        ("REG-002", "regions", "Critical", DUPLICATE, "ERR_REGION_CODE_DUPLICATE"),
        ("REG-003", "regions", "Warning", RETAIN, "WARN_REGION_NAME_MISSING"),
        ("OFF-001", "offices", "Critical", QUARANTINE, "ERR_OFFICE_CODE_REQUIRED"),
        ("OFF-002", "offices", "Critical", QUARANTINE, "ERR_OFFICE_REGION_FK_INVALID"),
        ("OFF-003", "offices", "Critical", DUPLICATE, "ERR_OFFICE_CODE_DUPLICATE"),
        ("OFF-004", "offices", "Warning", RETAIN, "WARN_OFFICE_NAME_MISSING"),
        ("EMP-001", "employees", "Critical", QUARANTINE, "ERR_EMPLOYEE_NUMBER_REQUIRED"),
        ("EMP-002", "employees", "Critical", QUARANTINE, "ERR_EMPLOYEE_HOME_OFFICE_FK_INVALID"),
        ("EMP-003", "employees", "Critical", DUPLICATE, "ERR_EMPLOYEE_NUMBER_DUPLICATE"),
        ("EMP-004", "employees", "Warning", "Retain affected source record(s), attach warning, and log.", "WARN_TERMINATED_EMPLOYEE_CREW_LEAD"),
        ("PRJ-001", "projects", "Critical", QUARANTINE, "ERR_PROJECT_CODE_REQUIRED"),
        ("PRJ-002", "projects", "Critical", DUPLICATE, "ERR_PROJECT_CODE_DUPLICATE"),
        ("PRJ-003", "projects", "Warning", RETAIN, "WARN_PROJECT_NAME_MISSING"),
        ("JBS-001", "job_sites", "Critical", QUARANTINE, "ERR_JOB_SITE_CODE_REQUIRED"),
        ("JBS-002", "job_sites", "Critical", QUARANTINE, "ERR_JOB_SITE_PROJECT_FK_INVALID"),
        ("JBS-003", "job_sites", "Critical", DUPLICATE, "ERR_JOB_SITE_CODE_DUPLICATE"),
        ("JBS-004", "job_sites", "Critical", QUARANTINE, "ERR_JOB_SITE_WEATHER_LOCATION_INVALID"),
        ("CRW-001", "crews", "Critical", QUARANTINE, "ERR_CREW_CODE_REQUIRED"),
        ("CRW-002", "crews", "Critical", QUARANTINE, "ERR_CREW_HOME_OFFICE_FK_INVALID"),
        ("CRW-003", "crews", "Critical", DUPLICATE, "ERR_CREW_CODE_DUPLICATE"),
        ("CRW-004", "crews", "Critical", QUARANTINE, "ERR_CREW_LEAD_NOT_ACTIVE"),
        ("CRW-005", "crews", "Warning", RETAIN, "WARN_CREW_LEAD_OFFICE_MISMATCH"),
        ("CRW-006", "crews", "Warning", "Retain, attach warning, and log.", "WARN_CREW_LEAD_MISSING"),
        ("ACT-001", "activities", "Critical", QUARANTINE, "ERR_ACTIVITY_CODE_REQUIRED"),
        ("ACT-002", "activities", "Critical", DUPLICATE, "ERR_ACTIVITY_CODE_DUPLICATE"),
        ("ACT-003", "activities", "Warning", RETAIN, "WARN_ACTIVITY_NAME_MISSING"),
        ("EQT-001", "equipment_types", "Critical", QUARANTINE, "ERR_EQUIPMENT_TYPE_CODE_REQUIRED"),
        ("EQT-002", "equipment_types", "Critical", DUPLICATE, "ERR_EQUIPMENT_TYPE_CODE_DUPLICATE"),
        ("EQT-003", "equipment_types", "Warning", RETAIN, "WARN_EQUIPMENT_TYPE_NAME_MISSING"),
        ("EQP-001", "equipment", "Critical", QUARANTINE, "ERR_EQUIPMENT_CODE_REQUIRED"),
        ("EQP-002", "equipment", "Critical", QUARANTINE, "ERR_EQUIPMENT_TYPE_FK_INVALID"),
        ("EQP-003", "equipment", "Critical", DUPLICATE, "ERR_EQUIPMENT_CODE_DUPLICATE"),
        ("EQP-004", "equipment", "Warning", RETAIN, "WARN_EQUIPMENT_STATUS_MISSING_OR_DOMAIN_UNRESOLVED"),
        ("FSD-001", "field_schedules", "Critical", "Design unresolved for parsing policy; once approved, quarantine failures and log.", "ERR_FIELD_SCHEDULE_WINDOW_INVALID"),
        ("FSD-002", "field_schedules", "Critical", QUARANTINE, "ERR_FIELD_SCHEDULE_DATE_MISMATCH"),
        ("FSD-003", "field_schedules", "Warning", "Retain, attach warning, log; design decision required for exceptions.", "WARN_FIELD_SCHEDULE_CREW_HOURS_MISMATCH"),
        ("FSD-004", "field_schedules", "Critical", QUARANTINE, "ERR_FIELD_SCHEDULE_LABOR_HOURS_INVALID"),
        ("FSD-005", "field_schedules", "Critical", QUARANTINE, "ERR_FIELD_SCHEDULE_PROJECT_SITE_MISMATCH"),
        ("FSD-006", "field_schedules", "Critical", LINEAGE, "ERR_COMPLETED_SCHEDULE_RESCHEDULED"),
        ("FSD-007", "field_schedules", "Critical", LINEAGE, "ERR_RESCHEDULE_SUCCESSOR_MISSING"),
        ("FSD-009", "field_schedules", "Critical", LINEAGE, "ERR_RESCHEDULE_LINEAGE_CYCLE"),
        ("FSD-010", "field_schedules", "Critical", QUARANTINE, "ERR_FIELD_SCHEDULE_STATUS_INVALID"),
        ("EQA-001", "equipment_assignments", "Critical", "Design unresolved for parsing policy; quarantine deterministic failures and log.", "ERR_EQUIPMENT_ASSIGNMENT_WINDOW_INVALID"),
        ("EQA-002", "equipment_assignments", "Critical", QUARANTINE, "ERR_EQUIPMENT_ASSIGNMENT_PROJECT_SITE_MISMATCH"),
        ("EQA-003", "equipment_assignments", "Critical", "Quarantine affected assignments and log.", "ERR_EQUIPMENT_ASSIGNMENT_OVERLAP"),
        ("EQA-004", "equipment_assignments", "Info", "Retain unchanged and log accepted adjacency.", "INFO_EQUIPMENT_ASSIGNMENT_ADJACENT_BOUNDARY"),
        ("SFT-001", "safety_thresholds", "Critical", "Design unresolved for parsing policy; quarantine deterministic failures and log.", "ERR_SAFETY_THRESHOLD_EFFECTIVE_DATES_INVALID"),
        ("SFT-002", "safety_thresholds", "Critical", "Quarantine conflicting rules and log.", "ERR_SAFETY_THRESHOLD_ACTIVE_PERIOD_OVERLAP"),
        ("SFT-003", "safety_thresholds", "Critical", "Design unresolved beyond verified metrics; quarantine known incompatibilities and log.", "ERR_SAFETY_THRESHOLD_OPERATOR_INCOMPATIBLE"),
        ("SFT-004", "safety_thresholds", "Critical", QUARANTINE, "ERR_SAFETY_THRESHOLD_WEATHER_STRUCTURE_INVALID"),
        ("SFT-005", "safety_thresholds", "Critical", "Design unresolved for unit/bounds; quarantine structural failures and log.", "ERR_SAFETY_THRESHOLD_NUMERIC_STRUCTURE_INVALID"),
        ("SFT-006", "safety_thresholds", "Critical", QUARANTINE, "ERR_SAFETY_THRESHOLD_ACTION_REQUIRED"),
        ("SFT-007", "safety_thresholds", "Critical", QUARANTINE, "ERR_SAFETY_THRESHOLD_CRITICAL_OVERRIDE_REQUIRED"),
        ("SFT-008", "safety_thresholds", "Critical", "Quarantine conflicting rules and log.", "ERR_SAFETY_THRESHOLD_ACTIVE_RULE_CONFLICT"),
        ("XEN-001", "cross_entity", "Critical", "Quarantine record with invalid FK and log relationship detail.", "ERR_CROSS_ENTITY_FK_INVALID"),
        ("XEN-002", "cross_entity", "Critical", QUARANTINE, "ERR_CROSS_FIELD_SCHEDULE_PROJECT_SITE_MISMATCH"),
        ("XEN-003", "cross_entity", "Critical", QUARANTINE, "ERR_CROSS_EQUIPMENT_ASSIGNMENT_PROJECT_SITE_MISMATCH"),
        ("XEN-004", "cross_entity", "Critical", LINEAGE, "ERR_CROSS_RESCHEDULE_LINEAGE_INVALID"),
        ("XEN-005", "cross_entity", "Critical", "Quarantine affected assignments and log.", "ERR_CROSS_EQUIPMENT_ASSIGNMENT_OVERLAP"),
        ("XEN-006", "cross_entity", "Critical", "Quarantine conflicting thresholds and log.", "ERR_CROSS_SAFETY_THRESHOLD_PERIOD_OVERLAP"),
        ("XEN-007", "cross_entity", "Critical", QUARANTINE, "ERR_CROSS_WEATHER_LOCATION_INVALID"),
        ("XEN-008", "cross_entity", "Warning", RETAIN, "WARN_CROSS_CREW_LEAD_OFFICE_MISMATCH"),
        ("XEN-009", "cross_entity", "Critical", "Quarantine duplicate records and log entity/key.", "ERR_CROSS_ENTITY_BUSINESS_KEY_DUPLICATE"),
        ("XEN-010", "cross_entity", "Critical", "Quarantine and log; do not impute.", "ERR_CROSS_ENTITY_REQUIRED_VALUE_MISSING"),
    )
)


def _required(entity: str, field: str, rule_id: str) -> Check:
    return Check((rule_id,), f"{entity}.{field} is null or empty", missing(F.col(field)))


def _critical(entity: str, fields: str) -> list[Check]:
    return [
        Check(("XEN-010",), f"Critical value {entity}.{field} is null or empty", missing(F.col(field)))
        for field in fields.split()
    ]


def _unique(entity: str, key: str, rule_id: str | None = None) -> Unique:
    """Duplicate keys: the entity's own rule where it has one, and the cross-entity one."""
    cross = ("XEN-009", f"duplicate business key {entity}.{key}: ")
    own = ((rule_id, f"duplicate {entity}.{key}: "),) if rule_id else ()
    return Unique((key,), (cross, *own), shown=True)


def _master(
    name: str,
    columns: str,
    required: str,
    key: str,
    code: tuple[str, str, str],
    critical: str,
    label: tuple[str, str] | None = None,
    checks=tuple,
    set_rules=(),
    set_columns=(),
) -> Entity:
    field, required_rule, duplicate_rule = code

    def all_checks() -> list[Check]:
        base = [_required(name, field, required_rule)]
        if label:
            base.append(_required(name, *label))
        return [*base, *_critical(name, critical), *checks()]

    return Entity(
        name,
        tuple(columns.split()),
        tuple(required.split()),
        key,
        all_checks,
        None,
        set_rules,
        (_unique(name, field, duplicate_rule),),
        set_columns,
    )


def _site_checks() -> list[Check]:
    return [
        Check(
            ("JBS-004", "XEN-007"),
            "weather_location_code is outside the approved domain",
            ~one_of(F.col("weather_location_code"), WEATHER_LOCATIONS),
        )
    ]


def _crew_checks() -> list[Check]:
    lead, found = F.col("crew_lead_employee_id"), F.col("_found_crew_lead_employee_id")
    return [
        Check(("CRW-006",), "crew_lead_employee_id is null or empty", missing(lead)),
        Check(
            ("CRW-004",),
            "crew lead does not resolve to an Active employee",
            present(lead) & (~found | ~F.col("_lead_status").eqNullSafe("Active")),
        ),
        Check(
            ("CRW-005", "XEN-008"),
            "crew lead home office differs from crew home office",
            present(lead) & found & ~F.col("_lead_office").eqNullSafe(F.col("home_office_id")),
        ),
    ]


def _terminated_leads(rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    last = rows.groupBy("employee_id").agg(
        F.max_by(F.struct(ROW, "_record_id", "employment_status"), ROW).alias("_last")
    )
    last = last.select("employee_id", "_last.*").where("employment_status = 'Terminated'")
    leads = tables["crews"].select("crew_lead_employee_id")
    hit = lookup(last, "employee_id", leads, "crew_lead_employee_id", {}, found="_leads").where("_leads")
    return flagged(hit, ["EMP-004"], "Terminated employee is referenced as a crew lead")


def _schedule_prepare(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "_start": iso_timestamp(F.col("scheduled_start_timestamp")),
            "_end": iso_timestamp(F.col("scheduled_end_timestamp")),
            "_day": F.unix_date(iso_date(F.col("scheduled_date"))),
            "_hours": finite_decimal(F.col("planned_crew_hours")),
            "_size": finite_decimal(F.col("planned_crew_size")),
            "_labor": finite_decimal(F.col("planned_labor_hours")),
        }
    )


def _product_matches(left, a, b):
    """left = a * b within the tolerance, exactly, for factors below 10^27.

    The factors are split at 10^9 into a whole high part and a low part below
    10^9, and the four partial products are compared with ``left`` piece by
    piece, highest first: each piece carries what is left over to the next.
    """
    unit = F.lit(10**9).cast("decimal(10,0)")

    def parts(x):
        low = (F.abs(x) % unit).cast("decimal(19,10)")
        high = ((F.abs(x) - low) / unit).try_cast("decimal(18,0)")
        return high, low

    (ah, al), (bh, bl) = parts(a), parts(b)
    negative = (a < 0) != (b < 0)
    signed = F.when(negative, -left).otherwise(left)
    # |a * b| = ah*bh * 10^18 + (ah*bl + al*bh) * 10^9 + al*bl; ``left`` has at
    # most 28 whole digits, so a high product above 10^10 can't be met.
    top = F.try_multiply(ah, bh)
    reach = top <= F.lit(10**11).cast("decimal(12,0)")
    middle = F.try_add(F.try_multiply(ah, bl), F.try_multiply(al, bh)).try_cast("decimal(38,10)")
    low = F.try_multiply(al, bl).try_cast("decimal(38,18)")
    step = unit.cast("decimal(10,0)")
    rest = F.try_subtract(signed.try_cast("decimal(38,10)"), F.try_multiply(top.try_cast("decimal(12,0)"), F.lit(10**18).cast("decimal(19,0)")).try_cast("decimal(38,10)"))
    rest = F.try_subtract(rest, F.try_multiply(middle.try_cast("decimal(27,10)"), step).try_cast("decimal(38,10)"))
    near = F.abs(F.try_subtract(rest.try_cast("decimal(38,18)"), low)) <= F.lit(TOLERANCE).cast("decimal(7,6)")
    known = left.isNotNull() & a.isNotNull() & b.isNotNull()
    return F.when(known, reach & F.coalesce(near, F.lit(False)))


def _schedule_checks() -> list[Check]:
    entity = "field_schedules"
    start, end = F.col("_start"), F.col("_end")
    valid = F.coalesce(
        (start["aware"] == end["aware"]) & (end["at_us"] > start["at_us"]), F.lit(False)
    )
    span = (end["at_us"] - start["at_us"]).cast("decimal(20,0)")
    hours = F.col("_hours").try_cast("decimal(20,9)")
    on_time = F.abs(hours * F.lit(HOUR_US).cast("decimal(10,0)") - span) <= F.lit(HOUR_US // 1_000_000)
    status, predecessor = F.col("status"), F.col("rescheduled_from_schedule_id")
    site_found = F.col("_found_job_site_id")
    return [
        *_critical(
            entity,
            "field_schedule_id project_id job_site_id crew_id activity_id scheduled_start_timestamp "
            "scheduled_end_timestamp scheduled_date planned_crew_hours planned_crew_size "
            "planned_labor_hours status",
        ),
        Check(("FSD-001",), "schedule timestamps are malformed or end is not greater than start", ~valid),
        Check(
            ("FSD-002",),
            "scheduled_date does not equal the start timestamp date",
            ~F.coalesce(F.floor(start["wall_us"] / F.lit(DAY_US)) == F.col("_day"), F.lit(False)),
        ),
        Check(
            ("FSD-003",),
            "planned_crew_hours differs from schedule duration",
            valid & ~F.coalesce(on_time, F.lit(False)),
        ),
        Check(
            ("FSD-004",),
            "planned_labor_hours does not equal planned_crew_hours multiplied by planned_crew_size",
            ~F.coalesce(
                _product_matches(F.col("_labor"), F.col("_hours"), F.col("_size")), F.lit(False)
            ),
        ),
        Check(
            ("FSD-010",),
            "status is outside the approved Field Schedule domain",
            ~one_of(status, SCHEDULE_STATUSES),
        ),
        Check(
            ("FSD-005", "XEN-002"),
            "Field Schedule project_id differs from the resolved Job Site project_id",
            site_found & ~F.col("_site_project").eqNullSafe(F.col("project_id")),
        ),
        Check(
            ("XEN-004",),
            "reschedule predecessor does not resolve",
            present(predecessor) & ~F.col("_found_rescheduled_from_schedule_id"),
        ),
        Check(
            ("FSD-009", "XEN-004"),
            "reschedule lineage self-references",
            present(F.col("field_schedule_id")) & (predecessor == F.col("field_schedule_id")),
        ),
    ]


_ID, _FROM = "field_schedule_id", "rescheduled_from_schedule_id"


def _schedule_closed(rows: DataFrame, _tables: dict[str, DataFrame]) -> DataFrame:
    hit = closed_predecessors(rows.select(ROW, "_record_id", _ID, _FROM, "status"), _ID, _FROM, "status", "Completed")
    return flagged(
        hit, ["FSD-006"], "Completed schedule is referenced as a reschedule predecessor", F.col("occurrences")
    )


def _schedule_open(rows: DataFrame, _tables: dict[str, DataFrame]) -> DataFrame:
    hit = without_successor(
        rows.select(ROW, "_record_id", _ID, _FROM, "status"), _ID, _FROM, "status", "Rescheduled"
    )
    return flagged(hit, ["FSD-007"], "Rescheduled schedule has no resolving successor")


def _schedule_cycles(rows: DataFrame, _tables: dict[str, DataFrame]) -> DataFrame:
    members = cycle_members(rows.select(ROW, _ID, _FROM), _ID, _FROM, ROW)
    own = F.coalesce(F.col(_FROM) == F.col(_ID), F.lit(False))
    hit = rows.join(members, rows[_ID] == members["node"], "left_semi").where(~own)
    return flagged(hit, ["FSD-009", "XEN-004"], "reschedule predecessor traversal contains a cycle")


def _assignment_prepare(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "_start": iso_timestamp(F.col("assignment_start_timestamp")),
            "_end": iso_timestamp(F.col("assignment_end_timestamp")),
        }
    )


def _assignment_valid():
    start, end, text = F.col("_start"), F.col("_end"), F.col("assignment_end_timestamp")
    bounded = (start["aware"] == end["aware"]) & (end["at_us"] > start["at_us"])
    return F.coalesce(start.isNotNull() & (missing(text) | bounded), F.lit(False))


def _assignment_checks() -> list[Check]:
    entity = "equipment_assignments"
    return [
        *_critical(entity, "assignment_id equipment_id job_site_id project_id assignment_start_timestamp"),
        Check(
            ("EQA-001",),
            "assignment timestamps are malformed or end is not greater than start",
            ~_assignment_valid(),
        ),
        Check(
            ("EQA-002", "XEN-003"),
            "Equipment Assignment project_id differs from the resolved Job Site project_id",
            F.col("_found_job_site_id") & ~F.col("_site_project").eqNullSafe(F.col("project_id")),
        ),
    ]


def _assignment_periods(rows: DataFrame) -> DataFrame:
    """Valid periods; times with and without an offset are never compared."""
    period = F.when(
        _assignment_valid(),
        F.struct(
            F.col("_start.aware").alias("aware"),
            F.col("_start.at_us").alias("start_us"),
            interval_end_us(F.col("assignment_end_timestamp"), F.col("_end")).alias("end_us"),
        ),
    )
    # Unnesting drops the invalid rows without parsing again for a filter.
    return rows.select(
        ROW, "_record_id", "equipment_id", F.inline(F.array_compact(F.array(period)))
    )


def _assignment_overlaps(rows: DataFrame, _tables: dict[str, DataFrame]) -> DataFrame:
    hit = overlapping(_assignment_periods(rows), ["equipment_id", "aware"], "start_us", "end_us", ROW)
    return flagged(
        hit, ["EQA-003", "XEN-005"], "equipment assignment overlaps another period for the same equipment"
    )


def _assignment_adjacent(rows: DataFrame, _tables: dict[str, DataFrame]) -> DataFrame:
    hit = adjacent(_assignment_periods(rows), ["equipment_id", "aware"], "start_us", "end_us")
    return flagged(hit, ["EQA-004"], "equipment assignment has an accepted adjacent boundary")


def _threshold_prepare(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "_from_day": F.unix_date(iso_date(F.col("effective_start_date"))),
            "_to_day": F.unix_date(iso_date(F.col("effective_end_date"))),
        }
    )


def _threshold_checks() -> list[Check]:
    entity = "safety_thresholds"
    first, last, last_text = F.col("_from_day"), F.col("_to_day"), F.col("effective_end_date")
    metric, operator = F.col("metric_code"), F.col("comparison_operator")
    by_code = metric.eqNullSafe("WEATHER_CODE")
    value, codes = F.col("threshold_value"), F.col("weather_code_set")
    return [
        *_critical(
            entity,
            "threshold_id activity_id metric_code comparison_operator unit "
            "threshold_value_or_code_set severity recommended_action_code effective_start_date "
            "is_active override_flag",
        ),
        Check(
            ("SFT-001",),
            "effective dates are malformed or end precedes start",
            first.isNull() | (present(last_text) & (last.isNull() | (last < first))),
        ),
        Check(
            ("SFT-003",),
            "comparison_operator is incompatible with the verified metric structure",
            (by_code & ~operator.eqNullSafe("IN"))
            | (one_of(metric, NUMERIC_METRICS) & ~operator.eqNullSafe(">=")),
        ),
        Check(
            ("SFT-004",),
            "WEATHER_CODE threshold payload is invalid",
            by_code & (missing(codes) | present(value)),
        ),
        Check(
            ("SFT-005",),
            "numeric threshold payload is invalid",
            ~by_code & (finite_decimal(value).isNull() | present(codes)),
        ),
        Check(
            ("SFT-006",),
            "recommended_action_code is null or empty",
            missing(F.col("recommended_action_code")),
        ),
        Check(
            ("SFT-007",),
            "CRITICAL threshold does not set override_flag to true",
            F.col("severity").eqNullSafe("CRITICAL") & ~F.col("override_flag").eqNullSafe("True"),
        ),
    ]


_FOREVER = 2_147_483_647
_PAYLOAD = (
    "comparison_operator", "unit", "threshold_value_or_code_set", "threshold_value",
    "weather_code_set", "recommended_action_code", "override_flag",
)


def _threshold_periods(rows: DataFrame, _tables: dict[str, DataFrame]) -> DataFrame:
    last_text = F.col("effective_end_date")
    usable = F.col("_from_day").isNotNull() & (missing(last_text) | F.col("_to_day").isNotNull())
    period = F.when(
        usable,
        F.struct(
            F.col("_from_day").cast("long").alias("first_day"),
            F.when(missing(last_text), F.lit(_FOREVER)).otherwise(F.col("_to_day")).cast("long").alias("last_day"),
        ),
    )
    active = rows.where(F.col("is_active").eqNullSafe("True")).select(
        ROW,
        "_record_id",
        "activity_id",
        "metric_code",
        "severity",
        F.when(present(F.col("equipment_type_id")), F.col("equipment_type_id")).alias("equipment_type"),
        F.to_json(F.struct(*_PAYLOAD), {"ignoreNullFields": "false"}).alias("payload"),
        F.inline(F.array_compact(F.array(period))),
    )
    scope = ["activity_id", "metric_code", "severity", "equipment_type"]
    met = period_conflicts(active, scope, "first_day", "last_day", "payload", ROW)
    entries = [
        F.when(
            F.col(column),
            F.struct(F.lit(rule_id).alias("rule_id"), F.lit(message).alias("message")),
        )
        for column, rule_id, message in (
            ("overlaps", "SFT-002", "active safety threshold period overlaps another rule in the same scope"),
            ("overlaps", "XEN-006", "active safety threshold period overlaps another rule in the same scope"),
            ("conflicts", "SFT-008", "simultaneously active same-scope safety rules have conflicting payloads"),
        )
    ]
    return met.select(
        ROW, "_record_id", F.explode(F.array_compact(F.array(*entries))).alias("_hit")
    ).select(ROW, "_record_id", "_hit.rule_id", "_hit.message", F.lit(1).cast("long").alias("occurrences"))


MASTER = (
    "regions", "offices", "employees", "projects", "job_sites", "crews",
    "activities", "equipment_types", "equipment",
)

ENTITIES = (
    _master(
        "regions",
        "region_id region_code region_name region_description",
        "region_id region_code region_name",
        "region_id",
        ("region_code", "REG-001", "REG-002"),
        "region_id region_code",
        ("region_name", "REG-003"),
    ),
    _master(
        "offices",
        "office_id office_code office_name region_id office_description",
        "office_id office_code office_name region_id",
        "office_id",
        ("office_code", "OFF-001", "OFF-003"),
        "office_id office_code region_id",
        ("office_name", "OFF-004"),
    ),
    _master(
        "employees",
        "employee_id employee_number employee_name home_office_id employment_status termination_date employee_role_code",
        "employee_id employee_number employee_name home_office_id employment_status",
        "employee_id",
        ("employee_number", "EMP-001", "EMP-003"),
        "employee_id employee_number employee_name home_office_id employment_status",
        set_rules=(_terminated_leads,),
        set_columns=("employee_id", "employment_status"),
    ),
    _master(
        "projects",
        "project_id project_code project_name office_id project_manager_employee_id field_manager_employee_id "
        "status project_start_date project_end_date priority_code project_description parent_project_code",
        "project_id project_code project_name office_id project_manager_employee_id field_manager_employee_id status",
        "project_id",
        ("project_code", "PRJ-001", "PRJ-002"),
        "project_id project_code office_id project_manager_employee_id field_manager_employee_id status",
        ("project_name", "PRJ-003"),
    ),
    _master(
        "job_sites",
        "job_site_id job_site_code job_site_name project_id weather_location_code job_site_description",
        "job_site_id job_site_code job_site_name project_id weather_location_code",
        "job_site_id",
        ("job_site_code", "JBS-001", "JBS-003"),
        "job_site_id job_site_code job_site_name project_id weather_location_code",
        checks=_site_checks,
    ),
    _master(
        "crews",
        "crew_id crew_code home_office_id crew_lead_employee_id crew_status crew_description",
        "crew_id crew_code home_office_id crew_status",
        "crew_id",
        ("crew_code", "CRW-001", "CRW-003"),
        "crew_id crew_code home_office_id crew_status",
        checks=_crew_checks,
    ),
    _master(
        "activities",
        "activity_id activity_code activity_name activity_description activity_category",
        "activity_id activity_code activity_name",
        "activity_id",
        ("activity_code", "ACT-001", "ACT-002"),
        "activity_id activity_code",
        ("activity_name", "ACT-003"),
    ),
    _master(
        "equipment_types",
        "equipment_type_id equipment_type_code equipment_type_name equipment_type_description equipment_category",
        "equipment_type_id equipment_type_code equipment_type_name",
        "equipment_type_id",
        ("equipment_type_code", "EQT-001", "EQT-002"),
        "equipment_type_id equipment_type_code",
        ("equipment_type_name", "EQT-003"),
    ),
    _master(
        "equipment",
        "equipment_id equipment_code equipment_type_id equipment_status serial_number asset_tag equipment_description",
        "equipment_id equipment_code equipment_type_id equipment_status",
        "equipment_id",
        ("equipment_code", "EQP-001", "EQP-003"),
        "equipment_id equipment_code equipment_type_id",
        ("equipment_status", "EQP-004"),
    ),
    Entity(
        "field_schedules",
        tuple(
            "field_schedule_id project_id job_site_id crew_id activity_id scheduled_start_timestamp "
            "scheduled_end_timestamp scheduled_date planned_crew_hours planned_crew_size planned_labor_hours "
            "status rescheduled_from_schedule_id scenario_id".split()
        ),
        tuple(
            "field_schedule_id project_id job_site_id crew_id activity_id scheduled_start_timestamp "
            "scheduled_end_timestamp scheduled_date planned_crew_hours planned_crew_size planned_labor_hours "
            "status rescheduled_from_schedule_id".split()
        ),
        "field_schedule_id",
        _schedule_checks,
        _schedule_prepare,
        (_schedule_closed, _schedule_open, _schedule_cycles),
        (_unique("field_schedules", _ID),),
        (_ID, _FROM, "status"),
    ),
    Entity(
        "equipment_assignments",
        tuple(
            "assignment_id equipment_id job_site_id project_id assignment_start_timestamp "
            "assignment_end_timestamp assignment_note scenario_id".split()
        ),
        tuple("assignment_id equipment_id job_site_id project_id assignment_start_timestamp".split()),
        "assignment_id",
        _assignment_checks,
        _assignment_prepare,
        (_assignment_overlaps, _assignment_adjacent),
        (_unique("equipment_assignments", "assignment_id"),),
        ("equipment_id", "assignment_end_timestamp", "_start", "_end"),
    ),
    Entity(
        "safety_thresholds",
        tuple(
            "threshold_id activity_id equipment_type_id metric_code comparison_operator unit "
            "threshold_value_or_code_set threshold_value weather_code_set severity recommended_action_code "
            "effective_start_date effective_end_date is_active override_flag".split()
        ),
        tuple(
            "threshold_id activity_id metric_code comparison_operator unit threshold_value_or_code_set "
            "severity recommended_action_code effective_start_date is_active override_flag".split()
        ),
        "threshold_id",
        _threshold_checks,
        _threshold_prepare,
        (_threshold_periods,),
        (_unique("safety_thresholds", "threshold_id"),),
        ("is_active", "activity_id", "equipment_type_id", "metric_code", "severity", "effective_end_date", "_from_day", "_to_day", *_PAYLOAD),
    ),
)

_ANY = ("XEN-001",)
LINKS = (
    Link("offices", "region_id", "regions", "region_id", rule_ids=("XEN-001", "OFF-002")),
    Link("employees", "home_office_id", "offices", "office_id", rule_ids=("XEN-001", "EMP-002")),
    Link("projects", "office_id", "offices", "office_id", rule_ids=_ANY),
    Link("projects", "project_manager_employee_id", "employees", "employee_id", rule_ids=_ANY),
    Link("projects", "field_manager_employee_id", "employees", "employee_id", rule_ids=_ANY),
    Link("job_sites", "project_id", "projects", "project_id", rule_ids=("XEN-001", "JBS-002")),
    Link("crews", "home_office_id", "offices", "office_id", rule_ids=("XEN-001", "CRW-002")),
    Link(
        "crews", "crew_lead_employee_id", "employees", "employee_id", nullable=True, rule_ids=_ANY,
        attributes={"_lead_status": "employment_status", "_lead_office": "home_office_id"},
    ),
    Link("field_schedules", "project_id", "projects", "project_id", rule_ids=_ANY),
    Link(
        "field_schedules", "job_site_id", "job_sites", "job_site_id", rule_ids=_ANY,
        attributes={"_site_project": "project_id"},
    ),
    Link("field_schedules", "crew_id", "crews", "crew_id", rule_ids=_ANY),
    Link("field_schedules", "activity_id", "activities", "activity_id", rule_ids=_ANY),
    Link("field_schedules", _FROM, "field_schedules", _ID, nullable=True, rule_ids=_ANY),
    Link("equipment", "equipment_type_id", "equipment_types", "equipment_type_id", rule_ids=("XEN-001", "EQP-002")),
    Link("equipment_assignments", "equipment_id", "equipment", "equipment_id", rule_ids=_ANY),
    Link(
        "equipment_assignments", "job_site_id", "job_sites", "job_site_id", rule_ids=_ANY,
        attributes={"_site_project": "project_id"},
    ),
    Link("equipment_assignments", "project_id", "projects", "project_id", rule_ids=_ANY),
    Link("safety_thresholds", "activity_id", "activities", "activity_id", rule_ids=_ANY),
    Link("safety_thresholds", "equipment_type_id", "equipment_types", "equipment_type_id", nullable=True, rule_ids=_ANY),
)

OPERATIONS = Pack(RULES, ENTITIES, LINKS, {"master": MASTER})
