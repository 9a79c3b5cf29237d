"""Hard gates over an accepted dataset.

The gates use the rule machinery with their own checks: what a rule may retain
with a warning, a gate rejects.  ``accepted_dataset`` reports every reason with
the number of rows behind it; an empty result means the set is accepted.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchstone.functions import iso_date, missing, one_of, present
from touchstone.functions.values import DAY_US
from touchstone.operators.keys import lookup
from touchstone.operators.lineage import cycle_members, without_successor
from touchstone.plans import operations as ops
from touchstone.plans.engine import entity_findings, prepared
from touchstone.plans.rules import ROW, Check, Entity, Pack, Unique, flagged
from touchstone.session import entity_jobs, materialize

# Gate-only domains.
PROJECT_STATUSES = ("Planned", "Active", "Closed", "Cancelled")
SCENARIOS = (
    "normal_operations", "moderate_weather", "high_wind_equipment", "extreme_heat",
    "heavy_precipitation", "lightning_override", "crew_reschedule", "equipment_relocation",
    "multiple_project_conflict",
)
RELOCATION = "equipment_relocation"


class GateError(ValueError):
    """The dataset is not acceptable."""


def _reject(message: str, fails: Column) -> Check:
    return Check(("REJECT",), message, fails)


def _keyed(entity: Entity, *, code: str | None = None, checks=tuple, set_rules=(), unique=()) -> Entity:
    keys = [entity.primary_key, *([code] if code else [])]

    def all_checks() -> list[Check]:
        required = [_reject(f"{entity.name}.{k} is required", missing(F.col(k))) for k in keys]
        return [*required, *checks()]

    single = tuple(Unique((k,), (("REJECT", f"duplicate {entity.name}.{k}"),)) for k in keys)
    return replace(entity, checks=all_checks, set_rules=set_rules, unique=(*single, *unique))


def _project_checks() -> list[Check]:
    begin, end = iso_date(F.col("project_start_date")), iso_date(F.col("project_end_date"))
    return [
        _reject("invalid project status", ~one_of(F.col("status"), PROJECT_STATUSES)),
        _reject("invalid project dates", ~F.coalesce(end >= begin, F.lit(False))),
    ]


def _site_checks() -> list[Check]:
    outside = ~one_of(F.col("weather_location_code"), ops.WEATHER_LOCATIONS)
    return [_reject("invalid weather location", outside)]


def _crew_checks() -> list[Check]:
    active = F.col("_found_crew_lead_employee_id") & F.col("_lead_status").eqNullSafe("Active")
    return [_reject("crew lead must be active", missing(F.col("crew_lead_employee_id")) | ~active)]


def _schedule_checks() -> list[Check]:
    start, end = F.col("_start"), F.col("_end")
    day = F.floor(start["wall_us"] / F.lit(DAY_US)) == F.col("_day")
    window = (start["aware"] == end["aware"]) & (end["at_us"] > start["at_us"]) & day
    span = (end["at_us"] - start["at_us"]).cast("decimal(20,0)")
    hours = F.col("_hours").try_cast("decimal(20,9)") * F.lit(3_600_000_000).cast("decimal(10,0)") == span
    labor = ops._product_matches(F.col("_labor"), F.col("_hours"), F.col("_size"))
    before, own = F.col(ops._FROM), F.col(ops._ID)
    return [
        _reject("invalid schedule timestamps/date", ~F.coalesce(window, F.lit(False))),
        _reject("crew hours differ from duration", ~F.coalesce(hours, F.lit(False))),
        _reject("invalid planned labor hours", ~F.coalesce(labor, F.lit(False))),
        _reject(
            "schedule project/site mismatch",
            F.col("_found_job_site_id") & ~F.col("_site_project").eqNullSafe(F.col("project_id")),
        ),
        _reject("invalid schedule status", ~one_of(F.col("status"), ops.SCHEDULE_STATUSES)),
        _reject("invalid reschedule predecessor", present(before) & (before == own)),
        _reject(
            "predecessor must be Rescheduled",
            present(before)
            & F.col(f"_found_{ops._FROM}")
            & ~F.col("_before_status").eqNullSafe("Rescheduled"),
        ),
    ]


def _schedule_cycles(rows: DataFrame, _tables: dict[str, DataFrame]) -> DataFrame:
    members = cycle_members(rows.select(ROW, ops._ID, ops._FROM), ops._ID, ops._FROM, ROW)
    hit = rows.join(members, rows[ops._ID] == members["node"], "left_semi")
    return flagged(hit, ["REJECT"], "cyclic reschedule lineage")


def _schedule_open(rows: DataFrame, _tables: dict[str, DataFrame]) -> DataFrame:
    hit = without_successor(rows, ops._ID, ops._FROM, "status", "Rescheduled")
    return flagged(hit, ["REJECT"], "rescheduled row lacks successor")


def _assignment_checks() -> list[Check]:
    closed = ops._assignment_valid() & present(F.col("assignment_end_timestamp"))
    return [
        _reject("invalid assignment window", ~closed),
        _reject(
            "assignment project/site mismatch",
            F.col("_found_job_site_id") & ~F.col("_site_project").eqNullSafe(F.col("project_id")),
        ),
    ]


def _assignment_overlaps(rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    hit = ops._assignment_overlaps(rows, tables).where("rule_id = 'EQA-003'")
    return flagged(hit, ["REJECT"], "overlapping equipment assignment")


def _threshold_checks() -> list[Check]:
    value, codes = F.col("threshold_value"), F.col("weather_code_set")
    by_code = F.col("metric_code").eqNullSafe("WEATHER_CODE")
    sound = (by_code & present(codes) & missing(value)) | (~by_code & present(value) & missing(codes))
    override = F.col("override_flag").eqNullSafe("True")
    return [
        _reject("threshold action required", missing(F.col("recommended_action_code"))),
        _reject("critical threshold must override", F.col("severity").eqNullSafe("CRITICAL") & ~override),
        _reject("incompatible threshold structure", ~sound),
    ]


#: Whatever is null in a scope is a value of it.
_THRESHOLD_SCOPE = Unique(
    ("activity_id", "metric_code", "severity", "equipment_type_id"),
    (("REJECT", "overlapping/ambiguous active threshold"),),
    null_safe=True,
)

_CODES = {
    "regions": "region_code", "offices": "office_code", "employees": "employee_number",
    "projects": "project_code", "job_sites": "job_site_code", "crews": "crew_code",
    "activities": "activity_code", "equipment_types": "equipment_type_code",
    "equipment": "equipment_code",
}
_CHECKS = {
    "projects": _project_checks,
    "job_sites": _site_checks,
    "crews": _crew_checks,
    "field_schedules": _schedule_checks,
    "equipment_assignments": _assignment_checks,
    "safety_thresholds": _threshold_checks,
}
_SETS = {
    "field_schedules": (_schedule_cycles, _schedule_open),
    "equipment_assignments": (_assignment_overlaps,),
}
_UNIQUE = {"safety_thresholds": (_THRESHOLD_SCOPE,)}
_ATTRIBUTES = {ops._FROM: {"_before_status": "status"}}

GATES = Pack(
    [],
    [
        _keyed(e, code=_CODES.get(name), checks=_CHECKS.get(name, tuple), set_rules=_SETS.get(name, ()), unique=_UNIQUE.get(name, ()))
        for name, e in ops.OPERATIONS.entities.items()
    ],
    [
        replace(link, rule_ids=("REJECT",), attributes=_ATTRIBUTES.get(link.field, link.attributes))
        for link in ops.LINKS
    ],
)


def _coverage(table: DataFrame, entity: str, wanted: tuple[str, ...], message: str) -> DataFrame:
    """One row per scenario that no row of the table carries."""
    spark = table.sparkSession
    needed = spark.createDataFrame([(s,) for s in wanted], "scenario string")
    rows = prepared(table, GATES.entity(entity))
    seen = lookup(needed, "scenario", rows, "scenario_id", {}, found="_seen").where("NOT _seen")
    return seen.select(
        F.lit(entity).alias("entity"),
        F.concat(F.lit(f"{message}: "), "scenario").alias("reason"),
        F.lit(1).cast("long").alias("failures"),
    )


def accepted_dataset(
    tables: Mapping[str, DataFrame],
    *,
    row_counts: Mapping[str, int] | None = None,
    scenarios: tuple[str, ...] = SCENARIOS,
) -> DataFrame:
    """Reasons to reject the dataset: ``entity, reason, failures``."""
    if set(tables) != set(GATES.entities):
        raise GateError("dataset must contain exactly the 12 approved entities")

    def reasons(name: str) -> DataFrame:
        found = entity_findings(tables, GATES, name).groupBy("entity", F.col("message").alias("reason"))
        return materialize(found.agg(F.sum("occurrences").alias("failures")))

    spark = next(iter(tables.values())).sparkSession
    parts = [found for found, _ in entity_jobs(spark, GATES.entities, reasons).values()]
    for name, wanted in (row_counts or {}).items():
        size = tables[name].agg(F.count(F.lit(1)).alias("failures")).where(F.col("failures") != wanted)
        parts.append(
            size.select(
                F.lit(name).alias("entity"),
                F.lit(f"{name} expected {wanted} rows").alias("reason"),
                "failures",
            )
        )
    if scenarios:
        parts.append(
            _coverage(tables["field_schedules"], "field_schedules", scenarios, "missing scenario coverage")
        )
        parts.append(
            _coverage(tables["equipment_assignments"], "equipment_assignments", (RELOCATION,), "missing relocation scenario")
        )
    return reduce(DataFrame.unionByName, parts)


def require_accepted(tables: Mapping[str, DataFrame], **options) -> None:
    """Raise ``GateError`` naming all reasons, if there are any: at most one per check and entity."""
    shown = accepted_dataset(tables, **options).orderBy("entity", "reason").collect()
    if shown:
        raise GateError("; ".join(f"{r.entity}: {r.reason} ({r.failures})" for r in shown))
