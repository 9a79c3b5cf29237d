"""Forecast records: structural contract, one row per hour, strict types."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchstone.functions.values import _spelled_out, iso_timestamp
from touchstone.functions.variants import (
    absent,
    absent_kind,
    array_of,
    at,
    is_object,
    kind,
    misaligned,
    missing_fields,
    strict_float,
    strict_int,
    text,
)
from touchstone.session import materialize
from touchstone.sources.weather_json import RECORD_AT, RECORD_FILE

# The fields of the contract.
TOP_FIELDS = (
    "source_system", "endpoint_name", "location_id", "location_name", "pipeline_run_id",
    "ingestion_timestamp_utc", "attempt_count", "http_status_code", "hourly_record_count",
    "request_parameters", "payload",
)
PAYLOAD_FIELDS = ("latitude", "longitude", "timezone", "utc_offset_seconds", "hourly_units", "hourly")
HOURLY_FIELDS = (
    "time", "temperature_2m", "apparent_temperature", "relative_humidity_2m",
    "precipitation", "weather_code", "wind_gusts_10m",
)
RESPONSE_FIELDS = ("hourly", "hourly_units", "latitude", "longitude", "timezone")
KEYS = ("pipeline_run_id", "location_id", "forecast_timestamp_local")
UNITS = {
    "temperature_unit": "temperature_2m",
    "apparent_temperature_unit": "apparent_temperature",
    "relative_humidity_unit": "relative_humidity_2m",
    "precipitation_unit": "precipitation",
    "weather_code_unit": "weather_code",
    "wind_gust_unit": "wind_gusts_10m",
}

# The messages of the contract.
SAYS = {
    "top": "Bronze record is missing required top-level fields: ",
    "object": "Expected '{}' to be an object, but received %s.",
    "payload": "Bronze payload is missing required fields: ",
    "hourly": "Bronze hourly payload is missing required fields: ",
    "array": "Expected 'payload.hourly.{}' to be an array.",
    "empty": "Bronze hourly arrays must contain at least one forecast record.",
    "misaligned": "Bronze hourly arrays are misaligned. Expected %d elements based on 'time'; received %s.",
    "declared": "'hourly_record_count' must be an integer.",
    "count": "'hourly_record_count' does not match the actual hourly array length. Declared=%d, actual=%d.",
    "units": "Bronze hourly units are missing required fields: ",
    "days": "Bronze request parameters are missing required fields: ['forecast_days']",
    "response": "API response payload must be a JSON object.",
    "response_fields": "API response is missing required fields: ",
    "response_hourly": "API response field 'hourly' is not an object.",
    "response_times": "API response does not contain hourly timestamps.",
    "response_variables": "API response is missing requested hourly variables: ",
    "response_uneven": "Hourly variables do not align with the timestamp count: ",
    "boolean": "' cannot be a Boolean value.",
    "stamp": "' contains an invalid ISO-8601 timestamp.",
}


class WeatherError(ValueError):
    """Forecast records break the contract or hold values that cannot be converted."""


def _listed(names: Column) -> Column:
    return F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))


def _sizes_shown(sizes: Column) -> Column:
    entries = F.transform(
        F.map_entries(sizes), lambda e: F.format_string("'%s': %d", e["key"], e["value"])
    )
    return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))


def _first(*steps: tuple[Column, Column]) -> Column:
    chosen = F.when(steps[0][0], steps[0][1])
    for condition, message in steps[1:]:
        chosen = chosen.when(condition, message)
    return chosen


_WHOLE_HOURS = ("relative_humidity_2m", "weather_code")


def _even(field: str) -> str:
    """Types of arrays whose elements are all converted as the array is."""
    if field == "time":
        return r"^ARRAY<STRING>$"
    if field in _WHOLE_HOURS:
        return r"^ARRAY<(VOID|BIGINT)>$"
    return r"^ARRAY<(VOID|BIGINT|FLOAT|DOUBLE|DECIMAL\(\d+,\d+\))>$"


def _array_type(field: str) -> str:
    return "array<string>" if field == "time" else "array<bigint>" if field in _WHOLE_HOURS else "array<double>"


def _checked(records: DataFrame) -> DataFrame:
    """Add ``violation`` and the hourly arrays it was judged by.

    ``_h_<field>`` is an array of one type, converted; ``_a_<field>`` any other.
    """
    record = F.col("record")
    rows = records.withColumns(
        {
            "_payload": at(record, "payload"),
            "_hourly": at(record, "payload.hourly"),
            "_units": at(record, "payload.hourly_units"),
            "_declared": at(record, "hourly_record_count"),
        }
    )
    hourly_values = {n: at(F.col("_hourly"), n) for n in HOURLY_FIELDS}
    rows = rows.withColumns({f"_k_{n}": kind(value) for n, value in hourly_values.items()})
    even = {n: F.coalesce(F.col(f"_k_{n}").rlike(_even(n)), F.lit(False)) for n in HOURLY_FIELDS}
    # Arrays of one type are converted in one step; only others become single values.
    rows = rows.withColumns(
        {f"_h_{n}": F.when(even[n], at(F.col("_hourly"), n, _array_type(n))) for n in HOURLY_FIELDS}
        | {f"_a_{n}": F.when(~even[n], array_of(value)) for n, value in hourly_values.items()}
    )
    top = missing_fields(record, TOP_FIELDS)
    inner = missing_fields(F.col("_payload"), PAYLOAD_FIELDS)
    hourly = missing_fields(F.col("_hourly"), HOURLY_FIELDS)
    units = missing_fields(F.col("_units"), list(UNITS.values()))
    sizes = {n: F.coalesce(F.array_size(f"_h_{n}"), F.array_size(f"_a_{n}"), F.lit(-1)) for n in HOURLY_FIELDS}
    count = sizes["time"]
    wrong = misaligned(sizes, count)
    declared = F.try_variant_get("_declared", "$", "bigint")

    def object_step(name: str, column: str) -> tuple[Column, Column]:
        message = F.format_string(SAYS["object"].format(name), F.lower(kind(F.col(column))))
        return ~is_object(F.col(column)), message

    steps = [
        (F.size(top) > 0, F.concat(F.lit(SAYS["top"]), _listed(top))),
        object_step("payload", "_payload"),
        (F.size(inner) > 0, F.concat(F.lit(SAYS["payload"]), _listed(inner))),
        object_step("payload.hourly", "_hourly"),
        (F.size(hourly) > 0, F.concat(F.lit(SAYS["hourly"]), _listed(hourly))),
        *[
            (sizes[n] < 0, F.lit(SAYS["array"].format(n)))
            for n in HOURLY_FIELDS
        ],
        (count == 0, F.lit(SAYS["empty"])),
        (
            F.size(wrong) > 0,
            F.format_string(SAYS["misaligned"], count, _sizes_shown(wrong)),
        ),
        (kind(F.col("_declared")) != "BIGINT", F.lit(SAYS["declared"])),
        (
            declared != count,
            F.format_string(SAYS["count"], declared, count),
        ),
        object_step("payload.hourly_units", "_units"),
        (F.size(units) > 0, F.concat(F.lit(SAYS["units"]), _listed(units))),
        (
            absent(at(record, "request_parameters.forecast_days")),
            F.lit(SAYS["days"]),
        ),
    ]
    arrays = [f"_{part}_{n}" for n in HOURLY_FIELDS for part in "ha"]
    return rows.withColumn("violation", _first(*steps)).select(*records.columns, *arrays, "violation")


def contract(records: DataFrame) -> DataFrame:
    """Add ``violation``: the first broken clause of the record contract, else null."""
    return _checked(records).select(*records.columns, "violation")


def response_contract(payloads: DataFrame, column: str, variables: Sequence[str]) -> DataFrame:
    """Add ``violation`` for stored response payloads against the requested variables."""
    payload = F.col(column)
    hourly = at(payload, "hourly")
    time_size = F.size(array_of(at(hourly, "time")))
    top = missing_fields(payload, RESPONSE_FIELDS)
    lacking = missing_fields(hourly, list(variables))
    uneven = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(F.size(array_of(at(hourly, v))) == time_size, F.lit(False)), F.lit(v))
                for v in variables
            ]
        )
    )
    return payloads.withColumn(
        "violation",
        _first(
            (~is_object(payload), F.lit(SAYS["response"])),
            (F.size(top) > 0, F.concat(F.lit(SAYS["response_fields"]), _listed(top))),
            (~is_object(hourly), F.lit(SAYS["response_hourly"])),
            (~F.coalesce(time_size > 0, F.lit(False)), F.lit(SAYS["response_times"])),
            (F.size(lacking) > 0, F.concat(F.lit(SAYS["response_variables"]), _listed(lacking))),
            (F.size(uneven) > 0, F.concat(F.lit(SAYS["response_uneven"]), _listed(uneven))),
        ),
    )


@dataclass(frozen=True)
class Flattened:
    """Typed hourly rows, and what was kept out: file, place in the file, and reason."""

    rows: DataFrame
    rejected: DataFrame


def _stamp_text(value: Column) -> Column:
    return F.when(kind(value) == "STRING", F.trim(F.try_variant_get(value, "$", "string")))


def _fault(
    source: Column, name: Column, value: Column, path: Column, wanted: str, needed: bool
) -> Column:
    """Why a value of type ``name`` could not be converted; null when it could."""
    broken = value.isNull() if needed else value.isNull() & ~absent_kind(name)
    reason = F.when(
        name.eqNullSafe("BOOLEAN"), F.concat(F.lit("'"), path, F.lit(SAYS["boolean"]))
    ).otherwise(
        F.concat(F.lit("'"), path, F.lit(f"' could not be converted to {wanted}: "), F.to_json(source), F.lit("."))
    )
    return F.when(broken, reason)


def _stamp_fault(value: Column, path: Column) -> Column:
    return F.when(value.isNull(), F.concat(F.lit("'"), path, F.lit(SAYS["stamp"])))


# Record-level numbers: name, path, whole, needed.
_RECORD_NUMBERS = (
    ("latitude", "payload.latitude", False, False),
    ("longitude", "payload.longitude", False, False),
    ("elevation", "payload.elevation", False, False),
    ("utc_offset_seconds", "payload.utc_offset_seconds", True, True),
    ("forecast_days", "request_parameters.forecast_days", True, True),
    ("attempt_count", "attempt_count", True, True),
    ("http_status_code", "http_status_code", True, True),
)
_RECORD_TEXTS = {
    "pipeline_run_id": "pipeline_run_id",
    "source_system": "source_system",
    "endpoint_name": "endpoint_name",
    "location_id": "location_id",
    "location_name": "location_name",
    "timezone": "payload.timezone",
    "timezone_abbreviation": "payload.timezone_abbreviation",
    **{name: f"payload.hourly_units.{source}" for name, source in UNITS.items()},
}
COLUMNS = (
    "pipeline_run_id", "source_system", "endpoint_name", "location_id", "location_name",
    "ingestion_timestamp_utc", "forecast_timestamp_local", "forecast_hour_index",
    *HOURLY_FIELDS[1:], "latitude", "longitude", "elevation", "timezone", "timezone_abbreviation",
    "utc_offset_seconds", *UNITS, "forecast_days", "attempt_count", "http_status_code",
)


def _convert(value: Column, name: Column, whole: bool) -> Column:
    return (strict_int if whole else strict_float)(value, name)


def _hour_stamp(text_: Column) -> Column:
    """Wall clock of an ISO text; the spelling of the service needs one look only."""
    usual = F.when(text_.rlike(r"^(?!0000)\d{4}-\d{2}-\d{2}T\d{2}:\d{2}$"), F.concat(text_, F.lit(":00")))
    return F.coalesce(usual, _spelled_out(F.trim(text_))).try_cast("timestamp_ntz")


def _convert_hours(rows: DataFrame) -> DataFrame:
    """Typed hourly arrays ``_h_<field>`` and the reasons of each, ``_f_<field>``.

    Nearly all arrays are typed by now; only others are judged value by value.
    """

    def position(name: str, at_: Column) -> Column:
        return F.format_string(f"payload.hourly.{name}[%d]", at_)

    def numbers(name: str, whole: bool) -> tuple[Column, Column]:
        values = F.col(f"_a_{name}")
        each = F.transform(values, lambda v: _convert(v, kind(v), whole))

        def fault(v: Column, i: Column) -> Column:
            return _fault(v, kind(v), _convert(v, kind(v), whole), position(name, i), "integer" if whole else "float", False)

        return F.coalesce(f"_h_{name}", each), F.array_compact(F.transform(values, fault))

    written = F.coalesce("_h_time", F.transform("_a_time", lambda v: F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))))
    hours = {n: numbers(n, n in _WHOLE_HOURS) for n in HOURLY_FIELDS[1:]}
    rows = rows.withColumns(
        {f"_h_{n}": values for n, (values, _) in hours.items()}
        | {f"_f_{n}": faults for n, (_, faults) in hours.items()}
        | {"_h_time": F.transform(written, _hour_stamp)}
    )
    bad_times = F.transform("_h_time", lambda t, i: _stamp_fault(t, position("time", i)))
    return rows.withColumn("_f_time", F.when(F.exists("_h_time", lambda t: t.isNull()), F.array_compact(bad_times)))


def judged(checked: DataFrame) -> DataFrame:
    """One row per record with typed values, typed hourly arrays and ``_errors``.

    The whole record is judged where it lies: hours are arrays until it is known
    that all of them may stay, so nothing is unnested for a bad record and no
    other row is asked.  A record with errors has no arrays.
    """
    record, sound = F.col("record"), F.col("violation").isNull()
    rows = checked.withColumns({f"_v_{name}": at(record, path) for name, path, _, _ in _RECORD_NUMBERS})
    rows = rows.withColumns({f"_k_{name}": kind(F.col(f"_v_{name}")) for name, *_ in _RECORD_NUMBERS})
    ingested = _stamp_text(at(record, "ingestion_timestamp_utc"))
    rows = rows.withColumns(
        {name: _convert(F.col(f"_v_{name}"), F.col(f"_k_{name}"), whole) for name, _, whole, _ in _RECORD_NUMBERS}
        | {name: text(at(record, path)) for name, path in _RECORD_TEXTS.items()}
        | {"ingestion_timestamp_utc": F.timestamp_micros(iso_timestamp(ingested)["at_us"])}
        | {f"_{part}_{n}": F.when(sound, F.col(f"_{part}_{n}")) for n in HOURLY_FIELDS for part in "ha"}
    )
    rows = _convert_hours(rows)
    faults = [
        _fault(F.col(f"_v_{name}"), F.col(f"_k_{name}"), F.col(name), F.lit(path), "integer" if whole else "float", needed)
        for name, path, whole, needed in _RECORD_NUMBERS
    ]
    faults.append(_stamp_fault(F.col("ingestion_timestamp_utc"), F.lit("ingestion_timestamp_utc")))
    nothing = F.array().cast("array<string>")
    found = F.concat(F.array_compact(F.array(*faults)), *[F.coalesce(f"_f_{n}", nothing) for n in HOURLY_FIELDS])
    rows = rows.withColumn("_errors", F.when(sound, found).otherwise(F.array("violation")))
    levels = [c for c in COLUMNS if c not in HOURLY_FIELDS and c not in ("forecast_timestamp_local", "forecast_hour_index")]
    kept = F.size("_errors") == 0
    return rows.select(*levels, RECORD_FILE, RECORD_AT, "_errors", *[F.when(kept, F.col(f"_h_{n}")).alias(f"_h_{n}") for n in HOURLY_FIELDS])


def unnest_hours(records: DataFrame) -> DataFrame:
    """One row per hour of the sound records among ``judged`` ones."""
    zipped = F.arrays_zip(*[F.col(f"_h_{n}").alias(n) for n in HOURLY_FIELDS])
    hours = records.where(F.size("_errors") == 0).select("*", F.posexplode(zipped).alias("forecast_hour_index", "_at"))
    named = {n: F.col(f"_at.{n}") for n in HOURLY_FIELDS[1:]} | {"forecast_timestamp_local": F.col("_at.time")}
    return hours.withColumns(named).select(*COLUMNS)


class RejectedRecordsError(WeatherError):
    """Strict mode found bad records; ``rejected`` has every reason of every record."""

    def __init__(self, text: str, rejected: DataFrame) -> None:
        super().__init__(text)
        self.rejected = rejected


def flatten(records: DataFrame, mode: str = "strict") -> Flattened:
    """Hourly rows of all records.

    ``strict`` raises when any record is bad: the error names the first few and
    carries the frame of all reasons as ``rejected``;
    ``quarantine`` keeps whole records out and reports every reason.
    """
    if mode not in ("strict", "quarantine"):
        raise WeatherError("mode must be 'strict' or 'quarantine'")
    if records.isEmpty():
        raise WeatherError("At least one Bronze record is required.")
    if RECORD_AT not in records.columns:
        records = records.withColumn(RECORD_AT, F.lit(0))
    # Parsed once, a row per record; the probe, the rows and the reasons all read this.
    found = materialize(judged(_checked(records)))
    rejected = found.select(RECORD_FILE, RECORD_AT, F.explode("_errors").alias("reason"))
    if mode == "strict":
        shown = rejected.limit(5).collect()
        if shown:
            reasons = "; ".join(f"{r[RECORD_FILE]}: {r['reason']}" for r in shown)
            raise RejectedRecordsError(f"{rejected.count()} problems in Bronze records, among them: {reasons}", rejected)
    return Flattened(unnest_hours(found), rejected)
