"""Forecast contract, flattening and the incremental run."""

import copy
import datetime as dt
import json

import pytest

from touchstone.operators import upsert
from touchstone.plans.weather import KEYS, WeatherError, contract, flatten, response_contract
from touchstone.sources import WeatherReadError, read_weather

HOURS = ["2026-07-14T00:00", "2026-07-14T01:00", "2026-07-14T02:00"]


def record(**changes):
    base = {
        "source_system": "forecast", "endpoint_name": "hourly", "location_id": "TX-DAL",
        "location_name": "Dallas", "pipeline_run_id": "run-1",
        "ingestion_timestamp_utc": "2026-07-14T12:00:00+00:00", "attempt_count": 1,
        "http_status_code": 200, "hourly_record_count": 3,
        "request_parameters": {"forecast_days": 3},
        "payload": {
            "latitude": 32.78, "longitude": -96.8, "elevation": 140.0, "timezone": "America/Chicago",
            "timezone_abbreviation": "CDT", "utc_offset_seconds": -18000,
            "hourly_units": {n: "u" for n in ("time", "temperature_2m", "apparent_temperature", "relative_humidity_2m", "precipitation", "weather_code", "wind_gusts_10m")},
            "hourly": {
                "time": list(HOURS), "temperature_2m": [71.4, 70.25, 69.9], "apparent_temperature": [73.5, 72.75, 71.0],
                "relative_humidity_2m": [40, 43, 41], "precipitation": [0.0, 0.0, 0.1],
                "weather_code": [0, 1, 2], "wind_gusts_10m": [7.5, 8.25, 9.5],
            },
        },
    }
    out = copy.deepcopy(base)
    for path, value in changes.items():
        node, keys = out, path.split("__")
        for key in keys[:-1]:
            node = node[key]
        if value is ...:
            del node[keys[-1]]
        else:
            node[keys[-1]] = value
    return out


def store(folder, records):
    for i, r in enumerate(records):
        place = folder / f"load_date=2026-07-{i % 2 + 14}"
        place.mkdir(parents=True, exist_ok=True)
        (place / f"r{i:03d}.json").write_text(json.dumps(r, indent=1))
    return str(folder)


def number(row):
    return int(row._source_file.split("/r")[-1][:3])


STRUCTURAL = [
    (record(location_id=...), "Bronze record is missing required top-level fields: ['location_id']"),
    (record(location_name=None, attempt_count=...), "Bronze record is missing required top-level fields: ['attempt_count', 'location_name']"),
    (record(payload=[1]), "Expected 'payload' to be an object"),
    (record(payload__timezone=..., payload__hourly=...), "Bronze payload is missing required fields: ['hourly', 'timezone']"),
    (record(payload__hourly="x"), "Expected 'payload.hourly' to be an object, but received string."),
    (record(payload__hourly__precipitation=...), "Bronze hourly payload is missing required fields: ['precipitation']"),
    (record(payload__hourly__weather_code="0,1,2"), "Expected 'payload.hourly.weather_code' to be an array."),
    (record(**{f"payload__hourly__{n}": [] for n in record()["payload"]["hourly"]}), "Bronze hourly arrays must contain at least one forecast record."),
    (record(payload__hourly__wind_gusts_10m=[1.0]), "Bronze hourly arrays are misaligned. Expected 3 elements based on 'time'; received {'wind_gusts_10m': 1}."),
    (record(hourly_record_count="3"), "'hourly_record_count' must be an integer."),
    (record(hourly_record_count=4), "'hourly_record_count' does not match the actual hourly array length. Declared=4, actual=3."),
    (record(payload__hourly_units__precipitation=...), "Bronze hourly units are missing required fields: ['precipitation']"),
    (record(request_parameters={}), "Bronze request parameters are missing required fields: ['forecast_days']"),
]
CASTS = [
    (record(ingestion_timestamp_utc="yesterday"), "'ingestion_timestamp_utc' contains an invalid ISO-8601 timestamp."),
    (record(payload__hourly__time=[HOURS[0], "bad", HOURS[2]]), "'payload.hourly.time[1]' contains an invalid ISO-8601 timestamp."),
    (record(payload__hourly__temperature_2m=[1.0, "hot", 2.0]), "'payload.hourly.temperature_2m[1]' could not be converted to float: \"hot\"."),
    (record(payload__hourly__weather_code=[0, True, 2]), "'payload.hourly.weather_code[1]' cannot be a Boolean value."),
    (record(payload__hourly__relative_humidity_2m=[1, 2, "42.7"]), "'payload.hourly.relative_humidity_2m[2]' could not be converted to integer: \"42.7\"."),
    (record(http_status_code="ok"), "'http_status_code' could not be converted to integer: \"ok\"."),
]


def test_contract_and_casts(spark, tmp_path):
    cases = STRUCTURAL + CASTS
    records = read_weather(spark, store(tmp_path / "w", [c for c, _ in cases] + [record()]))
    found = {number(r): r.violation for r in contract(records).collect()}
    for i, (_, message) in enumerate(STRUCTURAL):
        assert found[i].startswith(message), (i, found[i])
    assert all(found[i] is None for i in range(len(STRUCTURAL), len(cases) + 1))
    split = flatten(records, "quarantine")
    reasons = {number(r): r.reason for r in split.rejected.collect()}
    assert set(reasons) == set(range(len(cases)))
    for i, (_, message) in enumerate(CASTS, len(STRUCTURAL)):
        assert reasons[i] == message
    assert split.rows.count() == 3
    with pytest.raises(WeatherError, match="19 problems"):
        flatten(records)


def test_typed_rows(spark, tmp_path):
    odd = record(
        pipeline_run_id="run-2",
        ingestion_timestamp_utc=" 2026-07-14T12:00:00Z ",
        payload__elevation=None,
        payload__timezone_abbreviation=...,
        payload__hourly__temperature_2m=[None, "70.25", 78],
        payload__hourly__relative_humidity_2m=[42.7, "67", None],
        payload__hourly__apparent_temperature=[None, None, None],
    )
    rows = flatten(read_weather(spark, store(tmp_path / "w", [record(), odd]))).rows
    assert len(rows.columns) == 29
    assert dict(rows.dtypes)["forecast_timestamp_local"] == "timestamp_ntz"
    got = {(r.pipeline_run_id, r.forecast_hour_index): r for r in rows.collect()}
    assert len(got) == 6
    second = got["run-1", 1]
    assert (second.temperature_2m, second.apparent_temperature, second.relative_humidity_2m) == (70.25, 72.75, 43)
    assert (second.precipitation, second.weather_code, second.wind_gusts_10m) == (0.0, 1, 8.25)
    assert second.forecast_timestamp_local == dt.datetime(2026, 7, 14, 1)
    assert second.utc_offset_seconds == -18000 and second.forecast_days == 3
    assert second.ingestion_timestamp_utc == got["run-2", 0].ingestion_timestamp_utc
    assert [got["run-2", i].temperature_2m for i in range(3)] == [None, 70.25, 78.0]
    assert [got["run-2", i].relative_humidity_2m for i in range(3)] == [42, 67, None]
    assert got["run-2", 0].elevation is None and got["run-2", 0].timezone_abbreviation is None
    table = "weather_hours"
    assert upsert(rows, table, KEYS, partition_by=["pipeline_run_id"]).write_action == "created"
    assert upsert(rows, table, KEYS).row_count == 6
    assert spark.table(table).count() == 6
    spark.sql(f"DROP TABLE {table}")


def test_whole_numbers_of_any_size(spark, tmp_path):
    big = 2**31 + 5
    rows = flatten(read_weather(spark, store(tmp_path / "w", [
        record(attempt_count=big, payload__hourly__weather_code=[big, -big, 2**62]),
        record(pipeline_run_id="run-2", payload__hourly__weather_code=[big + 0.5, f" {big}", None], http_status_code=str(big)),
    ]))).rows
    got = {(r.pipeline_run_id, r.forecast_hour_index): r for r in rows.collect()}
    assert [got["run-1", i].weather_code for i in range(3)] == [big, -big, 2**62]
    assert [got["run-2", i].weather_code for i in range(3)] == [big, big, None]
    assert got["run-1", 0].attempt_count == got["run-2", 0].http_status_code == big
    too_big = flatten(read_weather(spark, store(tmp_path / "x", [record(payload__hourly__weather_code=[1, 2**70, 3])])), "quarantine")
    assert too_big.rows.isEmpty() and "payload.hourly.weather_code[1]" in too_big.rejected.first()["reason"]


def test_records_are_judged_without_a_shuffle(spark, tmp_path):
    several = [record(), record(payload__hourly__weather_code=[0, "x", True], http_status_code="ok"), record(location_id=...)]
    split = flatten(read_weather(spark, store(tmp_path / "w", several)), "quarantine")
    for frame in (split.rows, split.rejected):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
    assert split.rows.count() == 3
    reasons = sorted((number(r), r.reason) for r in split.rejected.collect())
    assert reasons == [
        (1, "'http_status_code' could not be converted to integer: \"ok\"."),
        (1, "'payload.hourly.weather_code[1]' could not be converted to integer: \"x\"."),
        (1, "'payload.hourly.weather_code[2]' cannot be a Boolean value."),
        (2, "Bronze record is missing required top-level fields: ['location_id']"),
    ]


def test_several_records_in_a_file(spark, tmp_path):
    good, bad = [record(pipeline_run_id=f"run-{i}") for i in range(2)], record(http_status_code="ok")
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "array.json").write_text(json.dumps([good[0], bad, good[1]], indent=1))
    (folder / "lines.json").write_text("\n".join([json.dumps(good[0]), "{broken", "", json.dumps(good[1]) + "\r", ""]))
    (folder / "one.json").write_text(json.dumps(good[0], indent=2))
    (folder / "torn.json").write_text(json.dumps(good[0], indent=2)[:-40])
    (folder / "empty.json").write_text(" \n")
    (folder / "nothing.json").write_text("[]")
    split = flatten(read_weather(spark, str(folder)), "quarantine")
    assert {r.pipeline_run_id: r["count"] for r in split.rows.groupBy("pipeline_run_id").count().collect()} == {"run-0": 9, "run-1": 6}
    rejected = {(r._source_file.split("/")[-1], r._source_place) for r in split.rejected.collect()}
    assert rejected == {("array.json", 1), ("lines.json", 1), ("torn.json", 0), ("empty.json", 0), ("nothing.json", 0)}


def test_read_errors(spark, tmp_path):
    for bad in (None, "  ", str(tmp_path / "nowhere")):
        with pytest.raises(WeatherReadError):
            read_weather(spark, bad)


def test_response_payload(spark):
    good = record()["payload"]
    cases = [
        (good, None),
        ({k: v for k, v in good.items() if k != "latitude"}, "API response is missing required fields: ['latitude']"),
        (good | {"hourly": "x"}, "API response field 'hourly' is not an object."),
        (good | {"hourly": {"time": []}}, "API response does not contain hourly timestamps."),
        (good | {"hourly": {"time": HOURS, "precipitation": [1, 2, 3]}}, "API response is missing requested hourly variables: ['weather_code']"),
        (good | {"hourly": {"time": HOURS, "precipitation": [1, 2], "weather_code": [1, 2, 3]}}, "Hourly variables do not align with the timestamp count: ['precipitation']"),
        ([1], "API response payload must be a JSON object."),
    ]
    frame = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)], "i int, t string")
    frame = frame.selectExpr("i", "parse_json(t) AS p")
    got = {r.i: r.violation for r in response_contract(frame, "p", ["precipitation", "weather_code"]).collect()}
    assert got == {i: message for i, (_, message) in enumerate(cases)}
