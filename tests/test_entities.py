"""How entities are read and judged: scans, one grouping for all keys, overlapping jobs."""

import random
import threading
from collections import Counter

import pytest
from operations_data import clean, frames
from pyspark.sql import functions as F

from touchstone.plans.engine import duplicate_findings, entity_findings, validate
from touchstone.plans.gates import GATES
from touchstone.plans.operations import MASTER, OPERATIONS
from touchstone.plans.rules import Check, Entity, Link, Pack, Unique
from touchstone.session import entity_jobs


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def stored(spark, folder):
    tables = frames(spark, clean())
    for name, table in tables.items():
        table.write.parquet(str(folder / f"{name}.parquet"))
    return {name: spark.read.parquet(str(folder / f"{name}.parquet")) for name in tables}


@pytest.mark.parametrize("pack", [OPERATIONS, GATES], ids=["rules", "gates"])
@pytest.mark.parametrize("name", ["regions", "field_schedules", "equipment_assignments", "safety_thresholds"])
def test_an_entity_is_read_whole_only_once(spark, tmp_path, pack, name):
    tables = stored(spark, tmp_path / "t")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(entity_findings(tables, pack, name))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # The narrow rows are kept by the time the plan is made; what is left is the other scan.
    assert plan.count(f"/{name}.parquet") == 1


@pytest.mark.parametrize("seed", range(3))
def test_all_keys_of_an_entity_in_one_grouping(spark, seed):
    rng = random.Random(seed)

    def value():
        return rng.choice([None, "", " ", *"abcdefgh", "'q'"])

    rows = [(i, f"r{i}", value(), value(), value()) for i in range(40)]
    frame = spark.createDataFrame(rows, "_row_index long, _record_id string, a string, b string, c string")
    rules = (
        Unique(("a",), (("A", "same a: "), ("A2", "again a: ")), shown=True),
        Unique(("b",), (("B", "same b"),)),
        Unique(("b", "c"), (("C", "same b and c"),), null_safe=True),
    )
    got = Counter((r._row_index, r._record_id, r.rule_id, r.message, r.occurrences) for r in duplicate_findings(frame, rules).collect())
    expected = Counter()
    for r in rows:
        for rule, keys in zip(rules, ([2], [3], [3, 4]), strict=True):
            own = tuple(r[k] for k in keys)
            if not rule.null_safe and own[0] in (None, ""):
                continue
            if sum(tuple(o[k] for k in keys) == own for o in rows) > 1:
                for rule_id, message in rule.entries:
                    shown = repr(own[0]) if rule.shown and own[0] != "'q'" else '"' + own[0] + '"' if rule.shown else ""
                    expected[r[0], r[1], rule_id, message + shown, 1] += 1
    assert got == expected
    plan = plan_of(duplicate_findings(frame, rules))
    # Once by hash and once by value for all keys together: a partial and a final step each.
    # The rows found by hash are on both sides of the comparison by value, so their steps show twice.
    assert plan.count("keys=[rule") == 6


def test_values_are_compared_where_hashes_meet(spark, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(7).cast("long"))  # all hashes meet
    frame = spark.createDataFrame([(i, str(i), v) for i, v in enumerate("abcb")], "_row_index long, _record_id string, a string")
    got = duplicate_findings(frame, (Unique(("a",), (("A", "same"),)),)).collect()
    assert sorted(r._row_index for r in got) == [1, 3]


def test_durations_are_each_entitys_own(spark):
    result = validate(frames(spark, clean()), OPERATIONS, "run-1", scope="master")
    assert set(result.durations) == set(MASTER) and all(s > 0 for s in result.durations.values())
    shown = {r.entity: r.duration_seconds for r in result.summary().collect()}
    assert shown == result.durations
    assert result.duration_seconds < sum(result.durations.values())  # they overlap
    assert result.run_summary().first()["duration_seconds"] == result.duration_seconds


def test_entity_jobs_overlap_and_carry_their_tag(spark):
    meet, tags = threading.Barrier(3, timeout=60), {}

    def work(name):
        meet.wait()  # none would pass it alone
        tags[name] = set(map(str, spark.sparkContext.getJobTags()))
        return spark.range(3).count()

    done = entity_jobs(spark, ["a", "b", "c"], work, parallel=3)
    assert {n: v for n, (v, _) in done.items()} == {"a": 3, "b": 3, "c": 3}
    assert tags == {n: {f"touchstone-{n}"} for n in "abc"}
    assert not spark.sparkContext.getJobTags()

    def broken(name):
        raise ValueError(name)

    with pytest.raises(ValueError):
        entity_jobs(spark, ["a"], broken)


def test_links_shuffle_outcomes_not_what_checks_read(spark, tmp_path):
    tables = stored(spark, tmp_path / "t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = entity_findings(tables, OPERATIONS, "field_schedules")
        plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = [part for part in plan.split("\n\n") if "Exchange\nInput" in part]
    assert any("_failed_0" in part for part in shuffled)
    for column in ("planned_crew_hours", "planned_labor_hours", "scheduled_date", "_start", "_end", "_labor"):
        assert not any(f"{column}#" in part.split("Arguments")[0] for part in shuffled), column


def test_more_checks_than_bits_of_a_column(spark):
    # Beside a link: 130 checks, one of them null, one that reads the link.
    def checks():
        own = [Check((f"R{i}",), f"divided by {i}", F.col("n") % i == 0) for i in range(1, 129)]
        return [*own, Check(("N",), "unknown", F.lit(None).cast("boolean")), Check(("L",), "linked", F.col("_found_up") & (F.col("n") > 5))]

    entities = [Entity("a", ("k", "up", "n"), ("k",), "k", checks), Entity("b", ("k",), ("k",), "k")]
    pack = Pack([], entities, [Link("a", "up", "b", "k", rule_ids=("F",))])
    tables = {
        "a": spark.createDataFrame([(i, f"k{i}", "x" if i % 2 else "y", i) for i in (1, 6, 7, 128)], "_row_index long, k string, up string, n int"),
        "b": spark.createDataFrame([(0, "x")], "_row_index long, k string"),
    }
    got = Counter((r._row_index, r.rule_id) for r in entity_findings(tables, pack, "a").collect())
    expected = {(i, f"R{d}") for i in (1, 6, 7, 128) for d in range(1, 129) if i % d == 0} | {(6, "F"), (128, "F"), (7, "L")}
    assert got == Counter(expected)
