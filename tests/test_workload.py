"""A sample of the registered queries beside their SQL, on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from workload import queries
from workload.check import rows_of
from workload.queries import ORACLES, QUERIES
from workload.views import TABLES

FOLDER = os.environ.get("WORKLOAD_DIR", "/root/testdata/sf0.001")
SAMPLE = (
    "rule_unique", "rule_window", "fk_orders_customer", "lookup_mismatch", "interval_overlap", "interval_adjacent",
    "conflict_pairs", "conflict_counts", "period_conflict", "lineage_cycle", "lineage_closed", "lineage_chains",
    "weather_hours", "cast_audit", "upsert_events", "set_diff", "latest_complete", "quarantine_ids", "dq_summary",
    "operations_crews", "operations_safety_thresholds",
)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not available")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, name):
    base = duckdb.connect()
    for table in TABLES:
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    frame = QUERIES[name](spark, FOLDER)
    cursor = base.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(columns, cursor.fetchall())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="tables not available")
def test_every_rule_fires_in_its_sql():
    from touchstone.plans.operations import OPERATIONS

    base = duckdb.connect()
    for table in TABLES:
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.01/{table}.parquet'")
    fired = set()
    for name in OPERATIONS.entities:
        fired |= {row[0] for row in base.execute(f"SELECT DISTINCT rule_id FROM ({ORACLES[f'operations_{name}']})").fetchall()}
    assert fired == {rule.rule_id for rule in OPERATIONS.rules}


def test_only_columns_that_can_break_a_line_are_searched(spark):
    rows = spark.sql("""SELECT 7 AS n, 1.5D AS d, TIMESTAMP '2026-01-02 03:04:05' AS t, array(1.5, NULL) AS v, 'a"b\\r\\nc' AS s,
        array('x"y', 'z\\n') AS words, named_struct('q', 'p"') AS own, cast(NULL AS string) AS none""")
    shown = rows.select(*[queries._one_line(field).alias(field.name) for field in rows.schema])
    before = rows.select(*[F.regexp_replace(F.col(c).cast("string"), r"[\r\n\"]", " ").alias(c) for c in rows.columns])
    assert shown.collect() == before.collect()
    plan = shown._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_replace") == 4
