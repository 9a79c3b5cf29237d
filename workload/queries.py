"""Registered queries: each runs library operators over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchstone.functions import finite_decimal, iso_date, iso_timestamp, missing, one_of, within_tolerance
from touchstone.functions.variants import absent, at, kind, misaligned, missing_fields, strict_float, strict_int
from touchstone.operators import (
    adjacent,
    chain_summary,
    chains,
    closed_predecessors,
    conflict_counts,
    conflict_pairs,
    cycle_members,
    duplicates,
    lookup,
    looping_roots,
    multiset_difference,
    overlapping,
    period_conflicts,
    referenced,
    unreferenced,
    unresolved,
    upsert,
    upserted,
)
from touchstone.operators.keys import duplicates_by
from touchstone.plans.analytics import exposed, load_dispersion, reassignments
from touchstone.plans.engine import entity_findings, expanded, ranked, validate
from touchstone.plans.gates import accepted_dataset
from touchstone.plans.locations import location_violations
from touchstone.plans.monitoring import complete_runs, finding_evidence, run_status, severity_rollup, status_rollup
from touchstone.plans.operations import MASTER, OPERATIONS
from touchstone.plans.rules import Entity, Pack
from touchstone.plans.weather import HOURLY_FIELDS, flatten, response_contract
from touchstone.session import ensure_checkpoint_dir, entity_jobs
from touchstone.sources import land_all
from workload.operations_oracle import gate_oracle, operations_oracles
from workload.retail import RETAIL, TABLES_SQL, retail_tables
from workload.views import TABLES, load, operations_tables, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


def _us(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


# Row rules


@query("rule_required", "SELECT c_custkey FROM customer WHERE NULLIF(c_mktsegment, 'BUILDING') IS NULL")
def rule_required(spark, folder):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return load(spark, folder, "customer").where(missing(segment)).select("c_custkey")


@query(
    "rule_unique",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)""",
)
def rule_unique(spark, folder):
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return duplicates_by(lines, ["l_orderkey", "l_linenumber"])


@query(
    "rule_unique_text",
    "SELECT doc_id FROM documents WHERE text IN (SELECT text FROM documents WHERE text <> '' GROUP BY text HAVING COUNT(*) > 1)",
)
def rule_unique_text(spark, folder):
    return duplicates(load(spark, folder, "documents").select("doc_id", "text"), "text").select("doc_id")


@query("rule_domain", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('O', 'F')")
def rule_domain(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return orders.where(~one_of(F.col("o_orderstatus"), ("O", "F")))


@query(
    "rule_window",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate < o_orderdate AS early,
        CAST(l_shipdate AS DATE) = CAST(o_orderdate AS DATE) AS same_day
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate <= o_orderdate""",
)
def rule_window(spark, folder):
    def moment(text: Column, name: str) -> dict[str, Column]:
        # Parsed where the text is, before the rows meet.
        return {f"{name}_us": iso_timestamp(text)["at_us"], f"{name}_day": iso_date(F.substring(text, 1, 10))}

    lines = spread(load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"))
    lines = lines.withColumns(moment(F.col("l_shipdate").cast("string"), "end"))
    orders = spread(load(spark, folder, "orders").select("o_orderkey", "o_orderdate"))
    orders = orders.withColumns(moment(F.col("o_orderdate").cast("string"), "start"))
    carried = {c: c for c in ("start_us", "start_day")}
    rows = lookup(lines, "l_orderkey", orders, "o_orderkey", carried, found="known").where("known")
    return rows.where(~F.coalesce(F.col("end_us") > F.col("start_us"), F.lit(False))).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("end_us") < F.col("start_us")).alias("early"), (F.col("start_day") == F.col("end_day")).alias("same_day"),
    )


@query(
    "rule_tolerance",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE NOT ABS(CAST(l_tax AS DECIMAL(9,2)) - CAST(l_discount AS DECIMAL(9,2)) * l_linenumber) <= 0.000001""",
)
def rule_tolerance(spark, folder):
    """Tax text must equal discount text times line number."""
    tax, discount = finite_decimal(F.col("l_tax").cast("string")), finite_decimal(F.col("l_discount").cast("string"))
    product = F.try_multiply(discount.cast("decimal(20,9)"), F.col("l_linenumber").cast("decimal(20,9)"))
    equal = within_tolerance(tax, product)
    lines = load(spark, folder, "lineitem").where(~F.coalesce(equal, F.lit(False)))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "rule_conditional",
    """SELECT p_partkey FROM part WHERE (p_size > 40 AND (p_type = 'ECONOMY' OR p_retailprice > 950))
        OR (p_size <= 40 AND p_type = 'STANDARD')""",
)
def rule_conditional(spark, folder):
    """Large parts need a type and no high price; other parts must not be STANDARD."""
    kind_ = F.nullif(F.col("p_type"), F.lit("ECONOMY"))
    price = F.when(F.col("p_retailprice") > 950, F.col("p_retailprice").cast("string"))
    large = F.col("p_size") > 40
    broken = (large & (missing(kind_) | ~missing(price))) | (~large & F.col("p_type").eqNullSafe("STANDARD"))
    return load(spark, folder, "part").where(broken).select("p_partkey")


_LOCATION_SQL = """WITH locations AS (SELECT CASE WHEN c_acctbal > 9900 THEN 'TOP' ELSE c_name END AS id,
        CASE WHEN c_acctbal < -950 THEN '  ' ELSE c_name END AS name, c_acctbal / 100 AS lat, c_nationkey * 12.5 - 100 AS lon,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'America/Chicago' WHEN 'FURNITURE' THEN 'Mars/Base' WHEN 'MACHINERY' THEN '' ELSE 'UTC' END AS tz,
        CASE WHEN c_nationkey = 3 THEN NULL ELSE c_nationkey > 10 END AS active FROM customer)
    SELECT id AS location_id, 'location_name must be a non-empty string.' AS reason FROM locations WHERE TRIM(name) = ''
    UNION ALL SELECT id, 'latitude must be between -90 and 90.' FROM locations WHERE lat NOT BETWEEN -90 AND 90
    UNION ALL SELECT id, 'longitude must be between -180 and 180.' FROM locations WHERE lon NOT BETWEEN -180 AND 180
    UNION ALL SELECT id, 'timezone must be a non-empty string.' FROM locations WHERE tz = ''
    UNION ALL SELECT id, 'timezone is not valid.' FROM locations WHERE tz = 'Mars/Base'
    UNION ALL SELECT id, 'active must be true or false.' FROM locations WHERE active IS NULL
    UNION ALL SELECT id, 'Duplicate location_id found.' FROM locations WHERE id IN (SELECT id FROM locations GROUP BY id HAVING COUNT(*) > 1)"""


@query("rule_range", _LOCATION_SQL)
def rule_range(spark, folder):
    segment = F.col("c_mktsegment")
    locations = load(spark, folder, "customer").select(
        F.when(F.col("c_acctbal") > 9900, "TOP").otherwise(F.col("c_name")).alias("location_id"),
        F.when(F.col("c_acctbal") < -950, "  ").otherwise(F.col("c_name")).alias("location_name"),
        (F.col("c_acctbal") / 100).alias("latitude"),
        (F.col("c_nationkey") * 12.5 - 100).alias("longitude"),
        F.when(segment == "BUILDING", "America/Chicago").when(segment == "FURNITURE", "Mars/Base")
        .when(segment == "MACHINERY", "").otherwise("UTC").alias("timezone"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey") > 10).alias("active"),
    )
    return location_violations(locations)


# Keys and relationships


@query(
    "fk_orders_customer",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN
        (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""",
)
def fk_orders_customer(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    parents = load(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'")
    return unresolved(orders, "o_custkey", parents, "c_custkey")


@query(
    "fk_nullable",
    """SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_custkey NOT IN
        (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def fk_nullable(spark, folder):
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    orders = load(spark, folder, "orders").select("o_orderkey", key.alias("buyer"))
    parents = load(spark, folder, "customer").where("c_acctbal >= 0")
    return unresolved(orders, "buyer", parents, "c_custkey", nullable=True).select("o_orderkey")


@query(
    "lookup_mismatch",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_nationkey AS supplier_nation, c_nationkey AS customer_nation
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey WHERE s_nationkey <> c_nationkey""",
)
def lookup_mismatch(spark, folder):
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders, customers = load(spark, folder, "orders"), load(spark, folder, "customer")
    buyers = lookup(
        orders.select("o_orderkey", "o_custkey"), "o_custkey", customers, "c_custkey",
        {"nation": "c_nationkey"}, found="known",
    )
    rows = lookup(
        lines, "l_suppkey", load(spark, folder, "supplier"), "s_suppkey",
        {"supplier_nation": "s_nationkey"}, found="_s",
    )
    rows = lookup(rows, "l_orderkey", buyers, "o_orderkey", {"customer_nation": "nation"}, found="_o")
    differs = ~F.col("supplier_nation").eqNullSafe(F.col("customer_nation"))
    return rows.where(F.col("_s") & F.col("_o") & differs).drop("_s", "_o")


@query(
    "semi_referenced",
    "SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_custkey IN (SELECT o_custkey FROM orders)",
)
def semi_referenced(spark, folder):
    customers = load(spark, folder, "customer").where("c_acctbal < 0").select("c_custkey")
    return referenced(customers, "c_custkey", load(spark, folder, "orders"), "o_custkey")


@query(
    "anti_successor",
    """SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def anti_successor(spark, folder):
    urgent = load(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    return unreferenced(load(spark, folder, "customer").select("c_custkey"), "c_custkey", urgent, "o_custkey")


# Intervals


def _visits(spark, folder) -> DataFrame:
    start = _us(F.col("ts"))
    span = F.round(F.col("value") * 60).cast("long") * F.lit(1_000_000)
    return load(spark, folder, "events").select(
        "event_id", "user_id", "event_type", start.alias("s"), (start + span).alias("e")
    )


_VISITS = """visits AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS s,
    epoch_us(ts) + CAST(ROUND(value * 60) AS BIGINT) * 1000000 AS e FROM events)"""


@query(
    "interval_overlap",
    f"""WITH {_VISITS} SELECT DISTINCT a.event_id, a.user_id FROM visits a JOIN visits b
    ON a.user_id = b.user_id AND a.event_id <> b.event_id AND a.s < b.e AND b.s < a.e""",
)
def interval_overlap(spark, folder):
    return overlapping(_visits(spark, folder), ["user_id"], "s", "e", "event_id").select("event_id", "user_id")


@query(
    "interval_adjacent",
    """WITH spans AS (SELECT event_id, user_id, date_trunc('hour', ts) AS s, date_trunc('hour', ts) + INTERVAL 1 HOUR AS e FROM events)
    SELECT event_id, user_id FROM spans a WHERE EXISTS (SELECT 1 FROM spans b WHERE b.user_id = a.user_id AND b.s = a.e)
        OR EXISTS (SELECT 1 FROM spans b WHERE b.user_id = a.user_id AND b.e = a.s)""",
)
def interval_adjacent(spark, folder):
    start = _us(F.date_trunc("hour", F.col("ts")))
    spans = load(spark, folder, "events").select(
        "event_id", "user_id", start.alias("s"), (start + F.lit(3_600_000_000)).alias("e")
    )
    return adjacent(spans, ["user_id"], "s", "e").drop("s", "e")


@query(
    "conflict_pairs",
    f"""WITH {_VISITS} SELECT a.event_id AS first_row, b.event_id AS second_row,
        CASE WHEN a.s < b.e AND b.s < a.e THEN 'overlap' ELSE 'back_to_back' END AS kind
    FROM visits a JOIN visits b ON a.user_id = b.user_id AND a.event_id < b.event_id AND a.event_type <> b.event_type
        AND ((a.s < b.e AND b.s < a.e) OR a.e = b.s OR b.e = a.s)""",
)
def conflict_pairs_query(spark, folder):
    return conflict_pairs(_visits(spark, folder), ["user_id"], "s", "e", "event_type", "event_id", cell=3_600_000_000)


@query(
    "conflict_counts",
    f"""WITH {_VISITS} SELECT a.event_id, COUNT(b.event_id) AS overlaps FROM visits a LEFT JOIN visits b
    ON a.user_id = b.user_id AND a.event_type <> b.event_type AND a.s < b.e AND b.s < a.e GROUP BY a.event_id""",
)
def conflict_counts_query(spark, folder):
    return conflict_counts(_visits(spark, folder), ["user_id"], "s", "e", "event_type", "event_id")


def _periods(spark, folder) -> DataFrame:
    first = F.unix_date(F.col("o_orderdate").cast("date")).cast("long")
    length = F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 100000), -5).otherwise(30)
    return load(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", first.alias("s"), (first + length).alias("e")
    )


_PERIODS = """periods AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS s,
    CAST(o_orderdate AS DATE) + CASE WHEN o_orderstatus = 'P' AND o_totalprice < 100000 THEN -5 ELSE 30 END AS e FROM orders)
    SELECT DISTINCT a.o_orderkey FROM periods a JOIN periods b ON a.o_custkey = b.o_custkey
    AND a.o_orderpriority = b.o_orderpriority AND a.o_orderkey <> b.o_orderkey AND a.s <= b.e AND b.s <= a.e"""


def _period_flags(spark, folder) -> DataFrame:
    return period_conflicts(
        _periods(spark, folder), ["o_custkey", "o_orderpriority"], "s", "e", "o_orderstatus", "o_orderkey"
    )


@query("period_overlap", f"WITH {_PERIODS}")
def period_overlap(spark, folder):
    return _period_flags(spark, folder).where("overlaps").select("o_orderkey")


@query("period_conflict", f"WITH {_PERIODS} AND a.o_orderstatus <> b.o_orderstatus")
def period_conflict(spark, folder):
    return _period_flags(spark, folder).where("conflicts").select("o_orderkey")


# Lineage


def _order_lineage(spark, folder) -> DataFrame:
    """Each order points to the order numbered like its customer."""
    return load(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_custkey").cast("string")).alias("pred"),
        F.col("o_custkey").cast("string").alias("buyer"),
        F.col("o_orderstatus").alias("status"),
    )


@query(
    "lineage_cycle",
    """WITH RECURSIVE step AS (SELECT o_orderkey AS n, o_custkey AS p FROM orders),
    image AS (SELECT DISTINCT p AS n FROM step),
    walk(n, p) AS (SELECT step.n, step.p FROM step JOIN image USING (n)
        UNION SELECT walk.n, step.p FROM walk JOIN step ON step.n = walk.p)
    SELECT DISTINCT CAST(n AS VARCHAR) AS node FROM walk WHERE n = p""",
)
def lineage_cycle(spark, folder):
    return cycle_members(_order_lineage(spark, folder), "id", "buyer")


@query(
    "lineage_closed",
    """WITH e AS (SELECT o_orderkey AS i, CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS p, o_orderstatus AS st FROM orders),
    touched AS (SELECT a.i AS pred, b.i AS r FROM e a JOIN e b ON b.p = a.i WHERE a.st = 'F'
        UNION SELECT a.i, a.i FROM e a JOIN e b ON b.p = a.i WHERE a.st = 'F')
    SELECT r AS o_orderkey, COUNT(*) AS occurrences FROM touched GROUP BY r""",
)
def lineage_closed(spark, folder):
    rows = _order_lineage(spark, folder).select("o_orderkey", "id", "pred", "status")
    return closed_predecessors(rows, "id", "pred", "status", "F").select("o_orderkey", "occurrences")


def _turns(spark, folder) -> DataFrame:
    """Conversation turns as a lineage: every turn but the first follows the one before."""

    def turn_id(turn: Column) -> Column:
        return F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))

    return load(spark, folder, "conversations").select(
        turn_id(F.col("turn")).alias("row"),
        turn_id(F.col("turn")).alias("id"),
        F.when(F.col("turn") > 0, turn_id(F.col("turn") - 1)).alias("pred"),
        F.lit("Rescheduled").alias("status"),
        F.col("role").alias("role"),
    )


@query(
    "lineage_chains",
    """SELECT conv_id || '-0' AS root, turn AS depth, conv_id || '-' || turn AS node FROM conversations""",
)
def lineage_chains(spark, folder):
    return chains(_turns(spark, folder), "id", "pred", "status", "Rescheduled", "row").select("root", "depth", "node")


def _looping_orders(spark, folder) -> DataFrame:
    """A customer's orders as a lineage, some of which close into a loop.

    An order follows the one before it.  By customer number, one third of the
    lineages end; one third also list their first order again, after their last,
    so all is one loop; one third do so with their second order, so the first
    hangs on a loop.
    """
    orders = load(spark, folder, "orders").select("o_custkey", F.col("o_orderkey").alias("row"))
    own = Window.partitionBy("o_custkey").orderBy("row")
    placed = orders.withColumns(
        {"place": F.row_number().over(own), "before": F.lag("row").over(own), "last": F.max("row").over(Window.partitionBy("o_custkey"))}
    )
    first = placed.select("row", F.col("row").alias("id"), F.col("before").alias("pred"))
    again = placed.where("place = o_custkey % 3").select(F.lit(-1).alias("row"), F.col("row").alias("id"), F.col("last").alias("pred"))
    every = first.unionByName(again)
    return every.select("row", F.col("id").cast("string").alias("id"), F.col("pred").cast("string").alias("pred"), F.lit("Rescheduled").alias("status"))


_LOOPING = """t AS (SELECT o_custkey AS c, o_orderkey AS id, COUNT(*) OVER (PARTITION BY o_custkey) AS n,
        ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place,
        MIN(o_orderkey) OVER (PARTITION BY o_custkey) AS root FROM orders),
    m AS (SELECT CAST(root AS VARCHAR) AS root, place - 1 AS depth, CAST(id AS VARCHAR) AS node,
        c % 3 = 2 AND place >= 2 AS in_loop FROM t WHERE c % 3 <> 1)"""


@query("lineage_loops", f"WITH {_LOOPING} SELECT * FROM m")
def lineage_loops(spark, folder):
    return chains(_looping_orders(spark, folder), "id", "pred", "status", "Rescheduled", "row")


@query(
    "lineage_looping_roots",
    f"WITH {_LOOPING} SELECT root, COUNT(*) AS loop_length, MIN(depth) AS entry_depth FROM m WHERE in_loop GROUP BY root",
)
def lineage_looping_roots(spark, folder):
    return looping_roots(chains(_looping_orders(spark, folder), "id", "pred", "status", "Rescheduled", "row"))


@query(
    "lineage_chain_summary",
    """SELECT conv_id || '-0' AS root, COUNT(*) - 1 AS links, COUNT(*) AS members,
        COUNT(DISTINCT role) AS distinct_moments FROM conversations GROUP BY conv_id""",
)
def lineage_chain_summary(spark, folder):
    rows = _turns(spark, folder)
    return chain_summary(chains(rows, "id", "pred", "status", "Rescheduled", "row"), rows, "id", "role")


# Nested and semi-structured values


@query(
    "array_alignment",
    """SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS positive, CAST(len(embedding) AS INTEGER) AS declared
    FROM embeddings WHERE len(list_filter(embedding, lambda x: x > 0)) <> len(embedding)""",
)
def array_alignment(spark, folder):
    positive = F.size(F.filter("embedding", lambda x: x > 0))
    sizes = misaligned({"positive": positive, "all": F.size("embedding")}, F.size("embedding"))
    rows = load(spark, folder, "embeddings").select("vec_id", sizes.alias("wrong"), F.size("embedding").alias("declared"))
    return rows.where(F.size("wrong") > 0).select("vec_id", F.col("wrong")["positive"].alias("positive"), "declared")


_PROPS = """props2 AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""


def _props(spark, folder) -> DataFrame:
    """Event properties, spelled in another JSON type for each event type."""
    kind_ = F.col("event_type")
    text = (
        F.when(kind_ == "view", '{"k": true, "tag": null}')
        .when(kind_ == "error", F.replace(F.replace(F.col("props"), F.lit(": "), F.lit(': "')), F.lit("}"), F.lit('.5"}')))
        .when(kind_ == "signup", F.replace(F.col("props"), F.lit("}"), F.lit('.7, "tag": "x"}')))
        .when(kind_ == "purchase", F.replace(F.replace(F.col("props"), F.lit(": "), F.lit(': " ')), F.lit("}"), F.lit('000000000"}')))
        .otherwise(F.col("props"))
    )
    return load(spark, folder, "events").select("event_id", "event_type", F.parse_json(text).alias("v"))


@query(
    "json_required",
    """SELECT event_id, 'tag' AS missing FROM events WHERE event_type <> 'signup'""",
)
def json_required(spark, folder):
    lacking = missing_fields(F.col("v"), ["tag", "k"])
    return _props(spark, folder).where(F.size(lacking) > 0).select("event_id", F.array_join(lacking, ",").alias("missing"))


@query("json_extract", f"WITH {_PROPS} SELECT event_id, k, 'BIGINT' AS kind FROM props2")
def json_extract(spark, folder):
    rows = load(spark, folder, "events").select("event_id", F.parse_json("props").alias("v"))
    return rows.select("event_id", at(F.col("v"), "k", "bigint").alias("k"), kind(at(F.col("v"), "k")).alias("kind"))


@query(
    "cast_audit",
    f"""WITH {_PROPS} SELECT event_id,
        CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN NULL WHEN 'purchase' THEN k * 1000000000 ELSE k END AS whole,
        CASE event_type WHEN 'view' THEN NULL WHEN 'purchase' THEN CAST(k * 1000000000 AS DOUBLE) WHEN 'error' THEN k + 0.5 WHEN 'signup' THEN CAST(CONCAT(k, '.7') AS DOUBLE) ELSE k END AS number,
        event_type IN ('view', 'error') AS whole_failed, event_type = 'view' AS number_failed FROM props2""",
)
def cast_audit(spark, folder):
    rows = _props(spark, folder).select("event_id", at(F.col("v"), "k").alias("k"))
    rows = rows.select("event_id", "k", strict_int(F.col("k")).alias("whole"), strict_float(F.col("k")).alias("number"))
    return rows.select(
        "event_id",
        "whole",
        "number",
        (~absent(F.col("k")) & F.col("whole").isNull()).alias("whole_failed"),
        (~absent(F.col("k")) & F.col("number").isNull()).alias("number_failed"),
    )


def _forecasts(spark, folder, label: Column | None = None) -> DataFrame:
    """One forecast record per embedding: its components are the hourly values.

    Codes lie above the range of 32 bits.  The label says which fault a record has.
    """
    tenths = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000) / 10)
    codes = F.transform("embedding", lambda x: F.floor(x.cast("double") * 100) + 3_000_000_000)
    n = F.size("embedding")
    hours = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.replace(
            F.substring(F.timestamp_add("HOUR", i, F.lit("2026-07-01").cast("timestamp_ntz")).cast("string"), 1, 16), F.lit(" "), F.lit("T")
        ),
    )
    label = F.col("label") if label is None else label
    hourly = F.struct(
        hours.alias("time"),
        tenths.alias("temperature_2m"),
        F.when(label != 3, tenths).alias("apparent_temperature"),
        F.when(label == 4, F.slice(codes, 1, 5)).otherwise(codes).alias("relative_humidity_2m"),
        tenths.alias("precipitation"),
        codes.alias("weather_code"),
        F.transform("embedding", lambda x: x.cast("double")).alias("wind_gusts_10m"),
    )
    units = F.struct(*[F.lit(name).alias(name) for name in HOURLY_FIELDS])
    payload = F.struct(
        F.lit(32.5).alias("latitude"), F.lit(-96.75).alias("longitude"), F.lit("America/Chicago").alias("timezone"),
        F.lit(-18000).alias("utc_offset_seconds"), units.alias("hourly_units"), hourly.alias("hourly"),
    )
    record = F.struct(
        F.lit("forecast").alias("source_system"), F.lit("hourly").alias("endpoint_name"),
        F.concat(F.lit("L"), label).alias("location_id"), F.lit("Place").alias("location_name"),
        F.col("vec_id").cast("string").alias("pipeline_run_id"),
        F.when(label == 5, "soon").otherwise(" 2026-07-14T12:00:00Z ").alias("ingestion_timestamp_utc"),
        F.lit(1).alias("attempt_count"), F.lit(200).alias("http_status_code"),
        F.when(label == 6, n + 1).otherwise(n).alias("hourly_record_count"),
        F.struct(F.lit(3).alias("forecast_days")).alias("request_parameters"), payload.alias("payload"),
    )
    rows = spread(load(spark, folder, "embeddings"))
    return rows.select(F.parse_json(F.to_json(record)).alias("record"), F.col("vec_id").cast("string").alias("_source_file"))


@query(
    "explode_embedding",
    """SELECT vec_id, CAST(i - 1 AS INTEGER) AS position, CAST(embedding[i] AS DOUBLE) AS component
    FROM embeddings, UNNEST(range(1, len(embedding) + 1)) AS u(i)""",
)
def explode_embedding(spark, folder):
    """Every embedding as the hours of a sound forecast."""
    rows = flatten(_forecasts(spark, folder, F.lit(0))).rows
    return rows.select(
        F.col("pipeline_run_id").cast("long").alias("vec_id"), F.col("forecast_hour_index").alias("position"),
        F.col("wind_gusts_10m").alias("component"),
    )


@query(
    "weather_hours",
    """SELECT CAST(vec_id AS VARCHAR) AS pipeline_run_id, CONCAT('L', label) AS location_id, CAST(i - 1 AS INTEGER) AS forecast_hour_index,
        CAST(TIMESTAMP '2026-07-01 00:00:00' + INTERVAL 1 HOUR * (i - 1) AS VARCHAR) AS forecast_at,
        CAST(TIMESTAMP '2026-07-14 12:00:00' AS VARCHAR) AS ingested_at,
        FLOOR(CAST(embedding[i] AS DOUBLE) * 1000) / 10 AS temperature_2m,
        CAST(FLOOR(CAST(embedding[i] AS DOUBLE) * 100) AS BIGINT) + 3000000000 AS weather_code, 'weather_code' AS weather_code_unit
    FROM embeddings, UNNEST(range(1, len(embedding) + 1)) AS u(i) WHERE label NOT IN (3, 4, 5, 6)""",
)
def weather_hours(spark, folder):
    rows = flatten(_forecasts(spark, folder), "quarantine").rows
    return rows.select(
        "pipeline_run_id", "location_id", "forecast_hour_index",
        F.date_format("forecast_timestamp_local", "yyyy-MM-dd HH:mm:ss").alias("forecast_at"),
        F.date_format("ingestion_timestamp_utc", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"),
        "temperature_2m", "weather_code", "weather_code_unit",
    )


@query(
    "weather_rejected",
    """SELECT CAST(vec_id AS VARCHAR) AS record, CASE label
        WHEN 3 THEN 'Bronze hourly payload is missing required fields: [''apparent_temperature'']'
        WHEN 4 THEN CONCAT('Bronze hourly arrays are misaligned. Expected ', len(embedding), ' elements based on ''time''; received {''relative_humidity_2m'': 5}.')
        WHEN 5 THEN '''ingestion_timestamp_utc'' contains an invalid ISO-8601 timestamp.'
        ELSE CONCAT('''hourly_record_count'' does not match the actual hourly array length. Declared=', len(embedding) + 1, ', actual=', len(embedding), '.') END AS reason
    FROM embeddings WHERE label IN (3, 4, 5, 6)""",
)
def weather_rejected(spark, folder):
    rejected = flatten(_forecasts(spark, folder), "quarantine").rejected
    return rejected.select(F.col("_source_file").alias("record"), "reason")


@query(
    "weather_response",
    """SELECT CAST(vec_id AS VARCHAR) AS record, CASE label
        WHEN 3 THEN 'API response is missing requested hourly variables: [''apparent_temperature'']'
        WHEN 4 THEN 'Hourly variables do not align with the timestamp count: [''relative_humidity_2m'']' END AS violation FROM embeddings""",
)
def weather_response(spark, folder):
    payloads = _forecasts(spark, folder).select(
        F.col("_source_file").alias("record"), at(F.col("record"), "payload").alias("payload")
    )
    return response_contract(payloads, "payload", HOURLY_FIELDS[1:]).select("record", "violation")


# Upsert and comparison


def _upsert_sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    events = load(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    target = events.where("event_type <> 'signup'")
    source = events.where("event_type IN ('signup', 'purchase')").withColumn("value", F.col("value") * 2)
    return target, source


@query(
    "upsert_events",
    """SELECT event_id, user_id, event_type, CASE WHEN event_type IN ('signup', 'purchase') THEN value * 2 ELSE value END AS value
    FROM events""",
)
def upsert_events(spark, folder):
    """Events as a table by buckets of their key, then the new state of some upserted into it."""
    target, source = _upsert_sides(spark, folder)
    table, keys = f"upsert_events_{uuid.uuid4().hex}", ["event_id", "user_id"]
    place = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{table}"
    upsert(target, table, keys, buckets=16, location=place, settled=True)
    upsert(source, table, keys, settled=True)
    return upserted(spark, table)


@query(
    "set_diff",
    """WITH t AS (SELECT user_id, event_type, value FROM events WHERE event_type <> 'signup'),
    s AS (SELECT user_id, event_type, CASE WHEN event_type = 'purchase' THEN value * 2 ELSE value END AS value FROM events),
    e AS (SELECT user_id, event_type, value, COUNT(*) AS n FROM t GROUP BY ALL),
    a AS (SELECT user_id, event_type, value, COUNT(*) AS n FROM s GROUP BY ALL)
    SELECT user_id, event_type, value, COALESCE(e.n, 0) AS expected_count, COALESCE(a.n, 0) AS actual_count
    FROM e FULL JOIN a USING (user_id, event_type, value) WHERE COALESCE(e.n, 0) <> COALESCE(a.n, 0)""",
)
def set_diff(spark, folder):
    events = load(spark, folder, "events").select("user_id", "event_type", "value")
    doubled = F.when(F.col("event_type") == "purchase", F.col("value") * 2).otherwise(F.col("value"))
    return multiset_difference(events.where("event_type <> 'signup'"), events.withColumn("value", doubled))


# Monitoring


def _run_records(spark, folder) -> DataFrame:
    """Events as ingestion records: a run per day, an entity per event type."""
    return load(spark, folder, "events").select(
        F.col("ts").cast("date").cast("string").alias("run_id"),
        F.lit("2024-01-01").cast("date").alias("ingestion_date"),
        F.col("event_type").alias("entity_name"),
        F.when(F.col("value") >= 40, "SUCCEEDED").otherwise("FAILED").alias("status"),
        F.col("user_id").alias("row_count"),
        F.col("ts").alias("completed_at"),
    )


_RECORDS = """records AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, event_type AS entity_name,
    CASE WHEN value >= 40 THEN 'SUCCEEDED' ELSE 'FAILED' END AS status, user_id AS row_count, ts AS completed_at FROM events)"""


@query(
    "latest_complete",
    f"""WITH {_RECORDS} SELECT run_id, epoch_us(MAX(completed_at)) AS completed_us FROM records WHERE status = 'SUCCEEDED'
    GROUP BY run_id HAVING COUNT(DISTINCT entity_name) = 5 ORDER BY MAX(completed_at) DESC, run_id DESC LIMIT 1""",
)
def latest_complete(spark, folder):
    best = complete_runs(_run_records(spark, folder), "2024-01-01", 5)
    return best.select("run_id", _us(F.col("completed_at")).alias("completed_us"))


@query(
    "run_status",
    f"""WITH {_RECORDS}, s AS (SELECT run_id, COUNT(*) FILTER (status = 'SUCCEEDED') AS succeeded_count,
        COUNT(*) FILTER (status = 'FAILED') AS failed_count FROM records GROUP BY run_id)
    SELECT *, CASE WHEN failed_count = 0 THEN 'SUCCEEDED' WHEN succeeded_count > 0 THEN 'PARTIAL_SUCCESS' ELSE 'FAILED' END AS status FROM s""",
)
def run_status_query(spark, folder):
    return run_status(_run_records(spark, folder)).drop("ingestion_date")


@query(
    "status_rollup",
    f"WITH {_RECORDS} SELECT status, COUNT(*) AS entity_count, CAST(SUM(row_count) AS BIGINT) AS row_count FROM records GROUP BY status",
)
def status_rollup_query(spark, folder):
    return status_rollup(_run_records(spark, folder))


# Engine outputs on a retail pack


def _retail(spark, folder):
    return validate(retail_tables(spark, folder), RETAIL, "retail", keep=False)


@query(
    "findings_enriched",
    f"WITH {TABLES_SQL} SELECT entity, record_id, rule_id, severity, outcome, message FROM findings",
)
def findings_enriched(spark, folder):
    rows = expanded(_retail(spark, folder).findings)
    return rows.select("entity", "record_id", "rule_id", "severity", "outcome", "message")


@query(
    "accept_quarantine",
    f"""WITH {TABLES_SQL} SELECT o_orderkey, o_orderkey NOT IN (SELECT r FROM findings WHERE entity = 'orders' AND severity = 'Critical') AS accepted
    FROM orders""",
)
def accept_quarantine(spark, folder):
    result = _retail(spark, folder)
    kept = result.accepted("orders").select("o_orderkey", F.lit(True).alias("accepted"))
    held = result.quarantine("orders").select(
        F.col("record_id").cast("long").alias("o_orderkey"), F.lit(False).alias("accepted")
    )
    return kept.unionByName(held)


@query(
    "quarantine_ids",
    f"""WITH {TABLES_SQL} SELECT entity, record_id,
        CONCAT('["', STRING_AGG(rule_id, '","' ORDER BY rule_id) FILTER (severity = 'Critical'), '"]') AS critical_rule_ids,
        CONCAT('["', STRING_AGG(rule_id, '","' ORDER BY rule_id), '"]') AS all_rule_ids, COUNT(*) AS finding_count
    FROM findings GROUP BY entity, r, record_id HAVING COUNT(*) FILTER (severity = 'Critical') > 0""",
)
def quarantine_ids(spark, folder):
    return _retail(spark, folder).quarantine().select("entity", "record_id", "critical_rule_ids", "all_rule_ids", "finding_count")


_SUMMARY = f"""WITH {TABLES_SQL}, sizes AS (SELECT 'customer' AS entity, COUNT(*) AS rows_read FROM customer
        UNION ALL SELECT 'orders', COUNT(*) FROM orders),
    counts AS (SELECT entity, COUNT(DISTINCT r) FILTER (severity = 'Critical') AS rows_quarantined,
        COUNT(*) FILTER (severity = 'Critical') AS critical_result_count, COUNT(*) FILTER (severity = 'Warning') AS warning_result_count,
        COUNT(*) FILTER (severity = 'Info') AS info_result_count FROM findings GROUP BY entity)"""
_STATUS = """CASE WHEN rows_quarantined > 0 AND rows_accepted = 0 THEN 'FAILED' WHEN rows_quarantined > 0 THEN 'PARTIAL_SUCCESS'
    ELSE 'SUCCEEDED' END AS status"""


@query(
    "dq_summary",
    f"""{_SUMMARY} SELECT *, {_STATUS} FROM (SELECT entity, rows_read, rows_read - rows_quarantined AS rows_accepted, rows_quarantined,
        critical_result_count, warning_result_count, info_result_count FROM sizes JOIN counts USING (entity))""",
)
def dq_summary(spark, folder):
    return _retail(spark, folder).summary().drop("duration_seconds")


@query(
    "dq_run_summary",
    f"""{_SUMMARY} SELECT *, {_STATUS} FROM (SELECT CAST(SUM(rows_read) AS BIGINT) AS rows_read,
        CAST(SUM(rows_read - rows_quarantined) AS BIGINT) AS rows_accepted, CAST(SUM(rows_quarantined) AS BIGINT) AS rows_quarantined,
        CAST(SUM(critical_result_count) AS BIGINT) AS critical_result_count, CAST(SUM(warning_result_count) AS BIGINT) AS warning_result_count,
        CAST(SUM(info_result_count) AS BIGINT) AS info_result_count FROM sizes JOIN counts USING (entity))""",
)
def dq_run_summary(spark, folder):
    return _retail(spark, folder).run_summary().drop("duration_seconds")


@query(
    "findings_ranked",
    f"""WITH {TABLES_SQL} SELECT entity, record_id, rule_id, severity, outcome,
        ROW_NUMBER() OVER (ORDER BY entity, r, rule_id, message) AS place FROM findings""",
)
def findings_ranked(spark, folder):
    """Findings with their place in the stable reading order."""
    result = _retail(spark, folder)
    rows = ranked(result.findings, result.entities)
    return rows.select("entity", "record_id", "rule_id", "severity", "outcome", "place")


@query(
    "finding_evidence",
    f"""WITH {TABLES_SQL} SELECT entity, record_id, rule_id, severity, outcome, CAST(1 AS BIGINT) AS occurrences FROM findings""",
)
def finding_evidence_query(spark, folder):
    rows = finding_evidence(_retail(spark, folder).findings, "retail")
    return rows.select("entity", "record_id", "rule_id", "severity", "outcome", "occurrences")


@query(
    "severity_rollup",
    f"WITH {TABLES_SQL} SELECT severity, COUNT(*) AS finding_count FROM findings GROUP BY severity",
)
def severity_rollup_query(spark, folder):
    return severity_rollup(_retail(spark, folder).findings, "retail")


def _one_line(field: T.StructField) -> Column:
    """A column as text, with blanks for line breaks and quotes; only types that can hold them are searched."""
    kind = field.dataType.elementType if isinstance(field.dataType, T.ArrayType) else field.dataType
    text = F.col(f"`{field.name}`").cast("string")
    if isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return text
    return F.regexp_replace(text, r"[\r\n\"]", " ")


@query(
    "row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES),
)
def row_counts(spark, folder):
    """Counts that landing reports for CSV copies of the tables."""
    place = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landing-{uuid.uuid4().hex}"

    def copy(name: str) -> Entity:
        table = load(spark, folder, name)
        # Text only: a list is spelled out, and no value breaks a line.
        table.select(*[_one_line(field).alias(field.name) for field in table.schema]).write.option("header", True).option("emptyValue", "").csv(f"{place}/{name}.csv")
        return Entity(name, tuple(table.columns), tuple(table.columns), table.columns[0])

    entities = [entity for entity, _ in entity_jobs(spark, TABLES, copy).values()]
    sources = {name: f"{place}/{name}.csv" for name in TABLES}
    landed = land_all(spark, Pack([], entities), sources, "2026-08-03", "counts", root=f"{place}/landed")
    return spark.createDataFrame([(r.entity_name, r.row_count) for r in landed], "table_name string, row_count long")


# Coverage analytics


@query(
    "load_stddev",
    """SELECT COUNT(*) AS groups, MIN(n) AS least, MAX(n) AS most, ROUND(STDDEV_POP(n), 6) AS deviation
    FROM (SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id)""",
)
def load_stddev(spark, folder):
    return load_dispersion(load(spark, folder, "events"), "user_id").withColumn("deviation", F.round("deviation", 6))


@query(
    "exposure_join",
    f"""WITH {_VISITS} SELECT a.event_id, COUNT(*) AS windows FROM visits a JOIN visits w ON w.event_type = 'error'
    AND a.event_type = 'purchase' AND a.s < w.e AND w.s < a.e GROUP BY a.event_id""",
)
def exposure_join(spark, folder):
    visits = _visits(spark, folder)
    subjects, windows = visits.where("event_type = 'purchase'"), visits.where("event_type = 'error'")
    return exposed(subjects, windows, ("s", "e"), ("s", "e"), "event_id").select("event_id", "windows")


@query(
    "lag_change",
    """WITH ranked AS (SELECT user_id, CAST(FLOOR(value / 25) AS BIGINT) AS site, event_id,
        ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
    pairs AS (SELECT user_id, MAX(site) FILTER (n = 1) AS first_site, MAX(site) FILTER (n = 2) AS second_site, MIN(event_id) AS e
        FROM ranked WHERE n <= 2 GROUP BY user_id HAVING COUNT(*) = 2)
    SELECT user_id, first_site, second_site, first_site <> second_site AS moved,
        COALESCE(second_site = LAG(second_site) OVER (ORDER BY e) + 1, FALSE) AS sequential FROM pairs""",
)
def lag_change(spark, folder):
    site = F.floor(F.col("value") / 25)
    rows = load(spark, folder, "events").select("user_id", "event_id", site.alias("site"))
    return reassignments(rows, "user_id", "site", "event_id")


# The operations pack over tables derived from the star schema


def _operations_query(entity: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = entity_findings(operations_tables(spark, folder), OPERATIONS, entity)
        return rows.select(
            F.col("_row_index").alias("row_index"), F.col("_record_id").alias("record_id"),
            "rule_id", "message", "occurrences",
        )

    return run


_ORACLES_OF = operations_oracles()


@query(
    "operations_master",
    " UNION ALL ".join(f"SELECT '{name}' AS entity, * FROM ({_ORACLES_OF[name]})" for name in MASTER),
)
def operations_master(spark, folder):
    """The master entities by themselves, as one run of their scope."""
    tables = operations_tables(spark, folder)
    rows = validate({name: tables[name] for name in MASTER}, OPERATIONS, "master", scope="master").findings
    return rows.select(
        "entity", F.col("_row_index").alias("row_index"), "record_id", "rule_id", "message", "occurrences",
    )


for _entity, _sql in _ORACLES_OF.items():
    query(f"operations_{_entity}", _sql)(_operations_query(_entity))


@query("dataset_gate", gate_oracle())
def dataset_gate(spark, folder):
    return accepted_dataset(operations_tables(spark, folder))
