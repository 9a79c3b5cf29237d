"""A small rule pack over the star schema: the engine is not tied to one pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchstone.functions import missing, one_of
from touchstone.plans.rules import Check, Entity, Link, Pack, Rule
from workload.views import load

RULES = (
    Rule("CUS-001", "customer", "Critical", "Quarantine and log.", "ERR_CUSTOMER_SEGMENT_REQUIRED"),
    Rule("CUS-002", "customer", "Warning", "Retain and log.", "WARN_CUSTOMER_BALANCE_NEGATIVE"),
    Rule("ORD-001", "orders", "Critical", "Quarantine and log.", "ERR_ORDER_CUSTOMER_INVALID"),
    Rule("ORD-002", "orders", "Critical", "Quarantine and log.", "ERR_ORDER_STATUS_INVALID"),
    Rule("ORD-003", "orders", "Info", "Retain and log.", "INFO_ORDER_URGENT"),
    Rule("ORD-004", "orders", "Warning", "Retain and log.", "WARN_ORDER_CUSTOMER_OVERDRAWN"),
)


def _customer_checks() -> list[Check]:
    return [
        Check(("CUS-001",), "customer.c_mktsegment is null or empty", missing(F.col("c_mktsegment"))),
        Check(("CUS-002",), "customer.c_acctbal is negative", F.col("c_acctbal") < 0),
    ]


def _order_checks() -> list[Check]:
    overdrawn = F.col("_found_o_custkey") & (F.col("_balance") < -900)
    return [
        Check(("ORD-002",), "orders.o_orderstatus is outside the domain", ~one_of(F.col("o_orderstatus"), ("O", "F"))),
        Check(("ORD-003",), "orders.o_orderpriority is urgent", F.col("o_orderpriority") == "1-URGENT"),
        Check(("ORD-004",), "customer of the order is overdrawn", overdrawn),
    ]


RETAIL = Pack(
    RULES,
    (
        Entity(
            "customer",
            ("c_custkey", "c_mktsegment", "c_acctbal"),
            ("c_custkey", "c_mktsegment"),
            "c_custkey",
            _customer_checks,
        ),
        Entity(
            "orders",
            ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
            ("o_orderkey", "o_custkey"),
            "o_orderkey",
            _order_checks,
        ),
    ),
    (
        Link(
            "orders", "o_custkey", "customer", "c_custkey",
            rule_ids=("ORD-001",), attributes={"_balance": "c_acctbal"},
        ),
    ),
)


def retail_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Customers without a segment are not parents: their orders do not resolve."""
    customer = load(spark, folder, "customer")
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    customer = customer.select(
        F.col("c_custkey").alias("_row_index"),
        F.when(F.col("c_acctbal") < 9500, F.col("c_custkey")).alias("c_custkey"),
        segment.alias("c_mktsegment"),
        "c_acctbal",
    )
    orders = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("_row_index"), "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    return {"customer": customer, "orders": orders}


TABLES_SQL = """
customers AS (SELECT c_custkey AS r, CASE WHEN c_acctbal < 9500 THEN c_custkey END AS k,
    NULLIF(c_mktsegment, 'BUILDING') AS segment, c_acctbal AS balance FROM customer),
findings AS (
    SELECT 'customer' AS entity, r, COALESCE(CAST(k AS VARCHAR), CONCAT('row:', r)) AS record_id, 'CUS-001' AS rule_id,
        'Critical' AS severity, 'FAILED' AS outcome, 'customer.c_mktsegment is null or empty' AS message FROM customers WHERE segment IS NULL
    UNION ALL SELECT 'customer', r, COALESCE(CAST(k AS VARCHAR), CONCAT('row:', r)), 'CUS-002', 'Warning', 'FLAGGED',
        'customer.c_acctbal is negative' FROM customers WHERE balance < 0
    UNION ALL SELECT 'orders', o_orderkey, CAST(o_orderkey AS VARCHAR), 'ORD-001', 'Critical', 'FAILED',
        'orders.o_custkey does not resolve to customer.c_custkey' FROM orders WHERE o_custkey NOT IN (SELECT k FROM customers WHERE k IS NOT NULL)
    UNION ALL SELECT 'orders', o_orderkey, CAST(o_orderkey AS VARCHAR), 'ORD-002', 'Critical', 'FAILED',
        'orders.o_orderstatus is outside the domain' FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
    UNION ALL SELECT 'orders', o_orderkey, CAST(o_orderkey AS VARCHAR), 'ORD-003', 'Info', 'LOGGED',
        'orders.o_orderpriority is urgent' FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'orders', o_orderkey, CAST(o_orderkey AS VARCHAR), 'ORD-004', 'Warning', 'FLAGGED',
        'customer of the order is overdrawn' FROM orders JOIN customers ON k = o_custkey WHERE balance < -900
)"""
