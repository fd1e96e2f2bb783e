"""The tables of the workload, with defects derived from their own values.

The tables are clean, so each defect is a value turned into null, blank or text;
every row stays.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.model import Rule, RuleSet

AS_OF = datetime(2024, 2, 5)
RUN_ID = "run_20240205"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    priority = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit(" \t"))
        .otherwise(F.col("o_orderpriority"))
    )
    return table(spark, folder, "orders").withColumn("o_orderpriority", priority)


def customer(spark: SparkSession, folder: str) -> DataFrame:
    """Balances as text, one segment's unreadable, another's missing."""
    balance = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.col("c_acctbal").cast("string"), F.lit("d")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit(None))
        .otherwise(F.col("c_acctbal").cast("string"))
    )
    return table(spark, folder, "customer").withColumn("balance_text", balance)


def profiled(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables whose profile the suggestion queries start from."""
    kind = F.when(F.col("p_type") == "ECONOMY", F.lit("  ")).otherwise(F.col("p_type"))
    balance = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    return {
        "orders": orders(spark, folder),
        "customer": table(spark, folder, "customer").withColumn("c_acctbal", balance),
        "part": table(spark, folder, "part").withColumn("p_type", kind),
    }


def checked(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The datasets of the rule runs."""
    return {
        "orders": orders(spark, folder),
        "lineitem": table(spark, folder, "lineitem"),
        "events": table(spark, folder, "events"),
        "settled_orders": settled_orders(spark, folder),
    }


def settled_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose key is gone while they are pending."""
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    return table(spark, folder, "orders").withColumn("o_orderkey", key)


def _rule(rule_id: str, rule_type: str, severity: str, **expectation: object) -> Rule:
    return Rule(rule_id, rule_type, severity, expectation)


ORDERS_RULES = RuleSet(
    "orders",
    3,
    (
        _rule("G001", "schema", "critical", required_columns=["o_orderkey", "o_orderdate", "ts_load"]),
        _rule("C001", "completeness", "high", column="o_orderpriority", max_null_percent=30),
        _rule("C002", "completeness", "high", column="o_orderkey"),
        _rule("U001", "uniqueness", "critical", column="o_orderkey"),
        _rule("U002", "uniqueness", "medium", column="o_custkey", max_duplicates_allowed=10),
        _rule("R001", "range", "medium", column="o_totalprice", min=2000, max=450000.5),
        _rule("D001", "domain", "high", column="o_orderstatus", allowed_values=["F", "O"]),
        _rule("D002", "domain", "low", column="o_orderpriority", allowed_values=["2-HIGH", "3-MEDIUM"]),
        _rule("T001", "date_not_in_future", "medium", column="o_orderdate"),
        _rule("F001", "freshness", "high", ts_column="o_orderdate", max_age_days=10000),
        _rule("X001", "sortedness", "low", column="o_orderkey"),
        _rule("C003", "completeness", "medium", column="O_ORDERKEY"),
    ),
)

LINEITEM_RULES = RuleSet(
    "lineitem",
    1,
    (
        _rule("K001", "referential_integrity", "critical", child_column="l_orderkey",
              parent_dataset="settled_orders", parent_column="o_orderkey"),
        _rule("K002", "referential_integrity", "high", child_column="l_orderkey",
              parent_dataset="orders", parent_column="o_orderkey"),
        _rule("K003", "referential_integrity", "high", child_column="l_partkey",
              parent_dataset="parts", parent_column="p_partkey"),
        _rule("U001", "uniqueness", "high", column="l_orderkey"),
        _rule("R001", "range", "medium", column="l_quantity", min=1, max=45),
        _rule("D001", "domain", "medium", column="l_linenumber", allowed_values=[1, 2, 3, 4]),
        _rule("D002", "domain", "low", column="l_returnflag", allowed_values=["A", "N", "R"]),
    ),
)

EVENTS_RULES = RuleSet(
    "events",
    2,
    (
        _rule("F001", "freshness", "critical", ts_column="ts", max_age_days=7),
        _rule("F002", "freshness", "high", ts_column="ts", max_age_days=2),
        _rule("F003", "freshness", "high", ts_column="ts"),
        _rule("F004", "freshness", "low", max_age_days=2),
        _rule("R001", "range", "low", column="value", max=100),
        _rule("U001", "uniqueness", "critical", column="event_id"),
        _rule("D001", "domain", "medium", column="event_type", allowed_values=["click", "view"]),
    ),
)

RULESETS = (ORDERS_RULES, LINEITEM_RULES, EVENTS_RULES)
