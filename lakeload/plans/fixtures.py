"""Deterministic inputs derived from the test tables (and their SQL twins).

Every input is a Spark derivation of whole tables, so the work grows with them:

* orders CDC pair: the table before the change is every order placed before
  1999; the change batch is every order placed from 1997 on, with the price
  negated and ``IsDeleted`` = (status is F), null for medium priority.  The two
  overlap for 1997-1998 (updates / deletes), 1999+ are new (inserts / drops).
* events composite pair: same idea over ``(user_id, ts)`` with a 20-day table
  and a batch from day 10 on; ``IsDeleted`` = error event, null for views.
* execution directories: orders grouped by order year, one folder per year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.specs import CDC, FULL, TableSpec

# Fixed values of the derived inputs.
ORDERS_TABLE_BEFORE = "1999-01-01"
ORDERS_BATCH_FROM = "1997-01-01"
EVENTS_TABLE_BEFORE = "2024-01-20"
EVENTS_BATCH_FROM = "2024-01-10"

ORDERS_SPEC = TableSpec(
    name="orders",
    fields={
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    keys=("o_orderkey",),
    load_type=CDC,
)
CUSTOMER_SPEC = TableSpec(
    name="customer",
    fields={"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"},
    keys=("c_custkey",),
    load_type=FULL,
)
PART_SPEC = TableSpec(
    name="part",
    fields={"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double"},
    keys=("p_partkey",),
    load_type=CDC,
)
SUPPLIER_SPEC = TableSpec(
    name="supplier",
    fields={"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    keys=("s_suppkey",),
    load_type=CDC,
)
LINEITEM_SPEC = TableSpec(
    name="lineitem",
    fields={
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
        "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
        "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
    },
    keys=("l_orderkey", "l_linenumber"),
    load_type=CDC,
)
EVENTS_SPEC = TableSpec(
    name="events",
    fields={"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"},
    keys=("user_id", "ts"),
    load_type=CDC,
)
SPECS = {s.name: s for s in (ORDERS_SPEC, CUSTOMER_SPEC, PART_SPEC, SUPPLIER_SPEC, LINEITEM_SPEC, EVENTS_SPEC)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit(ORDERS_TABLE_BEFORE).cast("timestamp_ntz"))


def orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit(ORDERS_BATCH_FROM).cast("timestamp_ntz"))
    flag = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(None).cast("boolean")).otherwise(F.col("o_orderstatus") == "F")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", (-F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority", flag.alias("IsDeleted"),
    )


def orders_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a CDC row (flag as in ``orders_batch``)."""
    flag = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(None).cast("boolean")).otherwise(F.col("o_orderstatus") == "F")
    return table(spark, sf_dir, "orders").select(*ORDERS_SPEC.fields, flag.alias("IsDeleted"))


def hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, nine of ten under one user (-1): a target with a hot key."""
    hot = F.when(F.col("event_id") % 10 < 9, F.lit(-1).cast("bigint")).otherwise(F.col("user_id"))
    return table(spark, sf_dir, "events").select("event_id", "ts", hot.alias("user_id"), "event_type", "value")


def events_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(F.col("ts") < F.lit(EVENTS_TABLE_BEFORE).cast("timestamp_ntz"))


def events_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("ts") >= F.lit(EVENTS_BATCH_FROM).cast("timestamp_ntz"))
    flag = F.when(F.col("event_type") == "view", F.lit(None).cast("boolean")).otherwise(F.col("event_type") == "error")
    return e.select("event_id", "ts", "user_id", "event_type", (-F.col("value")).alias("value"), "props", flag.alias("IsDeleted"))


# SQL twins (DuckDB) of the derived inputs, as common table expressions.
SQL_ORDERS_BEFORE = f"""orders_before AS (
  SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{ORDERS_TABLE_BEFORE}')"""
SQL_ORDERS_BATCH = f"""orders_batch AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, -o_totalprice AS o_totalprice, o_orderdate, o_orderpriority,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_orderstatus = 'F' END AS IsDeleted
  FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_BATCH_FROM}')"""
SQL_ORDERS_CHANGES = """orders_changes AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_orderstatus = 'F' END AS IsDeleted FROM orders)"""
SQL_HOT_EVENTS = """hot_events AS (
  SELECT event_id, ts, CASE WHEN event_id % 10 < 9 THEN -1 ELSE user_id END AS user_id, event_type, value FROM events)"""
SQL_EVENTS_BEFORE = f"""events_before AS (
  SELECT * FROM events WHERE ts < TIMESTAMP '{EVENTS_TABLE_BEFORE}')"""
SQL_EVENTS_BATCH = f"""events_batch AS (
  SELECT event_id, ts, user_id, event_type, -value AS value, props,
         CASE WHEN event_type = 'view' THEN NULL ELSE event_type = 'error' END AS IsDeleted
  FROM events WHERE ts >= TIMESTAMP '{EVENTS_BATCH_FROM}')"""
