"""Named queries over the test tables, each with its DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]``.  Queries
that write (loads, snapshots, streams) use a fresh folder below the session's
checkpoint directory and return the re-read result.
"""

from __future__ import annotations

import os
from dataclasses import replace
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions import NUMBER_PATTERN
from lakeload.operators import change_feed as cf
from lakeload.operators import dq as dqmod
from lakeload.operators import gold
from lakeload.operators.dq_states import DqStates
from lakeload.operators.merge import bootstrap_target, collapse_changes, duplicate_keys, heavy_keys, latest_per_key, merge
from lakeload.operators.merge import delete_step, insert_step, update_step
from lakeload.operators.project import LOAD_STAMP_COL, cast_projection, filter_load_date, load_stamp
from lakeload.operators.unique import unique_metrics
from lakeload.plans import fixtures as fx
from lakeload.plans import jobs
from lakeload.session import work_dir
from lakeload.sinks import Ledger, VersionedTable, archive_batch, replace_table, save_table
from lakeload.sinks.ledger import FileLedger
from lakeload.sinks.versioned import VERSION_COL
from lakeload.sources import EXECUTION_COL, RULES_SCHEMA, rules_from_local_csv, scan_executions, scan_explicit_schema, scan_parquet
from lakeload.specs import CDC, FULL, GoldSpec, TableSpec
from lakeload.streaming.cdc import current_rows, stream_cdc_apply, stream_cdc_ordered

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

# Fixed values of the registered queries.
AS_OF = "2024-01-31"
PROCESSED_AT = "2024-01-31 10:15:00"
RULES_PATH = os.path.join(os.path.dirname(os.path.dirname(__file__)), "resources", "dq_rules.csv")


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return fx.table(spark, sf, name)


ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

# ---------------------------------------------------------------------------
# Gold builders over the stand-in tables (part / lineitem / supplier / orders)
# ---------------------------------------------------------------------------


def candidate_by_campaign(tables, with_delete_flag: bool = False) -> DataFrame:
    return gold.candidate_by_campaign(
        tables["part"], tables["lineitem"], tables["supplier"],
        cand_id="p_partkey", cand_name="p_name", cand_company="p_brand",
        lead_id="l_partkey", campaign_id="l_suppkey", bridge_status="l_returnflag",
        camp_id="s_suppkey", camp_name="s_name", camp_start=None, camp_end=None,
        with_delete_flag=with_delete_flag,
    )


def status_by_campaign(tables, with_delete_flag: bool = False) -> DataFrame:
    return gold.status_count(tables["orders"], "o_orderstatus", with_delete_flag)


GOLD_CANDIDATE = GoldSpec("candidate_by_campaign", candidate_by_campaign, keys=("LeadId", "CampaignId"), inputs=("part", "lineitem", "supplier"))
GOLD_STATUS = GoldSpec("status_by_campaign", status_by_campaign, keys=("status",), inputs=("orders",))


def _tables(spark, sf, *names):
    return {n: t(spark, sf, n) for n in names}


SQL_CANDIDATE = """
SELECT p.p_partkey AS LeadId, s.s_suppkey AS CampaignId, p.p_name AS Candidate, p.p_brand AS Company,
       l.l_returnflag AS Status, s.s_name AS Campaign,
       CAST(NULL AS DATE) AS StartDateCampaign, CAST(NULL AS DATE) AS EndDateCampaign
FROM part p JOIN lineitem l ON p.p_partkey = l.l_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey"""

# ---------------------------------------------------------------------------
# Flagship: billing per customer
# ---------------------------------------------------------------------------

SQL_BILLING = """
SELECT c.c_name, c.c_mktsegment,
       CAST(sum(CAST(l.l_quantity AS DECIMAL(18,2)) * CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS billing,
       CAST(sum(CAST(l.l_discount AS DECIMAL(18,2))) AS DOUBLE) AS discount
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_name, c.c_mktsegment ORDER BY c.c_name, c.c_mktsegment"""


@query("billing_for_each_customer", SQL_BILLING)
def billing_for_each_customer(spark, sf):
    return gold.billing_per_customer(
        t(spark, sf, "orders"), t(spark, sf, "lineitem"), t(spark, sf, "customer"),
        order_id="o_orderkey", order_customer="o_custkey", item_order="l_orderkey",
        quantity="l_quantity", list_price="l_extendedprice", discount="l_discount",
        customer_id="c_custkey", group_cols=["c_name", "c_mktsegment"], order_cols=["c_name", "c_mktsegment"],
    )


@query(
    "billing_decimal_scales",
    """
SELECT c.c_name, c.c_mktsegment,
       CAST(sum(CAST(l.l_quantity / 8 AS DECIMAL(10,3)) * CAST(l.l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) AS billing,
       CAST(sum(CAST(l.l_discount / 4 AS DECIMAL(6,4))) AS DOUBLE) AS discount
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_name, c.c_mktsegment ORDER BY c.c_name, c.c_mktsegment""",
)
def billing_decimal_scales(spark, sf):
    """The billing view over decimal columns of three and four places, nothing rounded."""
    items = t(spark, sf, "lineitem").select(
        "l_orderkey",
        (F.col("l_quantity") / 8).cast("decimal(10,3)").alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("l_extendedprice"),
        (F.col("l_discount") / 4).cast("decimal(6,4)").alias("l_discount"),
    )
    return gold.billing_per_customer(
        t(spark, sf, "orders"), items, t(spark, sf, "customer"),
        order_id="o_orderkey", order_customer="o_custkey", item_order="l_orderkey",
        quantity="l_quantity", list_price="l_extendedprice", discount="l_discount",
        customer_id="c_custkey", group_cols=["c_name", "c_mktsegment"], order_cols=["c_name", "c_mktsegment"],
    )


# ---------------------------------------------------------------------------
# A. scans
# ---------------------------------------------------------------------------


@query("scan_parquet", "SELECT * FROM lineitem")
def scan_parquet_q(spark, sf):
    return scan_parquet(spark, f"{sf}/lineitem.parquet")


@query("scan_explicit_schema", f"SELECT {ORDERS_COLS} FROM orders")
def scan_explicit_schema_q(spark, sf):
    return scan_explicit_schema(spark, f"{sf}/orders.parquet", fx.ORDERS_SPEC)


def _orders_executions(spark, sf) -> str:
    root = work_dir(spark, "raw-orders")
    jobs.write_executions(t(spark, sf, "orders"), root, F.year("o_orderdate"))
    return root


@query("scan_by_execution", f"SELECT {ORDERS_COLS}, CAST(year(o_orderdate) AS VARCHAR) AS execution_id FROM orders")
def scan_by_execution(spark, sf):
    root = _orders_executions(spark, sf)
    df = scan_executions(spark, root)
    return df.select(*fx.ORDERS_SPEC.fields, EXECUTION_COL)


@query("scan_temp_view", "SELECT * FROM customer")
def scan_temp_view(spark, sf):
    t(spark, sf, "customer").createOrReplaceTempView("customer_raw_view")
    return spark.sql("SELECT * FROM customer_raw_view")


@query("scan_table", f"SELECT {ORDERS_COLS} FROM orders")
def scan_table(spark, sf):
    root = work_dir(spark, "catalog")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lakeload_silver LOCATION '{root}/lakeload_silver.db'")
    save_table(cast_projection(t(spark, sf, "orders"), fx.ORDERS_SPEC), "lakeload_silver.orders", f"{root}/orders")
    return spark.table("lakeload_silver.orders")


# ---------------------------------------------------------------------------
# B. sinks and snapshots
# ---------------------------------------------------------------------------


@query("ctas_roundtrip", f"SELECT {ORDERS_COLS} FROM orders")
def ctas_roundtrip(spark, sf):
    path = work_dir(spark, "ctas")
    replace_table(cast_projection(t(spark, sf, "orders"), fx.ORDERS_SPEC), path)
    replace_table(cast_projection(t(spark, sf, "orders"), fx.ORDERS_SPEC), path)  # purge + reload
    return spark.read.parquet(path)


@query("ctas_partitioned", f"SELECT {ORDERS_COLS} FROM orders")
def ctas_partitioned(spark, sf):
    path = work_dir(spark, "ctas-part")
    replace_table(cast_projection(t(spark, sf, "orders"), fx.ORDERS_SPEC), path, ["o_orderstatus", ""])
    return spark.read.parquet(path).select(*fx.ORDERS_SPEC.fields)


@query("save_overwrite", "SELECT * FROM customer")
def save_overwrite(spark, sf):
    root = work_dir(spark, "save")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lakeload_sales LOCATION '{root}/lakeload_sales.db'")
    save_table(t(spark, sf, "nation"), "lakeload_sales.customers", f"{root}/customers")
    save_table(t(spark, sf, "customer"), "lakeload_sales.customers", f"{root}/customers")
    return spark.table("lakeload_sales.customers")


def _orders_snapshots(spark, sf) -> VersionedTable:
    table = VersionedTable(spark, work_dir(spark, "snapshots"))
    before = fx.orders_before(spark, sf)
    table.commit(before)
    jobs.commit_merge(table, merge(table.read(), fx.orders_batch(spark, sf), ["o_orderkey"], CDC))
    return table


@query("snapshot_latest_version", "SELECT 2 AS latest_version, count(*) AS n_versions FROM (VALUES (1), (2)) v(x)")
def snapshot_latest_version(spark, sf):
    h = _orders_snapshots(spark, sf).history()
    return h.select(VERSION_COL).distinct().agg(
        F.max(VERSION_COL).cast("int").alias("latest_version"), F.count(F.lit(1)).alias("n_versions")
    )


@query("snapshot_as_of", f"WITH {fx.SQL_ORDERS_BEFORE} SELECT * FROM orders_before")
def snapshot_as_of(spark, sf):
    return _orders_snapshots(spark, sf).read(1)


@query("snapshot_restore", f"WITH {fx.SQL_ORDERS_BEFORE} SELECT *, 3 AS restored_version FROM orders_before")
def snapshot_restore(spark, sf):
    table = _orders_snapshots(spark, sf)
    v = table.restore(1)
    return table.read().withColumn("restored_version", F.lit(v))


# ---------------------------------------------------------------------------
# C. projections and expressions
# ---------------------------------------------------------------------------

CAST_SPEC = TableSpec(
    "orders_cast",
    {"o_orderkey": "string", "o_custkey": "int", "o_orderstatus": "string", "o_orderdate": "date", "o_orderpriority": "string"},
)


@query(
    "cast_projection",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
              CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders""",
)
def cast_projection_q(spark, sf):
    return cast_projection(t(spark, sf, "orders"), CAST_SPEC)


LENIENT_SPEC = TableSpec(
    "events_lenient",
    {"event_id": "string", "ts": "date", "user_id": "int", "event_type": "boolean", "value": "double", "props": "int"},
)


@query(
    "cast_projection_lenient",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS DATE) AS ts, CAST(user_id AS INTEGER) AS user_id,
              TRY_CAST(event_type AS BOOLEAN) AS event_type, value, TRY_CAST(props AS INTEGER) AS props FROM events""",
)
def cast_projection_lenient(spark, sf):
    return cast_projection(t(spark, sf, "events"), LENIENT_SPEC, lenient=True)


@query("load_stamp", f"SELECT *, DATE '{AS_OF}' AS ts_load FROM orders")
def load_stamp_q(spark, sf):
    return load_stamp(t(spark, sf, "orders"), AS_OF)


@query("filter_load_date", "SELECT count(*) AS regs FROM orders")
def filter_load_date_q(spark, sf):
    stamped = load_stamp(t(spark, sf, "orders"), AS_OF)
    return filter_load_date(stamped, AS_OF).agg(F.count(F.lit(1)).alias("regs"))


@query("filter_load_date_stored", "SELECT count(*) AS regs FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1996-01-02'")
def filter_load_date_stored(spark, sf):
    """Rows of one load day, from a stored table whose rows carry the days they were loaded on."""
    path = work_dir(spark, "stamped-orders")
    t(spark, sf, "orders").withColumn(LOAD_STAMP_COL, F.to_date("o_orderdate")).write.parquet(path)
    return filter_load_date(spark.read.parquet(path), "1996-01-02").agg(F.count(F.lit(1)).alias("regs"))


@query("count_rows", "SELECT count(*) AS regs FROM lineitem")
def count_rows(spark, sf):
    return t(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("regs"))


@query("date_format_report", "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS order_day FROM orders")
def date_format_report(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("order_day"))


# ---------------------------------------------------------------------------
# D/E. gold joins and aggregates
# ---------------------------------------------------------------------------


@query("gold_candidate_by_campaign", SQL_CANDIDATE)
def gold_candidate_by_campaign(spark, sf):
    return candidate_by_campaign(_tables(spark, sf, "part", "lineitem", "supplier"))


@query("gold_candidate_by_campaign_count", f"SELECT count(*) AS regs FROM ({SQL_CANDIDATE}) x")
def gold_candidate_by_campaign_count(spark, sf):
    return gold.group_count(candidate_by_campaign(_tables(spark, sf, "part", "lineitem", "supplier")))


@query(
    "gold_candidate_by_campaign_cdc",
    f"SELECT *, false AS IsDeleted FROM ({SQL_CANDIDATE}) x",
)
def gold_candidate_by_campaign_cdc(spark, sf):
    view = candidate_by_campaign(_tables(spark, sf, "part", "lineitem", "supplier"), with_delete_flag=True)
    view.createOrReplaceTempView("candidate_by_campaign_view")
    return spark.sql("SELECT * FROM candidate_by_campaign_view")


SQL_CANDIDATE_DATES = """
SELECT p.p_partkey AS LeadId, o.o_orderkey AS CampaignId, p.p_name AS Candidate, p.p_brand AS Company, l.l_returnflag AS Status,
       o.o_orderpriority AS Campaign, CAST(o.o_orderdate AS DATE) AS StartDateCampaign,
       CASE WHEN o.o_orderstatus = 'O' THEN NULL ELSE CAST(o.o_orderdate AS DATE) + 90 END AS EndDateCampaign
FROM part p JOIN lineitem l ON p.p_partkey = l.l_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey"""


@query("gold_candidate_dates", SQL_CANDIDATE_DATES)
def gold_candidate_dates(spark, sf):
    """The bridge join with campaign dates: orders stand in for campaigns, open ones have no end."""
    start = F.to_date("o_orderdate")
    campaign = t(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", start.alias("starts"), F.when(F.col("o_orderstatus") != "O", F.date_add(start, 90)).alias("ends")
    )
    return gold.candidate_by_campaign(
        t(spark, sf, "part"), t(spark, sf, "lineitem"), campaign,
        cand_id="p_partkey", cand_name="p_name", cand_company="p_brand",
        lead_id="l_partkey", campaign_id="l_orderkey", bridge_status="l_returnflag",
        camp_id="o_orderkey", camp_name="o_orderpriority", camp_start="starts", camp_end="ends",
    )


SQL_STATUS = "SELECT o_orderstatus AS status, count(*) AS cnt_status_campaign FROM orders GROUP BY o_orderstatus"


@query("gold_status_by_campaign", SQL_STATUS)
def gold_status_by_campaign(spark, sf):
    return status_by_campaign(_tables(spark, sf, "orders"))


@query("gold_status_by_campaign_cdc", f"SELECT *, false AS IsDeleted FROM ({SQL_STATUS}) x")
def gold_status_by_campaign_cdc(spark, sf):
    return status_by_campaign(_tables(spark, sf, "orders"), with_delete_flag=True)


@query("gold_status_group_count", f"SELECT count(*) AS regs FROM ({SQL_STATUS}) x")
def gold_status_group_count(spark, sf):
    return gold.group_count(status_by_campaign(_tables(spark, sf, "orders")))


@query(
    "load_log_gold",
    f"""SELECT 'candidate_by_campaign' AS TableName, 'Table Sucessfull Loaded' AS Status,
               (SELECT count(*) FROM ({SQL_CANDIDATE}) a) AS Rows_Loaded, (SELECT count(*) FROM ({SQL_CANDIDATE}) b) AS Rows_Readed
        UNION ALL
        SELECT 'status_by_campaign', 'Table Sucessfull Loaded',
               (SELECT count(*) FROM ({SQL_STATUS}) c), (SELECT count(*) FROM ({SQL_STATUS}) d)""",
)
def load_log_gold(spark, sf):
    zones = jobs.Zones.under(work_dir(spark, "lake"))
    silver = _tables(spark, sf, "part", "lineitem", "supplier", "orders")
    return jobs.gold_full_load(spark, [GOLD_CANDIDATE, GOLD_STATUS], silver, zones)


# ---------------------------------------------------------------------------
# I. merge / CDC
# ---------------------------------------------------------------------------

PAIR = f"WITH {fx.SQL_ORDERS_BEFORE}, {fx.SQL_ORDERS_BATCH}"

SQL_MERGE_CDC = f"""{PAIR}
SELECT t.o_orderkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority
FROM orders_before t LEFT JOIN orders_batch s ON t.o_orderkey = s.o_orderkey
WHERE s.o_orderkey IS NULL OR s.IsDeleted IS NOT TRUE
UNION ALL
SELECT {ORDERS_COLS} FROM orders_batch s
WHERE s.IsDeleted = false AND NOT EXISTS (SELECT 1 FROM orders_before t WHERE t.o_orderkey = s.o_orderkey)"""

SQL_SNAPSHOT_SUMS = f"""{PAIR}, after AS ({SQL_MERGE_CDC.replace(PAIR, '')}),
both_versions AS (SELECT 1 AS version, * FROM orders_before UNION ALL SELECT 2, * FROM after)
SELECT version, max(version) OVER () AS latest_version, n_rows, sum_price FROM (
  SELECT version, count(*) AS n_rows, round(sum(o_totalprice), 2) AS sum_price FROM both_versions GROUP BY version) x"""


@query("snapshot_sums", SQL_SNAPSHOT_SUMS)
def snapshot_sums(spark, sf):
    """Every committed version as it was: rows and sum, and which one is the latest."""
    table = _orders_snapshots(spark, sf)
    sums = None
    for v in table.versions():
        own = table.read(v).agg(F.lit(v).alias("version"), F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("sum_price"))
        sums = own if sums is None else sums.unionByName(own)
    return sums.withColumn("latest_version", F.lit(table.latest_version()))


SQL_MERGE_CDC_METRICS = f"""{PAIR}
SELECT
  (SELECT count(*) FROM orders_batch s WHERE s.IsDeleted = false
     AND NOT EXISTS (SELECT 1 FROM orders_before t WHERE t.o_orderkey = s.o_orderkey)) AS num_inserted_rows,
  (SELECT count(*) FROM orders_before t JOIN orders_batch s ON t.o_orderkey = s.o_orderkey
     WHERE s.IsDeleted IS NOT TRUE) AS num_updated_rows,
  (SELECT count(*) FROM orders_before t JOIN orders_batch s ON t.o_orderkey = s.o_orderkey
     WHERE s.IsDeleted) AS num_deleted_rows,
  (SELECT count(*) FROM orders_batch s WHERE s.IsDeleted IS NOT FALSE
     AND NOT EXISTS (SELECT 1 FROM orders_before t WHERE t.o_orderkey = s.o_orderkey)) AS num_dropped_rows,
  (SELECT count(*) FROM orders_before t
     WHERE NOT EXISTS (SELECT 1 FROM orders_batch s WHERE t.o_orderkey = s.o_orderkey)) AS num_kept_rows"""

SQL_MERGE_FULL = f"""{PAIR}
SELECT t.* FROM orders_before t WHERE NOT EXISTS (SELECT 1 FROM orders_batch s WHERE t.o_orderkey = s.o_orderkey)
UNION ALL
SELECT {ORDERS_COLS} FROM orders_batch WHERE IsDeleted = false"""

SQL_MERGE_FULL_METRICS = f"""{PAIR}
SELECT
  (SELECT count(*) FROM orders_batch WHERE IsDeleted = false) AS num_inserted_rows,
  CAST(0 AS BIGINT) AS num_updated_rows,
  (SELECT count(*) FROM orders_before t WHERE EXISTS (SELECT 1 FROM orders_batch s WHERE t.o_orderkey = s.o_orderkey)) AS num_deleted_rows,
  (SELECT count(*) FROM orders_batch WHERE IsDeleted IS NOT FALSE) AS num_dropped_rows,
  (SELECT count(*) FROM orders_before t
     WHERE NOT EXISTS (SELECT 1 FROM orders_batch s WHERE t.o_orderkey = s.o_orderkey)) AS num_kept_rows"""


def _orders_merge(spark, sf, mode, small=None):
    return merge(fx.orders_before(spark, sf), fx.orders_batch(spark, sf), ["o_orderkey"], mode, small_source=small)


@query("merge_cdc", SQL_MERGE_CDC)
def merge_cdc(spark, sf):
    return _orders_merge(spark, sf, CDC).rows()


@query("merge_cdc_metrics", SQL_MERGE_CDC_METRICS)
def merge_cdc_metrics(spark, sf):
    return _orders_merge(spark, sf, CDC).metrics()


@query("merge_cdc_shuffle", SQL_MERGE_CDC)
def merge_cdc_shuffle(spark, sf):
    """The same merge with the broadcast plan switched off (the large-batch plan)."""
    return _orders_merge(spark, sf, CDC, small=False).rows()


@query("merge_full", SQL_MERGE_FULL)
def merge_full(spark, sf):
    return _orders_merge(spark, sf, FULL).rows()


@query("merge_full_metrics", SQL_MERGE_FULL_METRICS)
def merge_full_metrics(spark, sf):
    return _orders_merge(spark, sf, FULL).metrics()


@query(
    "merge_delete_only",
    f"""{PAIR} SELECT t.* FROM orders_before t
    WHERE NOT EXISTS (SELECT 1 FROM orders_batch s WHERE s.o_orderkey = t.o_orderkey AND s.IsDeleted)""",
)
def merge_delete_only(spark, sf):
    return delete_step(fx.orders_before(spark, sf), fx.orders_batch(spark, sf), ["o_orderkey"])


@query(
    "merge_insert_only",
    f"""{PAIR} SELECT {ORDERS_COLS} FROM orders_batch s WHERE s.IsDeleted = false
    AND NOT EXISTS (SELECT 1 FROM orders_before t WHERE t.o_orderkey = s.o_orderkey)""",
)
def merge_insert_only(spark, sf):
    return insert_step(fx.orders_before(spark, sf), fx.orders_batch(spark, sf), ["o_orderkey"])


@query(
    "merge_update_only",
    f"""{PAIR} SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderdate, s.o_orderpriority
    FROM orders_batch s JOIN orders_before t ON t.o_orderkey = s.o_orderkey WHERE s.IsDeleted IS NOT TRUE""",
)
def merge_update_only(spark, sf):
    return update_step(fx.orders_before(spark, sf), fx.orders_batch(spark, sf), ["o_orderkey"])


SQL_BOOT = f"WITH {fx.SQL_ORDERS_CHANGES}"


@query(
    "merge_bootstrap",
    f"""{SQL_BOOT} SELECT {ORDERS_COLS} FROM orders_changes WHERE IsDeleted IS NOT TRUE""",
)
def merge_bootstrap(spark, sf):
    batch = fx.orders_changes(spark, sf)
    return merge(bootstrap_target(batch), batch, ["o_orderkey"], CDC).rows()


@query(
    "merge_bootstrap_metrics",
    f"""{SQL_BOOT} SELECT CAST(0 AS BIGINT) AS num_inserted_rows,
        count(*) FILTER (WHERE IsDeleted IS NOT TRUE) AS num_updated_rows,
        count(*) FILTER (WHERE IsDeleted) AS num_deleted_rows,
        CAST(0 AS BIGINT) AS num_dropped_rows, CAST(0 AS BIGINT) AS num_kept_rows FROM orders_changes""",
)
def merge_bootstrap_metrics(spark, sf):
    batch = fx.orders_changes(spark, sf)
    return merge(bootstrap_target(batch), batch, ["o_orderkey"], CDC).metrics()


EV_PAIR = f"WITH {fx.SQL_EVENTS_BEFORE}, {fx.SQL_EVENTS_BATCH}"


@query(
    "merge_composite_key",
    f"""{EV_PAIR}
SELECT t.event_id, t.ts, t.user_id, t.event_type, t.value, t.props FROM events_before t
WHERE NOT EXISTS (SELECT 1 FROM events_batch s WHERE s.user_id = t.user_id AND s.ts = t.ts)
UNION ALL
SELECT s.event_id, s.ts, s.user_id, s.event_type, s.value, s.props
FROM events_batch s JOIN events_before t ON s.user_id = t.user_id AND s.ts = t.ts WHERE s.IsDeleted IS NOT TRUE
UNION ALL
SELECT s.event_id, s.ts, s.user_id, s.event_type, s.value, s.props FROM events_batch s
WHERE s.IsDeleted = false AND NOT EXISTS (SELECT 1 FROM events_before t WHERE s.user_id = t.user_id AND s.ts = t.ts)""",
)
def merge_composite_key(spark, sf):
    return merge(fx.events_before(spark, sf), fx.events_batch(spark, sf), ["user_id", "ts"], CDC).rows()


@query("merge_cdc_cast", SQL_MERGE_CDC)
def merge_cdc_cast(spark, sf):
    raw = fx.orders_batch(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in fx.ORDERS_SPEC.fields], "IsDeleted")
    return merge(fx.orders_before(spark, sf), raw, ["o_orderkey"], CDC).rows()


@query(
    "merge_duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_source_rows FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def merge_duplicate_keys(spark, sf):
    li = t(spark, sf, "lineitem")
    return duplicate_keys(li, li, ["l_orderkey", "l_linenumber"])


SQL_LATEST = """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn = 1"""


@query("merge_latest_per_key", SQL_LATEST)
def merge_latest_per_key(spark, sf):
    return latest_per_key(t(spark, sf, "events"), ["user_id"], ["ts", "event_id"])


EVENTS_BY_USER = TableSpec(
    "events_by_user",
    {"user_id": "bigint", "event_id": "bigint", "ts": "timestamp_ntz", "event_type": "string", "value": "double", "props": "string"},
    keys=("user_id",),
    load_type=CDC,
)


@query(
    "merge_multi_batch",
    """SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x
WHERE rn = 1 AND event_type <> 'error'""",
)
def merge_multi_batch(spark, sf):
    """Weekly batches of events keyed by user, each reduced to the latest event per
    user, applied one after another (a deleted user comes back on a later event)."""
    e = t(spark, sf, "events").select(
        *EVENTS_BY_USER.fields, (F.col("event_type") == "error").alias("IsDeleted"),
        F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias(EXECUTION_COL),
    )
    table = VersionedTable(spark, work_dir(spark, "multi-batch"))
    # one aggregation dedupes every batch (latest event per user and week) ...
    per_batch = latest_per_key(e, ["user_id", EXECUTION_COL], ["ts", "event_id"])
    # ... then the batches are merged one after another, in week order
    jobs.fold_batches(spark, table, EVENTS_BY_USER, per_batch)
    return table.read()


@query("merge_collapsed_batches", ORACLE_SQL["merge_multi_batch"])
def merge_collapsed_batches(spark, sf):
    """The weekly batches of ``merge_multi_batch`` reduced to one net change per user
    and merged once: one table rewrite instead of one per batch, same table."""
    e = t(spark, sf, "events").select(
        *EVENTS_BY_USER.fields, (F.col("event_type") == "error").alias("IsDeleted"),
        F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias(EXECUTION_COL),
    )
    per_batch = latest_per_key(e, ["user_id", EXECUTION_COL], ["ts", "event_id"])
    net = collapse_changes(per_batch, ["user_id"], [EXECUTION_COL, "ts", "event_id"]).drop(EXECUTION_COL)
    first = per_batch.agg(F.min(EXECUTION_COL).alias("__first"))
    # the table starts from the first batch (bootstrap), as the batch-by-batch job does
    boot = per_batch.join(first, per_batch[EXECUTION_COL] == first["__first"], "left_semi").drop(EXECUTION_COL, "IsDeleted")
    return merge(boot, net, ["user_id"], CDC).rows()


@query(
    "cdc_read_counts",
    f"""WITH {fx.SQL_ORDERS_CHANGES} SELECT count(*) FILTER (WHERE IsDeleted) AS num_read_deleted_regs,
        count(*) FILTER (WHERE IsDeleted = false) AS num_read_upsert_regs FROM orders_changes""",
)
def cdc_read_counts(spark, sf):
    b = fx.orders_changes(spark, sf)
    return b.agg(
        F.count_if(F.col("IsDeleted")).alias("num_read_deleted_regs"),
        F.count_if(~F.col("IsDeleted")).alias("num_read_upsert_regs"),
    )


@query(
    "cdc_reconcile",
    f"""{PAIR}, m AS ({SQL_MERGE_CDC_METRICS.replace(PAIR, '')}),
    r AS (SELECT count(*) FILTER (WHERE IsDeleted) AS num_read_deleted_regs,
                 count(*) FILTER (WHERE IsDeleted = false) AS num_read_upsert_regs,
                 count(*) FILTER (WHERE IsDeleted IS NULL) AS num_read_null_flag_regs FROM orders_batch)
    SELECT r.num_read_deleted_regs, r.num_read_upsert_regs, r.num_read_null_flag_regs,
           m.num_inserted_rows, m.num_updated_rows, m.num_deleted_rows, m.num_dropped_rows,
           m.num_inserted_rows + m.num_updated_rows AS upsert_rows,
           (r.num_read_deleted_regs + r.num_read_upsert_regs + r.num_read_null_flag_regs
             = m.num_inserted_rows + m.num_updated_rows + m.num_deleted_rows + m.num_dropped_rows) AS ok_total,
           (r.num_read_upsert_regs = m.num_inserted_rows + m.num_updated_rows) AS ok_upsert
    FROM r, m""",
)
def cdc_reconcile(spark, sf):
    batch = fx.orders_batch(spark, sf)
    return jobs.cdc_reconcile(batch, merge(fx.orders_before(spark, sf), batch, ["o_orderkey"], CDC))


def _batch_executions(spark, sf) -> str:
    root = work_dir(spark, "raw-cdc")
    jobs.write_executions(fx.orders_batch(spark, sf), f"{root}/orders", F.year("o_orderdate"))
    return root


@query(
    "cdc_unprocessed_batches",
    f"""WITH {fx.SQL_ORDERS_CHANGES} SELECT {ORDERS_COLS}, IsDeleted, CAST(year(o_orderdate) AS VARCHAR) AS execution_id
        FROM orders_changes WHERE year(o_orderdate) NOT IN (1997, 1998)""",
)
def cdc_unprocessed_batches(spark, sf):
    """Executions 1997 and 1998 are in the ledger; the rows of the others are pending."""
    root = work_dir(spark, "raw-cdc")
    jobs.write_executions(fx.orders_changes(spark, sf), f"{root}/orders", F.year("o_orderdate"))
    ledger = Ledger(spark, f"{root}/_ledger")
    for ex in ("1997", "1998"):
        ledger.record("orders", ex, 0, 0, 0, 0)
    rows = scan_executions(spark, f"{root}/orders")
    return ledger.unprocessed(rows, "orders").select(*fx.ORDERS_SPEC.fields, "IsDeleted", EXECUTION_COL)


@query(
    "cdc_archive_layout",
    f"""WITH {fx.SQL_ORDERS_CHANGES} SELECT {ORDERS_COLS}, IsDeleted,
        2024 AS year, 1 AS month, 31 AS day, 10 AS hour, 15 AS minute FROM orders_changes""",
)
def cdc_archive_layout(spark, sf):
    root = work_dir(spark, "archive")
    archive_batch(fx.orders_changes(spark, sf), root, PROCESSED_AT)
    return spark.read.parquet(root)


def _cdc_lake(spark, sf):
    """Silver orders = the table before the change (version 1), then the batch
    executions (one per order year) applied by the CDC job."""
    lake = work_dir(spark, "lake-cdc")
    zones = jobs.Zones(raw=f"{lake}/raw", silver=f"{lake}/silver", gold=f"{lake}/gold", meta=f"{lake}/_meta")
    jobs.write_executions(fx.orders_batch(spark, sf), f"{zones.raw}/orders", F.year("o_orderdate"))
    zones.silver_table(spark, fx.ORDERS_SPEC).commit(fx.orders_before(spark, sf))
    log = jobs.cdc_load(spark, [fx.ORDERS_SPEC], zones, processed_at=PROCESSED_AT)
    return zones, log


@query("cdc_load_silver", SQL_MERGE_CDC)
def cdc_load_silver(spark, sf):
    zones, log = _cdc_lake(spark, sf)
    log.collect()
    return zones.silver_table(spark, fx.ORDERS_SPEC).read()


@query("cdc_load_collapsed", SQL_MERGE_CDC)
def cdc_load_collapsed(spark, sf):
    """The CDC job with all pending executions merged as one net change."""
    lake = work_dir(spark, "lake-cdc-net")
    zones = jobs.Zones.under(lake)
    jobs.write_executions(fx.orders_batch(spark, sf), f"{zones.raw}/orders", F.year("o_orderdate"))
    zones.silver_table(spark, fx.ORDERS_SPEC).commit(fx.orders_before(spark, sf))
    jobs.cdc_load(spark, [fx.ORDERS_SPEC], zones, processed_at=PROCESSED_AT, collapse=True).collect()
    return zones.silver_table(spark, fx.ORDERS_SPEC).read()


@query("stream_cdc_merge_collapsed", SQL_MERGE_CDC)
def stream_cdc_merge_collapsed(spark, sf):
    """The file stream with each micro-batch merged as one net change."""
    root = _batch_executions(spark, sf)
    table = VersionedTable(spark, f"{root}/silver/orders")
    table.commit(fx.orders_before(spark, sf))
    ledger = Ledger(spark, f"{root}/_ledger")
    stream_cdc_apply(spark, f"{root}/orders", fx.ORDERS_SPEC, table, ledger, f"{root}/_checkpoint", collapse=True)
    return table.read()


@query(
    "load_log_cdc",
    f"""{PAIR} SELECT 'orders' AS TableName, 'Table Sucessfull Loaded' AS Status,
        count(*) FILTER (WHERE IsDeleted = false) AS num_inserted_rows,
        CAST(0 AS BIGINT) AS num_updated_rows, CAST(0 AS BIGINT) AS num_deleted_rows
        FROM orders_batch WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders_batch)""",
)
def load_log_cdc(spark, sf):
    _, log = _cdc_lake(spark, sf)
    return log


SQL_AFTER_STATUS = f"""
SELECT o_orderstatus AS status, count(*) AS cnt_status_campaign FROM ({SQL_MERGE_CDC}) m GROUP BY o_orderstatus"""


@query(
    "gold_cdc_merge",
    f"""WITH new AS ({SQL_AFTER_STATUS}),
    old AS (SELECT o_orderstatus AS status, count(*) AS cnt_status_campaign
            FROM orders WHERE o_orderdate < TIMESTAMP '{fx.ORDERS_TABLE_BEFORE}' GROUP BY o_orderstatus)
    SELECT * FROM new UNION ALL SELECT * FROM old WHERE status NOT IN (SELECT status FROM new)""",
)
def gold_cdc_merge(spark, sf):
    """Gold status counts built on the table before the change, then merged with the
    view recomputed on the merged silver table."""
    lake = work_dir(spark, "lake-gold")
    zones = jobs.Zones.under(lake)
    jobs.gold_full_load(spark, [GOLD_STATUS], {"orders": fx.orders_before(spark, sf)}, zones).collect()
    after = _orders_merge(spark, sf, CDC).rows()
    jobs.gold_cdc_load(spark, [GOLD_STATUS], {"orders": after}, zones).collect()
    return zones.gold_table(spark, GOLD_STATUS).read()


@query(
    "gold_cdc_keeps_stale",
    """SELECT o_orderstatus AS status, count(*) AS cnt_status_campaign FROM orders GROUP BY o_orderstatus""",
)
def gold_cdc_keeps_stale(spark, sf):
    """Every 'P' order is deleted from silver; the gold CDC view no longer has a 'P'
    group, and since the view never deletes, gold keeps the stale 'P' count."""
    lake = work_dir(spark, "lake-stale")
    zones = jobs.Zones.under(lake)
    orders = t(spark, sf, "orders")
    jobs.gold_full_load(spark, [GOLD_STATUS], {"orders": orders}, zones).collect()
    batch = orders.withColumn("IsDeleted", F.col("o_orderstatus") == "P")
    after = merge(cast_projection(orders, fx.ORDERS_SPEC), batch, ["o_orderkey"], CDC).rows()
    jobs.gold_cdc_load(spark, [GOLD_STATUS], {"orders": after}, zones).collect()
    return zones.gold_table(spark, GOLD_STATUS).read()


# ---------------------------------------------------------------------------
# M. full-load jobs
# ---------------------------------------------------------------------------


def _full_lake(spark, sf, specs_extra=()):
    lake = work_dir(spark, "lake-full")
    zones = jobs.Zones.under(lake)
    jobs.write_executions(t(spark, sf, "orders"), f"{zones.raw}/orders", F.year("o_orderdate"))
    jobs.write_executions(t(spark, sf, "customer"), f"{zones.raw}/customer", F.lit("0001"))
    log = jobs.full_load(spark, [fx.ORDERS_SPEC, fx.CUSTOMER_SPEC, *specs_extra], zones)
    return zones, log


SQL_FULL_LOG = """
SELECT 'orders' AS TableName, 'Table Sucessfull Loaded' AS Status, count(*) AS Rows_Loaded, count(*) AS Rows_Readed
FROM orders GROUP BY year(o_orderdate)
UNION ALL
SELECT 'customer', 'Table Sucessfull Loaded', count(*), count(*) FROM customer"""


@query(
    "full_load_silver",
    f"SELECT {ORDERS_COLS} FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)",
)
def full_load_silver(spark, sf):
    zones, log = _full_lake(spark, sf)
    log.collect()
    return zones.silver_table(spark, fx.ORDERS_SPEC).read()


@query(
    "full_load_last_execution",
    """SELECT CAST(max(year(o_orderdate)) AS VARCHAR) AS execution_id FROM orders""",
)
def full_load_last_execution(spark, sf):
    root = _orders_executions(spark, sf)
    return jobs.execution_counts(spark, root).agg(F.max(EXECUTION_COL).alias(EXECUTION_COL))


@query("load_log_full", SQL_FULL_LOG)
def load_log_full(spark, sf):
    return _full_lake(spark, sf)[1]


@query(
    "load_log_missing_table",
    SQL_FULL_LOG + """
UNION ALL SELECT 'account', 'Don''t exist data for the table', 0, 0""",
)
def load_log_missing_table(spark, sf):
    account = TableSpec("account", {"Id": "string", "Name": "string"}, keys=("Id",), path="account")
    return _full_lake(spark, sf, [account])[1]


@query(
    "load_log_error_row",
    SQL_FULL_LOG + """
UNION ALL SELECT 'customer_names', 'Error loading table please review the code ', 0, 0""",
)
def load_log_error_row(spark, sf):
    """A strict cast of customer names to int fails; that table logs an error row."""
    bad = TableSpec("customer_names", {"c_custkey": "bigint", "c_name": "int"}, path="customer")
    return _full_lake(spark, sf, [bad])[1]


@query(
    "load_reconcile",
    f"SELECT *, true AS ok FROM ({SQL_FULL_LOG}) x",
)
def load_reconcile(spark, sf):
    return jobs.load_reconcile(_full_lake(spark, sf)[1])


# ---------------------------------------------------------------------------
# B9. change feed
# ---------------------------------------------------------------------------

SQL_CHANGE_FEED = f"""{PAIR}, after AS ({SQL_MERGE_CDC.replace(PAIR, '')}),
j AS (SELECT b.o_orderkey AS kb, a.o_orderkey AS ka,
             b.o_custkey AS b_c, b.o_orderstatus AS b_s, b.o_totalprice AS b_p, b.o_orderdate AS b_d, b.o_orderpriority AS b_r,
             a.o_custkey AS a_c, a.o_orderstatus AS a_s, a.o_totalprice AS a_p, a.o_orderdate AS a_d, a.o_orderpriority AS a_r
      FROM orders_before b FULL OUTER JOIN after a ON b.o_orderkey = a.o_orderkey),
ch AS (SELECT *, (kb IS NOT NULL AND ka IS NOT NULL AND (b_c IS DISTINCT FROM a_c OR b_s IS DISTINCT FROM a_s
         OR b_p IS DISTINCT FROM a_p OR b_d IS DISTINCT FROM a_d OR b_r IS DISTINCT FROM a_r)) AS changed FROM j)
SELECT kb AS o_orderkey, b_c AS o_custkey, b_s AS o_orderstatus, b_p AS o_totalprice, b_d AS o_orderdate, b_r AS o_orderpriority,
       CASE WHEN ka IS NULL THEN 'delete' ELSE 'update_preimage' END AS _change_type
FROM ch WHERE kb IS NOT NULL AND (ka IS NULL OR changed)
UNION ALL
SELECT ka, a_c, a_s, a_p, a_d, a_r, CASE WHEN kb IS NULL THEN 'insert' ELSE 'update_postimage' END
FROM ch WHERE ka IS NOT NULL AND (kb IS NULL OR changed)"""


def _feed(spark, sf):
    return cf.change_feed(fx.orders_before(spark, sf), _orders_merge(spark, sf, CDC).rows(), ["o_orderkey"])


@query("change_feed", SQL_CHANGE_FEED)
def change_feed_q(spark, sf):
    return _feed(spark, sf)


@query(
    "change_feed_counts",
    f"""WITH f AS ({SQL_CHANGE_FEED}) SELECT count(*) FILTER (WHERE _change_type = 'insert') AS num_inserted_rows,
        count(*) FILTER (WHERE _change_type = 'update_postimage') AS num_updated_rows,
        count(*) FILTER (WHERE _change_type = 'delete') AS num_deleted_rows FROM f""",
)
def change_feed_counts(spark, sf):
    return cf.change_counts(_feed(spark, sf))


# ---------------------------------------------------------------------------
# J. data quality
# ---------------------------------------------------------------------------


def rules(spark) -> DataFrame:
    return rules_from_local_csv(spark, RULES_PATH)


def dq_tables(spark, sf) -> dict[str, DataFrame]:
    return _tables(spark, sf, "customer", "orders", "lineitem", "pages", "supplier")


# One SQL select per rule: (table, key, metric, pass fraction, holds, total).
_F = "CAST(count(*) FILTER (WHERE {c}) AS DOUBLE) / CAST(count(*) AS DOUBLE)"
DQ_RULE_SQL = {
    ("customer", 1): f"SELECT 'customer' AS tn, 1 AS k, {_F.format(c='c_custkey IS NOT NULL')} AS m, NULL AS p, count(*) AS total FROM customer",
    ("customer", 2): f"SELECT 'customer', 2, {_F.format(c='coalesce(c_acctbal, 0.0) >= 0')}, NULL, count(*) FROM customer",
    ("customer", 3): "SELECT 'customer', 3, "
    + _F.format(c="c_mktsegment IS NULL OR c_mktsegment IN ('AUTOMOBILE', 'BUILDING')")
    + ", NULL, count(*) FROM customer",
    ("customer", 4): "SELECT 'customer', 4, CAST(max(length(c_name)) AS DOUBLE), "
    + _F.format(c="c_name IS NULL OR length(c_name) = 18")
    + ", count(*) FROM customer",
    ("customer", 5): "SELECT 'customer', 5, "
    + _F.format(c=f"regexp_matches(c_name, '{dqmod.EMAIL_PATTERN}')")
    + ", NULL, count(*) FROM customer",
    ("customer", 6): "SELECT 'customer', 6, "
    + _F.format(c=r"regexp_matches(c_name, '^Customer#\d{9}$')")
    + ", NULL, count(*) FROM customer",
    ("orders", 1): "SELECT 'orders', 1, CAST(count(*) FILTER (WHERE regexp_matches(o_orderstatus, '^(true|false)$')) AS DOUBLE) / CAST(count(o_orderstatus) AS DOUBLE), NULL, count(*) FROM orders",
    ("orders", 2): f"SELECT 'orders', 2, {_F.format(c='o_totalprice > 0')}, NULL, count(*) FROM orders",
    ("orders", 3): """SELECT 'orders', 3, CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / CAST(sum(n) AS DOUBLE), NULL, sum(n)
                      FROM (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY o_orderkey) g""",
    ("lineitem", 1): f"SELECT 'lineitem', 1, {_F.format(c='coalesce(l_quantity, 1.0) > 0')}, NULL, count(*) FROM lineitem",
    ("lineitem", 2): f"SELECT 'lineitem', 2, {_F.format(c='l_discount <= l_quantity')}, NULL, count(*) FROM lineitem",
    ("pages", 1): "SELECT 'pages', 1, "
    + _F.format(c=f"regexp_matches(url, '{dqmod.URL_PATTERN}')")
    + ", NULL, count(*) FROM pages",
}
# Value the metric is asserted against, per rule (length rule: == 18).
DQ_ASSERT = {("customer", 4): "m = 18", ("orders", 2): "m = 1.0"}

_RULES_CSV_SQL = """SELECT * FROM (VALUES
  ('customer', ' c_name ', 4), ('customer', 'c_custkey', 1), ('customer', 'c_acctbal', 2), ('customer', 'c_mktsegment', 3),
  ('customer', 'c_name', 5), ('customer', 'c_name', 6), ('orders', 'o_orderstatus', 1), ('orders', 'o_totalprice', 2),
  ('orders', 'o_orderkey', 3), ('lineitem', 'l_quantity', 1), ('lineitem', 'l_discount', 2), ('pages', 'url', 1)) r(tn, attr, k)"""


def _dq_metric_sql(keys) -> str:
    parts = []
    for key in keys:
        holds = DQ_ASSERT.get(key, "m = 1.0")
        parts.append(
            f"SELECT tn, k, m, coalesce(p, m) AS p, coalesce({holds}, false) AS holds, total "
            f"FROM ({DQ_RULE_SQL[key]}) q(tn, k, m, p, total)"
        )
    return " UNION ALL ".join(parts)


_RULE_META = {
    ("customer", 1): ("c_custkey", "Customer key is always filled", "Customer", "Completeness"),
    ("customer", 2): ("c_acctbal", "Account balance is not negative", "Customer", "Validity"),
    ("customer", 3): ("c_mktsegment", "Segment is automobile or building", "Customer", "Validity"),
    ("customer", 4): (" c_name ", "Name has 18 characters", "Customer", "Conformity"),
    ("customer", 5): ("c_name", "Name holds no e-mail address", "Customer", "Privacy"),
    ("customer", 6): ("c_name", "Name follows the customer pattern", "Customer", "Conformity"),
    ("orders", 1): ("o_orderstatus", "Status is a boolean flag", "Orders", "Validity"),
    ("orders", 2): ("o_totalprice", "Total price is positive", "Orders", "Validity"),
    ("orders", 3): ("o_orderkey", "Order key is unique", "Orders", "Uniqueness"),
    ("lineitem", 1): ("l_quantity", "Quantity is positive", "Lineitem", "Validity"),
    ("lineitem", 2): ("l_discount", "Discount is at most the quantity", "Lineitem", "Consistency"),
    ("pages", 1): ("url", "Page address is a url", "Pages", "Validity"),
}


def _dq_results_sql(keys) -> str:
    meta = " UNION ALL ".join(
        f"SELECT '{tn}' AS tn, {k} AS k, '{a}' AS attr, '{d}' AS def, '{dom}' AS dom, '{dim}' AS dim"
        for (tn, k), (a, d, dom, dim) in ((key, _RULE_META[key]) for key in keys)
    )
    return f"""WITH met AS ({_dq_metric_sql(keys)}), meta AS ({meta})
SELECT meta.tn AS "Table Name", meta.attr AS "Attribute Name", meta.def AS "Rule Definition", meta.dom AS "Domain",
       meta.dim AS "DQ Dimension",
       CASE WHEN met.holds THEN 'Success' ELSE 'Failure' END AS "Constraint Status",
       CASE WHEN met.holds THEN '' ELSE 'Value: ' || coalesce(CAST(round(met.m, 6) AS VARCHAR), 'null') || ' does not meet the constraint requirement!' END AS "Constraint Message",
       CAST(met.k AS INTEGER) AS "Row Num", CAST(met.total AS BIGINT) AS "Total Rows",
       met.m AS metric_value, met.p AS pass_fraction
FROM met JOIN meta ON met.tn = meta.tn AND met.k = meta.k"""


def _dq_single(spark, sf, table_name: str, key: int) -> DataFrame:
    res = dqmod.check_table(dq_tables(spark, sf)[table_name], rules(spark), table_name)
    return dqmod.results_frame(res).filter(F.col("Row Num") == key)


_SINGLE = {
    "dq_is_complete": ("customer", 1),
    "dq_is_non_negative": ("customer", 2),
    "dq_is_contained_in": ("customer", 3),
    "dq_has_max_length": ("customer", 4),
    "dq_contains_email": ("customer", 5),
    "dq_has_pattern": ("customer", 6),
    "dq_has_data_type": ("orders", 1),
    "dq_satisfies": ("orders", 2),
    "dq_is_unique": ("orders", 3),
    "dq_is_positive": ("lineitem", 1),
    "dq_column_comparison": ("lineitem", 2),
    "dq_contains_url": ("pages", 1),
}


def _register_single(name: str, table_name: str, key: int) -> None:
    def fn(spark, sf):
        return _dq_single(spark, sf, table_name, key)

    fn.__name__ = name
    query(name, _dq_results_sql([(table_name, key)]))(fn)


for _name, (_tn, _k) in _SINGLE.items():
    _register_single(_name, _tn, _k)

_CUSTOMER_KEYS = [("customer", k) for k in range(1, 7)]
_ALL_KEYS = list(_RULE_META)


@query(
    "dq_metrics",
    f"""SELECT CAST(k AS INTEGER) AS "Key", m AS metric_value, p AS pass_fraction, holds, total AS total_rows
        FROM ({_dq_metric_sql(_CUSTOMER_KEYS)}) x""",
)
def dq_metrics(spark, sf):
    parsed = dqmod._rules_for(rules(spark), "customer")
    return dqmod.rule_metrics(t(spark, sf, "customer"), parsed)


def _unique_sql(key: int, columns: str) -> str:
    some = " OR ".join(f"{c} IS NOT NULL" for c in columns.split(", "))
    return f"""SELECT CAST({key} AS INTEGER) AS "Key", CAST(once AS DOUBLE) / base AS metric_value, CAST(once AS DOUBLE) / base AS pass_fraction,
       coalesce(once = base, false) AS holds, total AS total_rows
FROM (SELECT CAST(sum(CASE WHEN met AND n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS once, CAST(sum(CASE WHEN met THEN n END) AS BIGINT) AS base, CAST(sum(n) AS BIGINT) AS total
      FROM (SELECT ({some}) AS met, count(*) AS n FROM lineitem GROUP BY {columns}) g) s"""


_LARGE_UNIQUE = {1: ("l_orderkey", ("l_linenumber",)), 2: ("l_orderkey", ("l_partkey",)), 3: ("l_orderkey", ("l_shipdate", "l_quantity"))}


@query("dq_is_unique_large", " UNION ALL ".join(_unique_sql(k, ", ".join([a, *more])) for k, (a, more) in _LARGE_UNIQUE.items()))
def dq_is_unique_large(spark, sf):
    """Composite keys of ``lineitem`` checked by hash first, by value only where a hash is met again."""
    out = None
    for k, (attribute, more) in _LARGE_UNIQUE.items():
        rule = dqmod.Rule(k, "isPrimaryKey", attribute, "list", None, None, more)
        row = unique_metrics(t(spark, sf, "lineitem"), rule)
        out = row if out is None else out.unionByName(row)
    return out


@query("dq_results_numbered", _dq_results_sql(_CUSTOMER_KEYS))
def dq_results_numbered(spark, sf):
    return dqmod.results_frame(dqmod.check_table(t(spark, sf, "customer"), rules(spark), "customer"))


@query("dq_results_join_rules", _dq_results_sql([("orders", 1), ("orders", 2), ("orders", 3)]))
def dq_results_join_rules(spark, sf):
    return dqmod.results_frame(dqmod.check_table(t(spark, sf, "orders"), rules(spark), "orders"))


@query("dq_report_union", _dq_results_sql(_ALL_KEYS))
def dq_report_union(spark, sf):
    return jobs.dq_results(spark, dq_tables(spark, sf), rules(spark))


SQL_DQ_REPORT = f"""WITH res AS ({_dq_results_sql(_ALL_KEYS)}),
f AS (SELECT *, coalesce(CASE WHEN "Constraint Status" = 'Success' THEN 1.0 ELSE pass_fraction END, 1.0) AS fr FROM res),
g AS (SELECT *, fr * 100 AS pp, (1.0 - fr) * 100 AS fp FROM f)
SELECT "Table Name", "Attribute Name", "Rule Definition", "DQ Dimension", "Constraint Status", "Domain", "Total Rows",
       round(pp * (CAST("Total Rows" AS DOUBLE) / 100), 2) AS "Pass Count",
       round(fp * (CAST("Total Rows" AS DOUBLE) / 100), 2) AS "Failure Count",
       round(pp, 2) AS "Pass %", round(fp, 2) AS "Fail %",
       CASE WHEN fp > 50 THEN 'High Impact' WHEN fp <= 50 AND fp > 0 THEN 'Low Impact' WHEN pp = 100 THEN 'No Impact' END AS "Impact",
       "Constraint Message", strftime(DATE '{AS_OF}', '%d/%m/%Y') AS "Date"
FROM g"""


@query("dq_report", SQL_DQ_REPORT)
def dq_report(spark, sf):
    return jobs.dq_job(spark, dq_tables(spark, sf), rules(spark), AS_OF)


@query(
    "dq_impact",
    f"""SELECT "Table Name", "Attribute Name", "Rule Definition", "Impact" FROM ({SQL_DQ_REPORT}) r""",
)
def dq_impact(spark, sf):
    return dq_report(spark, sf).select("Table Name", "Attribute Name", "Rule Definition", "Impact")


@query(
    "dq_message_metric",
    f"""WITH res AS ({_dq_results_sql(_ALL_KEYS)}),
    s AS (SELECT *, TRY_CAST(regexp_extract("Constraint Message", '{NUMBER_PATTERN}', 0) AS DOUBLE) AS v FROM res)
    SELECT "Table Name", "Row Num", coalesce(v * 100, 100.0) AS "Pass %", coalesce((1.0 - v) * 100, 0.0) AS "Fail %" FROM s""",
)
def dq_message_metric(spark, sf):
    return dqmod.message_metric(jobs.dq_results(spark, dq_tables(spark, sf), rules(spark)))


# ---------------------------------------------------------------------------
# K. streaming
# ---------------------------------------------------------------------------


@query("stream_cdc_merge", SQL_MERGE_CDC)
def stream_cdc_merge(spark, sf):
    """The batch executions arrive as a file stream and are merged per micro-batch."""
    root = _batch_executions(spark, sf)
    table = VersionedTable(spark, f"{root}/silver/orders")
    table.commit(fx.orders_before(spark, sf))
    ledger = Ledger(spark, f"{root}/_ledger")
    stream_cdc_apply(spark, f"{root}/orders", fx.ORDERS_SPEC, table, ledger, f"{root}/_checkpoint", max_files_per_trigger=4)
    return table.read()


# ---------------------------------------------------------------------------
# M7. end-to-end run over the catalog
# ---------------------------------------------------------------------------

E2E_SPECS = [fx.ORDERS_SPEC, fx.CUSTOMER_SPEC, fx.PART_SPEC, fx.SUPPLIER_SPEC, fx.LINEITEM_SPEC]


def _e2e(spark, sf):
    lake = work_dir(spark, "lake-e2e")
    zones = jobs.Zones.under(lake)
    jobs.write_executions(t(spark, sf, "orders"), f"{zones.raw}/orders", F.year("o_orderdate"))
    for name in ("customer", "part", "supplier", "lineitem"):
        jobs.write_executions(t(spark, sf, name), f"{zones.raw}/{name}", F.lit("0001"))
    dbs = {"raw": "lakeload_raw", "silver": "lakeload_silver_e2e", "gold": "lakeload_gold"}
    log, report = jobs.run_full_pipeline(spark, E2E_SPECS, [GOLD_CANDIDATE, GOLD_STATUS], zones, rules(spark), AS_OF, dbs)
    return log, report, dbs


SQL_LAST_ORDERS = "(SELECT * FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders))"


@query(
    "end_to_end_full_load",
    SQL_FULL_LOG
    + """
UNION ALL SELECT 'part', 'Table Sucessfull Loaded', count(*), count(*) FROM part
UNION ALL SELECT 'supplier', 'Table Sucessfull Loaded', count(*), count(*) FROM supplier
UNION ALL SELECT 'lineitem', 'Table Sucessfull Loaded', count(*), count(*) FROM lineitem
UNION ALL SELECT 'candidate_by_campaign', 'Table Sucessfull Loaded', count(*), count(*) FROM ("""
    + SQL_CANDIDATE
    + """) c
UNION ALL SELECT 'status_by_campaign', 'Table Sucessfull Loaded', count(*), count(*) FROM
  (SELECT o_orderstatus FROM """
    + SQL_LAST_ORDERS
    + """ o GROUP BY o_orderstatus) s""",
)
def end_to_end_full_load(spark, sf):
    """Databases, silver full load (catalog tables), data quality, gold: the log."""
    return _e2e(spark, sf)[0]


@query(
    "catalog_table_exists",
    """SELECT 'orders' AS TableName, true AS table_exists, count(*) AS regs FROM """
    + SQL_LAST_ORDERS
    + """ o
UNION ALL SELECT 'customer', true, count(*) FROM customer
UNION ALL SELECT 'part', true, count(*) FROM part
UNION ALL SELECT 'supplier', true, count(*) FROM supplier
UNION ALL SELECT 'lineitem', true, count(*) FROM lineitem
UNION ALL SELECT 'account', false, CAST(0 AS BIGINT)""",
)
def catalog_table_exists(spark, sf):
    """Existence (catalog lookup) and row count of each configured silver table."""
    _, _, dbs = _e2e(spark, sf)
    db = dbs["silver"]
    parts = []
    for name in [s.name for s in E2E_SPECS] + ["account"]:
        qn = f"{db}.{name}"
        if spark.catalog.tableExists(qn):
            parts.append(spark.table(qn).agg(F.lit(name).alias("TableName"), F.lit(True).alias("table_exists"), F.count(F.lit(1)).alias("regs")))
        else:
            parts.append(
                spark.createDataFrame([(name, False, 0)], "TableName string, table_exists boolean, regs bigint")
            )
    return gold.union_all(parts)


def _loaded_lake(spark, sf, name):
    """Silver orders fully loaded (the table before the change), change executions pending."""
    zones = jobs.Zones.under(work_dir(spark, name))
    spec = replace(fx.ORDERS_SPEC, path="orders_full", path_cdc="orders_cdc")
    jobs.write_executions(fx.orders_before(spark, sf), f"{zones.raw}/orders_full", F.lit("0001"))
    jobs.write_executions(fx.orders_batch(spark, sf), f"{zones.raw}/orders_cdc", F.year("o_orderdate"))
    jobs.full_load(spark, [spec], zones).collect()
    return zones, spec


@query("full_then_cdc", SQL_MERGE_CDC)
def full_then_cdc(spark, sf):
    """A full load, then the CDC job on the same silver table."""
    zones, spec = _loaded_lake(spark, sf, "lake-full-cdc")
    jobs.cdc_load(spark, [spec], zones, processed_at=PROCESSED_AT, collapse=True).collect()
    return zones.silver_table(spark, spec).read()


@query("end_to_end_cdc_load", ORACLE_SQL["gold_cdc_merge"])
def end_to_end_cdc_load(spark, sf):
    """Databases, CDC silver, data quality, CDC gold: the gold table from the catalog."""
    zones, spec = _loaded_lake(spark, sf, "lake-e2e-cdc")
    jobs.gold_full_load(spark, [GOLD_STATUS], {"orders": zones.silver_table(spark, spec).read()}, zones).collect()
    dbs = {"raw": "lakeload_raw", "silver": "lakeload_silver_e2e_cdc", "gold": "lakeload_gold_cdc"}
    jobs.run_cdc_pipeline(spark, [spec], [GOLD_STATUS], zones, rules(spark), AS_OF, dbs, processed_at=PROCESSED_AT, collapse=True)
    return spark.table("lakeload_gold_cdc.status_by_campaign")


# ---------------------------------------------------------------------------
# Partition-scoped merge (rewrites only the partitions a batch touches)
# ---------------------------------------------------------------------------


def _partitioned_merge(spark, sf):
    from lakeload.sinks.partitioned import merge_into_partitions

    path = work_dir(spark, "partitioned")
    year = F.year("o_orderdate").alias("o_year")
    fx.orders_before(spark, sf).select("*", year).write.partitionBy("o_year").parquet(path)
    batch = fx.orders_batch(spark, sf).select("*", year)
    m = merge_into_partitions(spark, path, ["o_year"], batch, ["o_orderkey", "o_year"], CDC)
    return path, m


@query(
    "merge_partition_scoped",
    f"SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM ({SQL_MERGE_CDC}) m",
)
def merge_partition_scoped(spark, sf):
    path, _ = _partitioned_merge(spark, sf)
    return spark.read.parquet(path).select(*fx.ORDERS_SPEC.fields, "o_year")


@query(
    "merge_partition_scoped_metrics",
    f"SELECT num_inserted_rows, num_updated_rows, num_deleted_rows FROM ({SQL_MERGE_CDC_METRICS}) m",
)
def merge_partition_scoped_metrics(spark, sf):
    _, m = _partitioned_merge(spark, sf)
    row = [(m["num_inserted_rows"], m["num_updated_rows"], m["num_deleted_rows"])]
    return spark.createDataFrame(row, "num_inserted_rows bigint, num_updated_rows bigint, num_deleted_rows bigint")


# ---------------------------------------------------------------------------
# M6. loader with rollback, L2. named SQL registry
# ---------------------------------------------------------------------------


@query(
    "load_with_rollback",
    f"SELECT {ORDERS_COLS}, DATE '{AS_OF}' AS ts_load, 4 AS table_version FROM orders",
)
def load_with_rollback(spark, sf):
    """A good load (version 1); a load whose strict cast fails (its partial folder,
    version 2, is never visible); a load committed as version 3 that fails its
    validation gate: version 1 is re-committed as version 4."""
    zones = jobs.Zones.under(work_dir(spark, "lake-rollback"))
    jobs.write_executions(t(spark, sf, "orders"), f"{zones.raw}/orders", F.year("o_orderdate"))
    jobs.load_with_rollback(spark, [fx.ORDERS_SPEC], zones, AS_OF).collect()
    broken = TableSpec("orders", {**fx.ORDERS_SPEC.fields, "o_orderpriority": "int"}, keys=fx.ORDERS_SPEC.keys)
    jobs.load_with_rollback(spark, [broken], zones, AS_OF).collect()

    def only_final_orders(df):  # a gate this load fails: open orders are present
        return df.filter(F.col("o_orderstatus") != "F").isEmpty()

    log = jobs.load_with_rollback(spark, [fx.ORDERS_SPEC], zones, AS_OF, validate=only_final_orders).first()
    table = zones.silver_table(spark, fx.ORDERS_SPEC)
    return table.read().withColumn("table_version", F.lit(int(log["table_version"])))


BILLING_SQL_TEXT = """
SELECT c.c_name, c.c_mktsegment,
       CAST(sum(CAST(l.l_quantity AS DECIMAL(18,2)) * CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS billing,
       CAST(sum(CAST(l.l_discount AS DECIMAL(18,2))) AS DOUBLE) AS discount
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_name, c.c_mktsegment ORDER BY c.c_name, c.c_mktsegment"""


@query("named_sql_billing", SQL_BILLING)
def named_sql_billing(spark, sf):
    """The billing query as configured SQL text, run over temp views."""
    from lakeload.plans.sql_registry import NamedQuery, run_named

    q = NamedQuery("billing_for_each_customer", BILLING_SQL_TEXT, ("orders", "lineitem", "customer"))
    return run_named(spark, q, _tables(spark, sf, "orders", "lineitem", "customer"))


ORDERS_BY_YEAR = TableSpec(
    "orders",
    {**fx.ORDERS_SPEC.fields, "o_year": "int"},
    keys=("o_orderkey", "o_year"),
    partition_by=("o_year",),
    load_type=CDC,
)


@query(
    "cdc_load_partitioned",
    f"SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM ({SQL_MERGE_CDC}) m",
)
def cdc_load_partitioned(spark, sf):
    """The CDC job on a table partitioned by order year: every execution rewrites
    only the year partitions it touches."""
    lake = work_dir(spark, "lake-cdc-part")
    zones = jobs.Zones.under(lake)
    year = F.year("o_orderdate").alias("o_year")
    batch = fx.orders_batch(spark, sf).select("*", year)
    jobs.write_executions(batch, f"{zones.raw}/orders", F.col("o_year"))
    fx.orders_before(spark, sf).select("*", year).write.partitionBy("o_year").parquet(jobs.partitioned_path(zones, ORDERS_BY_YEAR))
    jobs.cdc_load(spark, [ORDERS_BY_YEAR], zones, processed_at=PROCESSED_AT, layout="partitioned").collect()
    return spark.read.parquet(jobs.partitioned_path(zones, ORDERS_BY_YEAR)).select(*ORDERS_BY_YEAR.fields)


# ---------------------------------------------------------------------------
# The CDC job in FULL mode, with the test log's read counts
# ---------------------------------------------------------------------------

SQL_CUSTOMER_BATCH = """customer_batch AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1.0 AS c_acctbal, c_mktsegment,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_acctbal < 0 END AS IsDeleted
  FROM customer)"""


def customer_batch(spark, sf):
    c = t(spark, sf, "customer")
    flag = F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None).cast("boolean")).otherwise(F.col("c_acctbal") < 0)
    return c.select(
        "c_custkey", "c_name", "c_nationkey", (F.col("c_acctbal") + F.lit(1.0)).alias("c_acctbal"), "c_mktsegment",
        flag.alias("IsDeleted"),
    )


def _full_mode_lake(spark, sf):
    """customer (FULL load type) loaded whole, then one batch applied by the CDC job."""
    zones = jobs.Zones.under(work_dir(spark, "lake-full-mode"))
    jobs.write_executions(customer_batch(spark, sf), f"{zones.raw}/customer", F.lit("0001"))
    zones.silver_table(spark, fx.CUSTOMER_SPEC).commit(t(spark, sf, "customer"))
    log = jobs.cdc_load(spark, [fx.CUSTOMER_SPEC], zones, processed_at=PROCESSED_AT, with_read_counts=True)
    return zones, log


@query(
    "cdc_load_full_mode",
    f"""WITH {SQL_CUSTOMER_BATCH}
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer_batch WHERE IsDeleted = false""",
)
def cdc_load_full_mode(spark, sf):
    """FULL semantics through the job: every matched row is replaced, so rows with
    a null flag are lost and rows flagged deleted are removed."""
    zones, log = _full_mode_lake(spark, sf)
    log.collect()
    return zones.silver_table(spark, fx.CUSTOMER_SPEC).read()


@query(
    "load_log_cdc_test",
    f"""WITH {SQL_CUSTOMER_BATCH}
    SELECT 'customer' AS TableName, 'Table Sucessfull Loaded' AS Status,
           count(*) FILTER (WHERE IsDeleted = false) AS num_inserted_rows,
           CAST(0 AS BIGINT) AS num_updated_rows,
           count(*) AS num_deleted_rows,
           count(*) FILTER (WHERE IsDeleted) AS num_read_deleted_regs,
           count(*) FILTER (WHERE IsDeleted = false) AS num_read_upsert_regs
    FROM customer_batch""",
)
def load_log_cdc_test(spark, sf):
    """The CDC test log: merge counts plus the batch's read counts per flag."""
    return _full_mode_lake(spark, sf)[1]


# ---------------------------------------------------------------------------
# Incremental forms: bucketed layout, feed out of the merge, delta views, heavy keys
# ---------------------------------------------------------------------------


@query("cdc_load_bucketed", SQL_MERGE_CDC)
def cdc_load_bucketed(spark, sf):
    """The CDC job on a table in hash buckets of its key: every execution rewrites only
    the buckets its keys fall into."""
    zones = jobs.Zones.under(work_dir(spark, "lake-cdc-buckets"))
    jobs.write_executions(fx.orders_batch(spark, sf), f"{zones.raw}/orders", F.year("o_orderdate"))
    table = jobs.bucketed_table(spark, zones, fx.ORDERS_SPEC)
    table.create(cast_projection(fx.orders_before(spark, sf), fx.ORDERS_SPEC), buckets=16)
    jobs.cdc_load(spark, [fx.ORDERS_SPEC], zones, processed_at=PROCESSED_AT, layout="bucketed", collapse=True).collect()
    return table.read()


@query("change_feed_from_merge", SQL_CHANGE_FEED)
def change_feed_from_merge(spark, sf):
    """The feed of the merge itself: table and feed from one staged write, no snapshot compared."""
    _, feed, _ = jobs.apply_with_feed(spark, fx.orders_before(spark, sf), fx.orders_batch(spark, sf), ["o_orderkey"], work_dir(spark, "feed"))
    return feed


@query("gold_status_incremental", SQL_AFTER_STATUS)
def gold_status_incremental(spark, sf):
    """Status counts of the table before the change, kept up by the signed rows of the merge's feed."""
    before = fx.orders_before(spark, sf)
    _, feed, _ = jobs.apply_with_feed(spark, before, fx.orders_batch(spark, sf), ["o_orderkey"], work_dir(spark, "feed-status"))
    counts = gold.status_count(before, "o_orderstatus")
    return gold.apply_count_delta(counts, gold.status_delta(feed, "o_orderstatus"))


_GOLD_CANDIDATE_COLUMNS = dict(
    cand_id="p_partkey", cand_name="p_name", cand_company="p_brand", lead_id="l_partkey", campaign_id="l_suppkey",
    bridge_status="l_returnflag", camp_id="s_suppkey", camp_name="s_name", camp_start=None, camp_end=None,
)


@query(
    "gold_candidate_incremental",
    """WITH s AS (SELECT s_suppkey, s_name || ' renamed' AS s_name FROM supplier WHERE s_acctbal >= 0),
    l AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01')
    SELECT p.p_partkey AS LeadId, s.s_suppkey AS CampaignId, p.p_name AS Candidate, p.p_brand AS Company, l.l_returnflag AS Status,
           s.s_name AS Campaign, CAST(NULL AS DATE) AS StartDateCampaign, CAST(NULL AS DATE) AS EndDateCampaign
    FROM part p JOIN l ON p.p_partkey = l.l_partkey JOIN s ON l.l_suppkey = s.s_suppkey""",
)
def gold_candidate_incremental(spark, sf):
    """The bridge join kept up by delta joins: old line items leave and new ones come (feed of
    two snapshots), suppliers are renamed or deleted by a merge (its own feed)."""
    day = [F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "2001-01-01")]
    items, parts, supplier = t(spark, sf, "lineitem"), t(spark, sf, "part"), t(spark, sf, "supplier")
    old_items, new_items = items.filter(F.col("l_shipdate") < day[1]), items.filter(F.col("l_shipdate") >= day[0])
    batch = supplier.withColumn("s_name", F.concat("s_name", F.lit(" renamed"))).withColumn("IsDeleted", F.col("s_acctbal") < 0)
    new_supplier, supplier_feed, _ = jobs.apply_with_feed(spark, supplier, batch, ["s_suppkey"], work_dir(spark, "feed-supplier"))
    bridge = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]
    item_feed = cf.change_feed(old_items.select(*bridge), new_items.select(*bridge), ["l_orderkey", "l_linenumber"])
    old = {"candidate": parts, "bridge": old_items, "campaign": supplier}
    new = {"candidate": parts, "bridge": new_items, "campaign": new_supplier}
    view = gold.candidate_by_campaign(**old, **_GOLD_CANDIDATE_COLUMNS)
    delta = gold.candidate_delta(old, new, {"bridge": item_feed, "campaign": supplier_feed}, **_GOLD_CANDIDATE_COLUMNS)
    return gold.apply_row_delta(view, delta, ["LeadId", "CampaignId"])


@query(
    "merge_hot_key",
    f"""WITH {fx.SQL_HOT_EVENTS},
    s AS (SELECT event_id, ts, user_id, event_type, -value AS value, user_id > 0 AND user_id % 5 = 0 AS IsDeleted FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM hot_events) x WHERE rn = 1 AND event_type <> 'view')
    SELECT t.* FROM hot_events t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.user_id = t.user_id)
    UNION ALL SELECT s.event_id, s.ts, s.user_id, s.event_type, s.value FROM s JOIN hot_events t ON s.user_id = t.user_id WHERE NOT s.IsDeleted""",
)
def merge_hot_key(spark, sf):
    """Nine of ten target rows have one key: its rows are dealt over many tasks, only its source row is repeated."""
    target = fx.hot_events(spark, sf)
    last = latest_per_key(target, ["user_id"], ["ts", "event_id"]).filter("event_type <> 'view'")
    batch = last.withColumn("value", -F.col("value")).withColumn("IsDeleted", (F.col("user_id") > 0) & (F.col("user_id") % 5 == 0))
    return merge(target, batch, ["user_id"], CDC, small_source=False, heavy=heavy_keys(target, ["user_id"])).rows()


@query(
    "merge_delete_reinsert",
    f"""{PAIR}, s AS (SELECT *, o_orderkey IN (SELECT o_orderkey FROM orders_batch WHERE IsDeleted) AS gone FROM orders_batch)
    SELECT t.* FROM orders_before t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
    UNION ALL SELECT {ORDERS_COLS} FROM s WHERE (NOT gone AND EXISTS (SELECT 1 FROM orders_before t WHERE t.o_orderkey = s.o_orderkey))
      OR (NOT gone AND IsDeleted = false AND NOT EXISTS (SELECT 1 FROM orders_before t WHERE t.o_orderkey = s.o_orderkey))
    UNION ALL SELECT o_orderkey, o_custkey, 'new', o_totalprice, o_orderdate, o_orderpriority FROM s WHERE gone""",
)
def merge_delete_reinsert(spark, sf):
    """Every deleted order comes again in the same batch, as a new row: delete first, then insert."""
    batch = fx.orders_batch(spark, sf)
    again = batch.filter("IsDeleted").withColumn("o_orderstatus", F.lit("new")).withColumn("IsDeleted", F.lit(False))
    return merge(fx.orders_before(spark, sf), batch.unionByName(again), ["o_orderkey"], CDC, small_source=False).rows()


@query(
    "load_reconcile_files",
    """SELECT 'orders' AS TableName, (SELECT count(*) FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)) AS Rows_Readed,
              (SELECT count(*) FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)) AS Rows_Written, true AS ok
       UNION ALL SELECT 'customer', count(*), count(*), true FROM customer""",
)
def load_reconcile_files(spark, sf):
    """Rows read and written by the full load, both counted in the files' footers."""
    zones, log = _full_lake(spark, sf)
    log.collect()
    return jobs.load_reconcile_files(spark, [fx.ORDERS_SPEC, fx.CUSTOMER_SPEC], zones)


@query(
    "cdc_pending_files",
    f"""WITH {fx.SQL_ORDERS_CHANGES} SELECT {ORDERS_COLS}, IsDeleted, CAST(year(o_orderdate) AS VARCHAR) AS execution_id
        FROM orders_changes WHERE o_orderpriority = '1-URGENT' OR year(o_orderdate) >= 1998""",
)
def cdc_pending_files(spark, sf):
    """The files of the years before 1998 are booked; urgent orders then arrive late in every folder."""
    root = f"{work_dir(spark, 'raw-files')}/orders"
    rows = fx.orders_changes(spark, sf).withColumn("exec", F.year("o_orderdate").cast("string"))
    late = F.col("o_orderpriority") == "1-URGENT"
    rows.filter(~F.coalesce(late, F.lit(False))).write.partitionBy("exec").parquet(root)
    ledger = FileLedger(spark, f"{root}/../_files")
    _, paths = ledger.scan(root, "orders")
    ledger.record(root, "orders", [p for p in paths if p.split("exec=")[1][:4] < "1998"])
    rows.filter(late).write.mode("append").partitionBy("exec").parquet(root)
    pending, _ = ledger.scan(root, "orders")
    return pending.select(*fx.ORDERS_SPEC.fields, "IsDeleted", EXECUTION_COL)


@query("stream_cdc_out_of_order", ORACLE_SQL["merge_multi_batch"])
def stream_cdc_out_of_order(spark, sf):
    """The weekly batches of ``merge_multi_batch`` arrive last week first, a file a micro-batch;
    older executions never overwrite newer ones."""
    e = t(spark, sf, "events").select(
        *EVENTS_BY_USER.fields, (F.col("event_type") == "error").alias("IsDeleted"),
        F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("week"),
    )
    root = work_dir(spark, "stream-late")
    batches = latest_per_key(e, ["user_id", "week"], ["ts", "event_id"])
    weeks = sorted((r["week"] for r in batches.select("week").distinct().collect()), reverse=True)  # folder names
    states = VersionedTable(spark, f"{root}/states")
    for week in weeks:
        batches.filter(F.col("week") == week).drop("week").write.parquet(f"{root}/raw/exec={week}")
        stream_cdc_ordered(spark, f"{root}/raw", EVENTS_BY_USER, states, f"{root}/_checkpoint", archive_dir=f"{root}/archive")
    return current_rows(states.read(), EVENTS_BY_USER)


@query("dq_report_incremental", SQL_DQ_REPORT)
def dq_report_incremental(spark, sf):
    """The report from states of executions, added in two runs; the second reads new executions only."""
    root = work_dir(spark, "dq-states")
    parts = {"customer": "c_mktsegment", "orders": "o_orderpriority", "lineitem": "l_returnflag", "pages": None}
    states, roots = DqStates(spark, f"{root}/states"), {n: f"{root}/raw/{n}" for n in parts}
    for n, by in parts.items():
        rows = t(spark, sf, n)
        jobs.write_executions(rows, f"{roots[n]}", F.coalesce(F.col(by), F.lit("none")) if by else F.lit("all"))
    first = {n: roots[n] for n in ("customer", "orders")}
    jobs.dq_job_incremental(spark, first, rules(spark), AS_OF, states).collect()
    return jobs.dq_job_incremental(spark, roots, rules(spark), AS_OF, states)


# Rules of which each of the first four cannot run, for its own reason.
_BAD_RULES = [
    ("customer", "c_nope", "Unknown column", "Customer", "Validity", 1, "isComplete", None, None, None),
    ("customer", "c_name", "Text that is no number", "Customer", "Validity", 2, "satisfies", "cast(c_name AS int) > 0", 1, "yes"),
    ("customer", "c_name", "No such check", "Customer", "Validity", 3, "hasNoSuchCheck", None, None, None),
    ("customer", "c_acctbal", "Division by zero", "Customer", "Validity", 4, "satisfies", "1 / (c_custkey - c_custkey) > 0", 1, "yes"),
    ("customer", "c_name", "Text as a number", "Customer", "Validity", 5, "isNonNegative", None, None, None),
    ("customer", "c_name", "No card number", "Customer", "Privacy", 6, "containsCreditCardNumber", None, None, None),
    ("customer", "c_name", "No social security number", "Customer", "Privacy", 7, "containsSocialSecurityNumber", None, None, None),
    ("lineitem", "l_orderkey", "Order and line are the key", "Lineitem", "Uniqueness", 1, "isPrimaryKey", "[l_linenumber]", None, None),
]


@query(
    "dq_report_bad_rule",
    f"""WITH c AS (SELECT count(*) AS n FROM customer), l AS (SELECT count(*) AS n FROM lineitem),
    u AS (SELECT count(*) FILTER (WHERE k = 1) AS n FROM (SELECT count(*) AS k FROM lineitem GROUP BY l_orderkey, l_linenumber) g),
    r AS (SELECT 'customer' AS tn, i AS k, CASE WHEN i = 5 THEN c.n ELSE 0 END AS ok, c.n AS total,
                 CASE WHEN i = 6 THEN (SELECT count(*) FILTER (WHERE regexp_matches(c_name, '{dqmod.CARD_PATTERN}')) FROM customer)
                      WHEN i = 7 THEN (SELECT count(*) FILTER (WHERE regexp_matches(c_name, '{dqmod.SSN_PATTERN}')) FROM customer) ELSE 0 END AS found
          FROM c, range(1, 8) x(i)
          UNION ALL SELECT 'lineitem', 1, u.n, l.n, 0 FROM u, l)
    SELECT tn AS "Table Name", CAST(k AS INTEGER) AS "Row Num", CASE WHEN ok + found = total THEN 'Success' ELSE 'Failure' END AS "Constraint Status",
           total AS "Total Rows", CAST(ok + found AS DOUBLE) / CAST(total AS DOUBLE) AS pass_fraction FROM r""",
)
def dq_report_bad_rule(spark, sf):
    """Rules that cannot run (unknown column or check, values that fail at run time) cost their own rows only."""
    tables = _tables(spark, sf, "customer", "lineitem")
    found = jobs.dq_results(spark, tables, spark.createDataFrame(_BAD_RULES, RULES_SCHEMA))
    return found.select("Table Name", "Row Num", "Constraint Status", "Total Rows", "pass_fraction")
