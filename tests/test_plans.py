"""Physical-plan properties that matter at scale (checked on the formatted plan)."""

from lakeload.functions import is_small
from lakeload.operators.merge import merge
from lakeload.plans import catalog
from lakeload.plans import fixtures as fx

from conftest import SF01


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffle_merge_partitions_on_key_and_salt(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        res = merge(fx.orders_before(spark, SF01), fx.orders_batch(spark, SF01), ["o_orderkey"], "CDC", small_source=False)
        p = plan(res.rows())
        assert "SortMergeJoin" in p and "FullOuter" not in p
        assert "__salt" in p.split("SortMergeJoin")[1].split("\n")[0]  # salt is a join key, not folded away
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_source_merge_never_shuffles_target(spark):
    res = merge(fx.orders_before(spark, SF01), fx.orders_batch(spark, SF01), ["o_orderkey"], "CDC", small_source=True)
    p = plan(res.rows())
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_shuffle_merge_broadcasts_nothing(spark):
    """Also not by adaptive execution, for which every side of this merge is small."""
    res = merge(fx.orders_before(spark, SF01), fx.orders_batch(spark, SF01), ["o_orderkey"], "CDC", small_source=False)
    rows = res.rows()
    assert len(rows.collect()) > 0
    p = plan(rows).split("Initial Plan")[0]
    assert p.count("SortMergeJoin") == 2 and "Broadcast" not in p


def test_billing_aggregates_before_joins_and_prunes_columns(spark):
    df = catalog.billing_for_each_customer(spark, SF01)
    df.write.format("noop").mode("overwrite").save()
    p = plan(df)
    # partial aggregation of line items happens before any exchange, on 4 columns
    assert "partial_sum" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double,l_discount:double>" in p or (
        "l_shipdate" not in p and "l_returnflag" not in p
    )


def test_dq_rules_of_a_table_share_one_scan(spark):
    df = catalog.dq_metrics(spark, SF01)
    p = plan(df)
    assert p.count("FileScan parquet") == 1


def test_size_check_has_no_global_limit(spark):
    df = fx.orders_batch(spark, SF01)
    assert is_small(df)
    assert not is_small(df, max_rows=10)
    assert not is_small(fx.table(spark, SF01, "lineitem"), max_bytes=1024)  # decided from file sizes, no job


def test_null_key_salt_spreads_rows(spark):
    from pyspark.sql import functions as F

    from lakeload.functions import null_key_salt

    df = spark.range(20000).select(F.lit(None).cast("int").alias("k"), F.col("id"))
    salts = df.select(null_key_salt(["k"], ["k", "id"]).alias("s")).agg(F.min("s"), F.max("s"), F.countDistinct("s")).first()
    assert salts[0] >= 1 and salts[1] <= 1024 and salts[2] > 900
    keyed = spark.range(10).select(F.col("id").cast("int").alias("k"))
    assert {r[0] for r in keyed.select(null_key_salt(["k"], ["k"])).collect()} == {0}


def test_scale_conf_sizes_partitions():
    from lakeload.session import scale_conf

    c = scale_conf(100 * 1024**4, 8000)
    n = int(c["spark.sql.shuffle.partitions"])
    assert n % 8000 == 0 and 100 * 1024**4 / n <= 256 * 1024**2
    assert int(scale_conf(10 * 1024**2, 8)["spark.sql.shuffle.partitions"]) == 8


def test_broadcast_bound_from_session(spark):
    df = fx.orders_batch(spark, SF01)
    spark.conf.set("lakeload.broadcast.maxRows", "10")
    try:
        assert not is_small(df)
    finally:
        spark.conf.unset("lakeload.broadcast.maxRows")
    assert is_small(df)
