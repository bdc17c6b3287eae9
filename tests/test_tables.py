"""Sources, sinks, snapshots, change feed, jobs and streaming."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakeload.operators import change_feed as cf
from lakeload.operators.merge import merge
from lakeload.operators.project import cast_projection, filter_load_date, load_stamp
from lakeload.plans import fixtures as fx
from lakeload.plans import jobs
from lakeload.sinks import Ledger, VersionedTable, replace_table
from lakeload.sources import EXECUTION_COL, list_dirs, path_exists, scan_executions, table_exists
from lakeload.specs import TableSpec
from lakeload.streaming.cdc import stream_cdc_apply

from conftest import SF001, SF01

SPEC = TableSpec("t", {"id": "int", "v": "string"}, keys=("id",))


def test_strict_and_lenient_cast(spark):
    df = spark.createDataFrame([("1", "2024-01-05"), ("abc", "2024-13-01"), ("", "x")], "a string, d string")
    spec = TableSpec("c", {"a": "int", "d": "date"})
    lenient = cast_projection(df, spec, lenient=True).collect()
    assert lenient[0]["a"] == 1 and lenient[1]["a"] is None and lenient[1]["d"] is None
    with pytest.raises(PySparkException):
        cast_projection(df, spec).collect()


def test_load_stamp_filter(spark):
    df = spark.range(5)
    stamped = load_stamp(df, "2024-01-31")
    assert filter_load_date(stamped, "2024-01-31").count() == 5
    assert filter_load_date(stamped, "2024-02-01").count() == 0


def test_execution_scan_and_listing(spark, tmp_root):
    orders = fx.table(spark, SF001, "orders")
    jobs.write_executions(orders, tmp_root, F.year("o_orderdate"))
    folders = list_dirs(spark, tmp_root)
    assert folders == sorted(folders) and all(f.startswith("exec=") for f in folders)
    counts = {r[EXECUTION_COL]: r["rows"] for r in jobs.execution_counts(spark, tmp_root).collect()}
    expected = {str(r[0]): r[1] for r in orders.groupBy(F.year("o_orderdate")).count().collect()}
    assert counts == expected
    assert scan_executions(spark, tmp_root).count() == orders.count()
    assert path_exists(spark, tmp_root) and not path_exists(spark, tmp_root + "/nope")


def test_versioned_table(spark, tmp_root):
    table = VersionedTable(spark, tmp_root)
    assert not table.exists()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    v1, m = table.commit(df)
    assert (v1, m["rows"]) == (1, 2)
    v2, _ = table.commit(df.filter("id = 1"))
    assert table.versions() == [1, 2]
    assert table.read().count() == 1 and table.read(1).count() == 2
    assert table.restore(1) == 3 and table.read().count() == 2
    assert table.history().groupBy("version").count().count() == 3
    # a version without its _SUCCESS marker is not visible
    df.write.parquet(f"{tmp_root}/version=9/_temporary_like")
    assert table.latest_version() == 3


def test_change_feed_roundtrip(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n"), (None, "n")], "id int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (None, "n"), (None, "m")], "id int, v string")
    feed = cf.change_feed(before, after, ["id"])
    kinds = sorted((r["id"] if r["id"] is not None else -1, r[cf.CHANGE_TYPE]) for r in feed.collect())
    assert kinds == [(-1, "delete"), (-1, "insert"), (2, "update_postimage"), (2, "update_preimage"), (3, "delete"), (4, "insert")]
    rebuilt = cf.apply_change_feed(before, feed, ["id"])
    assert sorted(map(tuple, rebuilt.collect()), key=str) == sorted(map(tuple, after.collect()), key=str)


def test_full_load_logs(spark, tmp_root):
    zones = jobs.Zones.under(tmp_root)
    jobs.write_executions(fx.table(spark, SF001, "orders"), f"{zones.raw}/orders", F.year("o_orderdate"))
    missing = TableSpec("account", {"Id": "string"})
    bad = TableSpec("bad", {"o_orderstatus": "int"}, path="orders")
    log = jobs.full_load(spark, [fx.ORDERS_SPEC, missing, bad], zones).collect()
    status = {(r["TableName"], r["Status"]) for r in log}
    assert ("account", jobs.STATUS_NO_DATA) in status
    assert ("bad", jobs.STATUS_ERROR) in status
    loaded = [r for r in log if r["TableName"] == "orders"]
    assert sum(r["Rows_Readed"] for r in loaded) == fx.table(spark, SF001, "orders").count()
    assert all(r["ok"] for r in jobs.load_reconcile(spark.createDataFrame(loaded)).collect())


def test_cdc_load_is_idempotent(spark, tmp_root):
    zones = jobs.Zones.under(tmp_root)
    jobs.write_executions(fx.orders_batch(spark, SF001), f"{zones.raw}/orders", F.year("o_orderdate"))
    log1 = jobs.cdc_load(spark, [fx.ORDERS_SPEC], zones, processed_at="2024-01-31 10:15:00").first()
    table = zones.silver_table(spark, fx.ORDERS_SPEC)
    v = table.latest_version()
    expected = fx.orders_batch(spark, SF001).filter("IsDeleted IS NOT TRUE AND year(o_orderdate) = 1997")
    rows_after = table.read().count()
    log2 = jobs.cdc_load(spark, [fx.ORDERS_SPEC], zones, processed_at="2024-01-31 10:16:00").first()
    assert table.latest_version() == v  # nothing re-applied
    assert table.read().count() == rows_after
    assert log1["Status"] == jobs.STATUS_LOADED and log2["num_inserted_rows"] == 0
    assert expected.count() <= rows_after
    ledger = Ledger(spark, f"{zones.meta}/ledger").read()
    assert ledger.count() == len(list_dirs(spark, f"{zones.raw}/orders"))
    assert path_exists(spark, f"{zones.raw}/_processed/orders")


def test_stream_equals_batch(spark, tmp_root):
    root = tmp_root
    jobs.write_executions(fx.orders_batch(spark, SF001), f"{root}/orders", F.year("o_orderdate"))
    table = VersionedTable(spark, f"{root}/silver")
    table.commit(fx.orders_before(spark, SF001))
    ledger = Ledger(spark, f"{root}/ledger")
    stream_cdc_apply(spark, f"{root}/orders", fx.ORDERS_SPEC, table, ledger, f"{root}/ckpt", max_files_per_trigger=2)
    got = sorted(map(tuple, table.read().collect()))
    want = sorted(map(tuple, merge(fx.orders_before(spark, SF001), fx.orders_batch(spark, SF001), ["o_orderkey"]).rows().collect()))
    assert got == want
    # a second run finds nothing new and leaves the table as it is
    v = table.latest_version()
    stream_cdc_apply(spark, f"{root}/orders", fx.ORDERS_SPEC, table, ledger, f"{root}/ckpt")
    assert table.latest_version() == v


def test_catalog_table_exists(spark, tmp_root):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lakeload_t LOCATION '{tmp_root}/db'")
    assert not table_exists(spark, "lakeload_t.orders")
    from lakeload.sinks import save_table

    save_table(fx.table(spark, SF001, "orders"), "lakeload_t.orders", f"{tmp_root}/orders")
    assert table_exists(spark, "lakeload_t.orders")
    assert replace_table(fx.table(spark, SF001, "orders"), f"{tmp_root}/copy") == fx.table(spark, SF001, "orders").count()


def test_partition_scoped_merge(spark, tmp_root):
    from lakeload.sinks.partitioned import merge_into_partitions

    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 3)], "id int, v string, p int")
    t.write.partitionBy("p").parquet(tmp_root)
    batch = spark.createDataFrame(
        [(1, "A", 1, False), (2, "B", 1, True), (3, "C", 2, True), (5, "E", 4, False)], "id int, v string, p int, IsDeleted boolean"
    )
    m = merge_into_partitions(spark, tmp_root, ["p"], batch, ["id", "p"])
    got = sorted((r["id"], r["v"], r["p"]) for r in spark.read.parquet(tmp_root).collect())
    assert got == [(1, "A", 1), (4, "d", 3), (5, "E", 4)]  # partition 2 emptied and removed, 3 untouched
    assert (m["num_inserted_rows"], m["num_updated_rows"], m["num_deleted_rows"]) == (1, 1, 2)
    assert not path_exists(spark, f"{tmp_root}/p=2")


def test_failed_write_does_not_block_next_version(spark, tmp_root):
    table = VersionedTable(spark, tmp_root)
    table.commit(spark.createDataFrame([(1, "a")], "id int, v string"))
    bad = spark.createDataFrame([("x",)], "s string").select(F.col("s").cast("int").alias("id"))
    with pytest.raises(Exception):
        table.commit(bad.select(F.raise_error(F.lit("boom")).alias("id")))
    v, _ = table.commit(spark.createDataFrame([(2, "b")], "id int, v string"))
    assert table.latest_version() == v and table.read().first()["id"] == 2
    assert table.restore(1) > v and table.read().first()["id"] == 1


def test_applied_batches_commit_with_the_version(spark, tmp_root):
    table = VersionedTable(spark, tmp_root)
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    table.commit(df, batch_ids=["e1", "e2"])
    assert table.applied_batches() == {"e1", "e2"}
    # a failed write records its ids first, but they never count
    with pytest.raises(Exception):
        table.commit(df.select(F.raise_error(F.lit("boom")).alias("id")), batch_ids=["e3"])
    assert table.applied_batches() == {"e1", "e2"}


def test_change_feed_duplicate_keys_never_pair(spark):
    before = spark.createDataFrame([(1, "a"), (1, "b"), (2, "x")], "id int, v string")
    after = spark.createDataFrame([(1, "a"), (1, "c"), (1, "d"), (2, "y")], "id int, v string")
    feed = cf.change_feed(before, after, ["id"])
    got = sorted((r["id"], r["v"], r[cf.CHANGE_TYPE]) for r in feed.collect())
    assert got == [(1, "b", "delete"), (1, "c", "insert"), (1, "d", "insert"), (2, "x", "update_preimage"), (2, "y", "update_postimage")]
    rebuilt = cf.apply_change_feed(before, feed, ["id"])
    assert sorted(map(tuple, rebuilt.collect())) == sorted(map(tuple, after.collect()))


def test_concurrent_commit_is_refused(spark, tmp_root):
    from lakeload.sinks.versioned import ConcurrentCommitError

    table = VersionedTable(spark, tmp_root)
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    base, _ = table.commit(df)
    table.commit(df)  # another writer got in first
    with pytest.raises(ConcurrentCommitError):
        table.commit(df, base_version=base)


def test_partitioned_replace_is_full_even_with_dynamic_default(spark, tmp_root):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, p string")
        replace_table(a, tmp_root, ["p"])
        replace_table(a.filter("p = 'x'"), tmp_root, ["p"])
        assert sorted(r["id"] for r in spark.read.parquet(tmp_root).collect()) == [1]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_full_load_validates_every_execution(spark, tmp_root):
    zones = jobs.Zones.under(tmp_root)
    good = spark.createDataFrame([("1", "a")], "id string, v string")
    bad = spark.createDataFrame([("x", "b")], "id string, v string")
    good.write.parquet(f"{zones.raw}/t/exec=2")       # the last execution is fine
    bad.write.parquet(f"{zones.raw}/t/exec=1")        # an earlier one holds a bad id
    spec = TableSpec("t", {"id": "int", "v": "string"})
    log = jobs.full_load(spark, [spec], zones).collect()
    assert [(r["TableName"], r["Status"]) for r in log] == [("t", jobs.STATUS_ERROR)]
    assert not zones.silver_table(spark, spec).exists()
    lenient = jobs.full_load(spark, [spec], zones, lenient=True).collect()
    assert [r["Rows_Readed"] for r in lenient] == [1, 1]


def test_gold_cdc_needs_existing_gold(spark, tmp_root):
    from lakeload.plans import catalog

    zones = jobs.Zones.under(tmp_root)
    orders = fx.table(spark, SF001, "orders")
    log = jobs.gold_cdc_load(spark, [catalog.GOLD_STATUS], {"orders": orders}, zones).collect()
    assert [(r["TableName"], r["Status"]) for r in log] == [("status_by_campaign", jobs.STATUS_ERROR)]
    jobs.gold_full_load(spark, [catalog.GOLD_STATUS], {"orders": orders}, zones).collect()
    log = jobs.gold_cdc_load(spark, [catalog.GOLD_STATUS], {"orders": orders}, zones).first()
    assert log["Status"] == jobs.STATUS_LOADED and log["num_updated_rows"] == 3 and log["num_inserted_rows"] == 0


def test_partitioned_cdc_layout_rerun_is_a_noop(spark, tmp_root):
    from lakeload.plans import catalog

    zones = jobs.Zones.under(tmp_root)
    batch = fx.orders_batch(spark, SF001).select("*", F.year("o_orderdate").alias("o_year"))
    jobs.write_executions(batch, f"{zones.raw}/orders", F.col("o_year"))
    spec = catalog.ORDERS_BY_YEAR
    jobs.cdc_load(spark, [spec], zones, layout="partitioned", archive=False).collect()
    path = jobs.partitioned_path(zones, spec)
    first = sorted(map(tuple, spark.read.parquet(path).select(*spec.fields).collect()))
    log = jobs.cdc_load(spark, [spec], zones, layout="partitioned", archive=False).first()
    assert (log["num_inserted_rows"], log["num_updated_rows"], log["num_deleted_rows"]) == (0, 0, 0)
    assert sorted(map(tuple, spark.read.parquet(path).select(*spec.fields).collect())) == first


def test_collapsed_stream_bootstrap_equals_batch_fold(spark, tmp_root):
    zones = jobs.Zones.under(f"{tmp_root}/batch")
    jobs.write_executions(fx.orders_batch(spark, SF001), f"{zones.raw}/orders", F.year("o_orderdate"))
    jobs.cdc_load(spark, [fx.ORDERS_SPEC], zones, archive=False).collect()
    want = sorted(map(tuple, zones.silver_table(spark, fx.ORDERS_SPEC).read().collect()))

    table = VersionedTable(spark, f"{tmp_root}/stream/silver")
    ledger = Ledger(spark, f"{tmp_root}/stream/ledger")
    stream_cdc_apply(spark, f"{zones.raw}/orders", fx.ORDERS_SPEC, table, ledger, f"{tmp_root}/stream/ckpt", collapse=True)
    assert sorted(map(tuple, table.read().collect())) == want


def test_execution_folder_names_are_decoded(spark, tmp_root):
    from lakeload.functions.sizing import input_bytes
    from lakeload.sources import scan_executions

    names = ["run 1", "a+b", "c%20d"]
    for n in names:
        spark.range(3).write.parquet(f"{tmp_root}/{n}")
    df = scan_executions(spark, tmp_root)
    assert {r["execution_id"] for r in df.select("execution_id").distinct().collect()} == set(names)
    assert input_bytes(df) > 0


def test_partition_merge_escaped_values_and_emptied_partitions(spark, tmp_root):
    from lakeload.sinks.partitioned import merge_into_partitions

    schema = "id int, p string"
    spark.createDataFrame([(1, "a:b"), (2, "01"), (3, "1"), (4, None)], schema).write.partitionBy("p").parquet(tmp_root)
    gone = spark.createDataFrame([(1, "a:b", True), (2, "01", True)], schema + ", IsDeleted boolean")
    m = merge_into_partitions(spark, tmp_root, ["p"], gone, ["id", "p"])
    assert m["num_deleted_rows"] == 2
    left = spark.read.schema(schema).parquet(tmp_root).collect()
    assert sorted((r["id"], r["p"]) for r in left) == [(3, "1"), (4, None)]


def test_first_load_that_fails_its_check_leaves_no_table(spark, tmp_root):
    zones = jobs.Zones.under(tmp_root)
    jobs.write_executions(spark.range(5).select("id", F.lit("a").alias("v")), f"{zones.raw}/t", F.lit("1"))
    spec = TableSpec("t", {"id": "bigint", "v": "string"}, keys=("id",))
    log = jobs.load_with_rollback(spark, [spec], zones, "2024-01-31", validate=lambda df: False).first()
    assert log["Status"] == jobs.STATUS_ROLLED_BACK and not zones.silver_table(spark, spec).exists()


def test_collapse_with_repeated_keys_equals_fold(spark, tmp_root):
    rows = "id int, v string, IsDeleted boolean, e string"
    batch = spark.createDataFrame([(1, "x", False, "1"), (1, "y", False, "1"), (2, "z", False, "2")], rows)
    got = []
    for collapse in (False, True):
        zones = jobs.Zones.under(f"{tmp_root}/{collapse}")
        jobs.write_executions(batch, f"{zones.raw}/t", F.col("e"))
        zones.silver_table(spark, SPEC).commit(spark.createDataFrame([(9, "old")], "id int, v string"))
        jobs.cdc_load(spark, [SPEC], zones, collapse=collapse, archive=False).collect()
        got.append(sorted(map(tuple, zones.silver_table(spark, SPEC).read().collect())))
    assert got[0] == got[1] == [(1, "x"), (1, "y"), (2, "z"), (9, "old")]


def test_stream_keeps_late_files_of_an_execution(spark, tmp_root):
    schema = "id int, v string, IsDeleted boolean"
    table, ledger = VersionedTable(spark, f"{tmp_root}/silver"), Ledger(spark, f"{tmp_root}/ledger")
    table.commit(spark.createDataFrame([(0, "old")], "id int, v string"))
    for i in (1, 2):
        spark.createDataFrame([(i, "new", False)], schema).write.mode("append").parquet(f"{tmp_root}/raw/exec=1")
        stream_cdc_apply(spark, f"{tmp_root}/raw", SPEC, table, ledger, f"{tmp_root}/ckpt", max_files_per_trigger=1)
    assert sorted(r["id"] for r in table.read().collect()) == [0, 1, 2]
