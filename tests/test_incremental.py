"""Incremental forms: bucketed layout, feed out of the merge, delta views, heavy keys, file ledger, ordered stream, DQ states."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from lakeload.operators import change_feed as cf
from lakeload.operators import dq, gold
from lakeload.operators.dq_states import DqStates
from lakeload.operators.merge import HeavyKeys, heavy_keys, merge
from lakeload.plans import catalog, jobs
from lakeload.session import work_dir
from lakeload.sinks import VersionedTable
from lakeload.sinks.bucketed import BUCKET, BucketedTable
from lakeload.sinks.ledger import FileLedger
from lakeload.sinks.partitioned import merge_into_partitions
from lakeload.sources import RULES_SCHEMA
from lakeload.sources.files import _fs, path_exists
from lakeload.specs import EXECUTION, TableSpec
from lakeload.streaming.cdc import current_rows, key_states, stream_cdc_ordered

SPEC = TableSpec("t", {"id": "bigint", "v": "string"}, keys=("id",), load_type="CDC")
BATCH = "id bigint, v string, IsDeleted boolean"


def _files(spark, path):
    """Every data file below a folder with its time."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return {(r["path"], r["modificationTime"]) for r in rows.select("path", "modificationTime").collect()}


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_bucketed_load_keeps_files_of_untouched_buckets(spark, tmp_root):
    table = BucketedTable(spark, f"{tmp_root}/t", SPEC)
    table.create(spark.range(1000).selectExpr("id", "'old' AS v"), buckets=8)
    before = _files(spark, f"{tmp_root}/t")
    m = table.apply(spark.createDataFrame([(1, "new", False), (2000, "in", False), (5, None, True)], BATCH), ["e1"])
    assert (m["num_inserted_rows"], m["num_updated_rows"], m["num_deleted_rows"]) == (1, 1, 1)
    after = _files(spark, f"{tmp_root}/t")
    touched = {f"{BUCKET}={b}/" for b in m["buckets"]}
    assert 0 < len(touched) < 8
    kept = {f for f in before if not any(t in f[0] for t in touched)}
    assert kept and kept <= after
    assert not {f for f in before - kept} & after
    got = dict(_rows(table.read()))
    assert len(got) == 1000 and got[1] == "new" and got[2000] == "in" and 5 not in got


def test_bucketed_emptied_bucket_and_second_reader(spark, tmp_root):
    table = BucketedTable(spark, f"{tmp_root}/t", SPEC)
    table.create(spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string"), buckets=64)
    table.apply(spark.createDataFrame([(1, None, True)], BATCH), ["e1"])
    assert _rows(BucketedTable(spark, f"{tmp_root}/t", SPEC).read()) == [(2, "b")]
    table.apply(spark.createDataFrame([], BATCH), ["e2"])
    assert _rows(table.read()) == [(2, "b")]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from("xyz"), st.sampled_from([True, False, None])), max_size=5, unique_by=lambda r: r[0] if r[0] is not None else id(r)), min_size=1, max_size=3))
def test_bucketed_equals_merge_and_replay_changes_nothing(spark, batches):
    root = work_dir(spark, "prop")
    table = BucketedTable(spark, f"{root}/t", SPEC)
    start = [(0, "a"), (1, "b"), (2, "c"), (None, "n")]
    table.create(spark.createDataFrame(start, "id bigint, v string"), buckets=3)
    want = spark.createDataFrame(start, "id bigint, v string")
    for i, rows in enumerate(batches):
        batch = spark.createDataFrame(rows, BATCH)
        want = spark.createDataFrame(merge(want, batch, ["id"], small_source=False).rows().collect(), "id bigint, v string")
        for _ in range(2):  # the second time is a replay
            table.apply(batch, [f"e{i}"], small_source=bool(i % 2))
        assert _rows(table.read()) == _rows(want)


@pytest.mark.parametrize("crash", ["before_plan", "before_moves", "between_moves"])
def test_bucketed_recovers_from_a_crash(spark, tmp_root, monkeypatch, crash):
    table = BucketedTable(spark, f"{tmp_root}/t", SPEC)
    table.create(spark.range(40).selectExpr("id", "'old' AS v"), buckets=4)
    batch = spark.createDataFrame([(i, "new", i % 5 == 0) for i in range(40)], BATCH)
    real = BucketedTable._move
    state = {"n": 0}

    def move(self, *a, **k):
        state["n"] += 1
        if crash == "before_moves" or state["n"] == 3:
            raise RuntimeError("crash")
        return real(self, *a, **k)

    if crash == "before_plan":
        monkeypatch.setattr(spark.__class__, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("crash")))
    else:
        monkeypatch.setattr(BucketedTable, "_move", move)
    with pytest.raises(RuntimeError):
        table.apply(batch, ["e1"], small_source=True)
    monkeypatch.undo()
    got = dict(_rows(BucketedTable(spark, f"{tmp_root}/t", SPEC).read()))
    if crash == "before_plan":
        assert got == {i: "old" for i in range(40)}
    else:
        assert got == {i: "new" for i in range(40) if i % 5}


def test_partitioned_replay_does_not_repeat_null_keys(spark, tmp_root):
    path = f"{tmp_root}/p"
    spark.createDataFrame([(1, "a", 1)], "id bigint, v string, p int").withColumn(EXECUTION, F.lit("e0")).write.partitionBy("p").parquet(path)
    batch = spark.createDataFrame([(None, "n", 1, False), (2, "b", 1, False), (None, "m", 2, False)], "id bigint, v string, p int, IsDeleted boolean")
    for _ in range(2):
        merge_into_partitions(spark, path, ["p"], batch, ["id", "p"], execution="e1")
    assert _rows(spark.read.parquet(path).select("id", "v")) == [(1, "a"), (2, "b"), (None, "m"), (None, "n")]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from("xy")), max_size=6),
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from("xy"), st.sampled_from([True, False, None])), max_size=5, unique_by=lambda r: r[0] if r[0] is not None else id(r)),
    st.sampled_from(["CDC", "FULL"]),
    st.booleans(),
)
def test_feed_of_merge_equals_feed_of_snapshots(spark, target, source, mode, small):
    before, batch = spark.createDataFrame(target, "id int, v string"), spark.createDataFrame(source, "id int, v string, IsDeleted boolean")
    res = merge(before, batch, ["id"], mode, small_source=small, images=True)
    got = cf.feed_of_merge(res.tagged, res.columns, ["id"])
    assert _rows(got) == _rows(cf.change_feed(before, res.rows(), ["id"]))


def test_feed_reads_the_staged_merge_only(spark, tmp_root):
    spark.range(100).selectExpr("id", "'a' AS v").write.parquet(f"{tmp_root}/t")
    spark.range(50, 120).selectExpr("id", "'b' AS v", "id % 2 = 0 AS IsDeleted").write.parquet(f"{tmp_root}/s")
    table, feed, m = jobs.apply_with_feed(spark, spark.read.parquet(f"{tmp_root}/t"), spark.read.parquet(f"{tmp_root}/s"), ["id"], f"{tmp_root}/w")
    assert (m["num_deleted_rows"], m["num_updated_rows"], m["num_inserted_rows"]) == (25, 25, 10)
    for df in (table, feed):
        assert all("/w/" in f for f in df.inputFiles())
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # changed rows and, in the join, their counts by key
    assert "PartitionFilters: [_action" in plan and "keep" not in plan.split("PartitionFilters")[1].split("]")[0]
    assert table.count() == 85


def test_incremental_status_counts_with_deletes_and_updates(spark, tmp_root):
    before = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "id int, s string")
    batch = spark.createDataFrame([(1, "b", False), (3, None, True), (4, "b", True), (5, None, False), (2, "c", None)], "id int, s string, IsDeleted boolean")
    table, feed, _ = jobs.apply_with_feed(spark, before, batch, ["id"], f"{tmp_root}/w")
    got = gold.apply_count_delta(gold.status_count(before, "s"), gold.status_delta(feed, "s"))
    assert _rows(got) == _rows(gold.status_count(table, "s"))
    assert {r["status"] for r in got.collect()} == {"b", "c", None}


def test_incremental_bridge_join_with_changes_on_all_sides(spark):
    r = random.Random(4)
    cols = dict(cand_id="cid", cand_name="cn", cand_company="co", lead_id="lid", campaign_id="kid", bridge_status="st", camp_id="id", camp_name="kn", camp_start=None, camp_end=None)
    schemas = {"candidate": "cid int, cn string, co string", "bridge": "b int, lid int, kid int, st string", "campaign": "id int, kn string"}

    def table(name, seed):
        q = random.Random(seed)
        if name == "bridge":
            return [(i, q.randint(0, 5), q.randint(0, 3), q.choice("pq")) for i in range(30) if q.random() > 0.3]
        if name == "candidate":
            return [(i, q.choice("ab"), "c") for i in range(6) if q.random() > 0.2]
        return [(i, q.choice("xy")) for i in range(4) if q.random() > 0.2]

    keys = {"candidate": ["cid"], "bridge": ["b"], "campaign": ["id"]}
    for _ in range(3):
        a, b = r.random(), r.random()
        old = {n: spark.createDataFrame(table(n, f"{a}{n}"), s) for n, s in schemas.items()}
        new = {n: spark.createDataFrame(table(n, f"{b}{n}"), s) for n, s in schemas.items()}
        feeds = {n: cf.change_feed(old[n], new[n], keys[n]) for n in schemas}
        view = gold.candidate_by_campaign(**old, **cols)
        got = gold.apply_row_delta(view, gold.candidate_delta(old, new, feeds, **cols), ["LeadId", "CampaignId"])
        assert _rows(got) == _rows(gold.candidate_by_campaign(**new, **cols))


def _hot(spark):
    rows = spark.range(20_000).selectExpr("CASE WHEN id % 10 < 9 THEN -1 ELSE id END AS k", "id AS v")
    batch = spark.range(20_000).filter("id % 10 = 9").selectExpr("id AS k", "-id AS v", "id % 3 = 0 AS IsDeleted")
    return rows, batch.unionByName(spark.createDataFrame([(-1, -7, False), (-9, 1, False)], "k bigint, v bigint, IsDeleted boolean"))


def test_heavy_key_is_dealt_over_tasks(spark):
    target, batch = _hot(spark)
    heavy = heavy_keys(target, ["k"], partitions=16)
    assert len(heavy.hashes) == 1 and heavy.salts >= 16
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)

        def largest(h):
            tagged = merge(target, batch, ["k"], small_source=False, heavy=h).tagged
            used = F.max(F.xxhash64("k", "v", "_action"))  # else the join is planned away
            sizes = sorted(r["n"] for r in tagged.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), used).collect())
            return sizes[-1] / sizes[len(sizes) // 2]

        assert largest(heavy) < 4 < largest(None)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_heavy_keys_do_not_change_the_result(spark):
    target, batch = _hot(spark)
    want = merge(target, batch, ["k"], small_source=False)
    for heavy in (heavy_keys(target, ["k"], partitions=16), HeavyKeys((1, 2, 3), 5)):
        got = merge(target, batch, ["k"], small_source=False, heavy=heavy)
        assert _rows(got.rows()) == _rows(want.rows())
        assert got.metrics().first() == want.metrics().first()
    assert heavy_keys(spark.range(0).selectExpr("id AS k"), ["k"]) == HeavyKeys()
    assert heavy_keys(spark.range(1000).selectExpr("id AS k"), ["k"], partitions=8) == HeavyKeys()


@pytest.mark.parametrize("nullable", [True, False])
def test_shuffle_merge_needs_four_shuffles_and_two_joins(spark, tmp_root, nullable):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target, batch = spark.range(100).selectExpr("id AS k", "id AS v"), spark.range(50, 150).selectExpr("id AS k", "-id AS v", "id % 3 = 0 AS IsDeleted")
        if nullable:
            target.write.parquet(f"{tmp_root}/t")
            batch.write.parquet(f"{tmp_root}/s")
            target, batch = spark.read.parquet(f"{tmp_root}/t"), spark.read.parquet(f"{tmp_root}/s")
        plan = merge(target, batch, ["k"], small_source=False).rows()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") <= 4
    assert plan.count("SortMergeJoin") == 2


def test_file_ledger_lists_late_and_changed_files_without_scanning_applied_ones(spark, tmp_root):
    root, ledger = f"{tmp_root}/raw", FileLedger(spark, f"{tmp_root}/files")
    assert ledger.scan(root, "t") == (None, [])
    for ex in ("1", "2"):
        spark.createDataFrame([(int(ex), "a")], "id int, v string").coalesce(1).write.parquet(f"{root}/exec={ex}")
    rows, paths = ledger.scan(root, "t")
    assert rows.count() == 2 and len(paths) == 2
    ledger.record(root, "t", paths)
    assert ledger.scan(root, "t") == (None, [])
    assert len(ledger.scan(root, "other")[1]) == 2
    spark.createDataFrame([(9, "late")], "id int, v string").coalesce(1).write.mode("append").parquet(f"{root}/exec=1")
    rows, late = ledger.scan(root, "t")
    assert [tuple(r) for r in rows.collect()] == [(9, "late", "1")]
    assert len(rows.inputFiles()) == 1 and not set(rows.inputFiles()) & set(paths)


def test_ordered_stream_over_several_micro_batches(spark, tmp_root):
    """Executions 3, 1, 2 arrive in this order; the table is that of 1, 2, 3."""
    batches = {
        "1": [(1, "a1", False), (2, "b1", False), (3, "c1", False), (None, "n1", False), (5, "e1", True)],
        "2": [(1, "a2", True), (2, "b2", None), (4, "d2", None), (5, "e2", False)],
        "3": [(1, "a3", None), (2, "b3", None), (3, "c3", True), (None, "n3", True)],
    }
    states = VersionedTable(spark, f"{tmp_root}/states")
    for ex in ("3", "1", "2"):
        spark.createDataFrame(batches[ex], BATCH).coalesce(1).write.parquet(f"{tmp_root}/raw/exec={ex}")
        stream_cdc_ordered(spark, f"{tmp_root}/raw", SPEC, states, f"{tmp_root}/_checkpoint", archive_dir=f"{tmp_root}/archive", max_files_per_trigger=1)
    got = _rows(current_rows(states.read(), SPEC))
    assert got == [(2, "b3"), (5, "e2"), (None, "n1")]
    n = len(states.versions())
    stream_cdc_ordered(spark, f"{tmp_root}/raw", SPEC, states, f"{tmp_root}/_checkpoint", archive_dir=f"{tmp_root}/archive")
    assert len(states.versions()) == n  # nothing new arrived
    assert path_exists(spark, f"{tmp_root}/archive")  # finished files have moved


def test_key_states_do_not_depend_on_order_or_repeats(spark):
    r = random.Random(2)
    rows = [(r.randint(0, 5), r.choice("xyz"), r.choice([True, False, None]), str(e), str(e)) for e in range(9)]
    schema = f"id bigint, v string, IsDeleted boolean, {EXECUTION} string, _flag_execution string"
    whole = key_states(spark.createDataFrame(rows, schema), SPEC)
    for _ in range(3):
        r.shuffle(rows)
        part = key_states(spark.createDataFrame(rows[:5], schema), SPEC)
        again = key_states(part.unionByName(spark.createDataFrame(rows, schema)), SPEC)
        assert _rows(again) == _rows(whole)


def _rules(spark, rows):
    return spark.createDataFrame(rows, RULES_SCHEMA)


def test_states_read_new_executions_only(spark, tmp_root):
    rules = _rules(spark, [
        ("t", "id", "", "", "", 1, "isUnique", None, None, None), ("t", "v", "", "", "", 2, "isComplete", None, None, None),
        ("t", "v", "", "", "", 3, "hasMaxLength", "lambda x: x <= 3", None, None), ("t", "id", "", "", "", 4, "isPrimaryKey", "[v]", None, None),
        ("t", "nope", "", "", "", 5, "isComplete", None, None, None), ("t", "w", "", "", "", 6, "isUnique", None, None, None),
    ])
    parts = [[(1, "abc", 0.0), (2, None, 1.0)], [(1, "abcd", -0.0), (None, "x", None), (None, None, None)]]
    schema = "id int, v string, w double"
    states, root = DqStates(spark, f"{tmp_root}/states"), f"{tmp_root}/raw"
    spark.createDataFrame(parts[0], schema).write.parquet(f"{root}/exec=1")
    jobs.dq_job_incremental(spark, {"t": root}, rules, "2024-01-31", states).collect()
    fs, gone = _fs(spark, f"{root}/exec=1")
    for f in fs.listStatus(gone):
        fs.delete(f.getPath(), True)  # the first execution can no longer be read
    spark.createDataFrame(parts[1], schema).write.parquet(f"{root}/exec=2")
    got = jobs.dq_job_incremental(spark, {"t": root}, rules, "2024-01-31", states)
    want = jobs.dq_job(spark, {"t": spark.createDataFrame(parts[0] + parts[1], schema)}, rules, "2024-01-31")
    assert _rows(got) == _rows(want)


def test_rules_that_fail_at_run_time_cost_their_own_row(spark):
    df = spark.createDataFrame([(1, "n/a"), (0, "4111 1111 1111 1111 and 078-05-1120")], "id int, v string")
    rules = _rules(spark, [
        ("t", "v", "", "", "", 1, "isNonNegative", None, None, None), ("t", "v", "", "", "", 2, "satisfies", "cast(v AS int) > 0", 1, "p"),
        ("t", "id", "", "", "", 3, "satisfies", "1 / id > 0", 1, "p"), ("t", "v", "", "", "", 4, "containsCreditCardNumber", None, None, None),
        ("t", "v", "", "", "", 5, "containsSocialSecurityNumber", None, None, None), ("u", "id", "", "", "", 1, "isPrimaryKey", None, None, None),
    ])
    got = {(r["Table Name"], r["Row Num"]): r for r in jobs.dq_results(spark, {"t": df, "u": df}, rules).collect()}
    assert [got[("t", k)]["pass_fraction"] for k in range(1, 6)] == [1.0, 0.0, 0.0, 0.5, 0.5]
    assert "CAST_INVALID_INPUT" in got[("t", 2)]["Constraint Message"] and "DIVIDE_BY_ZERO" in got[("t", 3)]["Constraint Message"]
    assert got[("u", 1)]["Constraint Status"] == dq.SUCCESS and got[("t", 2)]["Total Rows"] == 2


def test_reconciliation_sees_rows_lost_from_the_files(spark, tmp_root):
    zones = jobs.Zones.under(tmp_root)
    spec = TableSpec("t", {"id": "bigint"})
    spark.range(0, 500, 1, 4).write.parquet(f"{zones.raw}/t/exec=1")
    jobs.full_load(spark, [spec], zones).collect()
    assert [tuple(r) for r in jobs.load_reconcile_files(spark, [spec], zones).collect()] == [("t", 500, 500, True)]
    folder = zones.silver_table(spark, spec).path()
    fs, path = _fs(spark, folder)
    part = next(f.getPath() for f in fs.listStatus(path) if f.getPath().getName().startswith("part-"))
    fs.delete(part, False)
    assert not jobs.load_reconcile_files(spark, [spec], zones).first()["ok"]


def test_file_counts_come_from_footers(spark, tmp_root):
    spark.range(10).write.parquet(f"{tmp_root}/x")
    assert jobs.file_rows(spark, f"{tmp_root}/x") == 10
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = session.read.parquet(f"{tmp_root}/x").agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan


def test_whole_orders_feed_the_batch_queries(spark):
    n = spark.read.parquet(f"{SF001}/orders.parquet").count()
    assert catalog.cdc_archive_layout(spark, SF001).count() == n
