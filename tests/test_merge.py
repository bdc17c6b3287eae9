"""Merge truth table, null keys, multi-match, bootstrap, steps and a model check."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import Row

from lakeload.operators.merge import (
    bootstrap_target,
    delete_step,
    duplicate_keys,
    insert_step,
    latest_per_key,
    merge,
    update_step,
)

T_SCHEMA = "id int, v string"
S_SCHEMA = "id int, v string, IsDeleted boolean"


def rows(df):
    return sorted(((r["id"], r["v"]) for r in df.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))


def metrics(res):
    m = res.metrics().first()
    return (m["num_inserted_rows"], m["num_updated_rows"], m["num_deleted_rows"], m["num_dropped_rows"], m["num_kept_rows"])


@pytest.fixture(params=[True, False], ids=["broadcast", "shuffle"])
def small(request):
    return request.param


def frames(spark, target, source):
    return spark.createDataFrame(target, T_SCHEMA), spark.createDataFrame(source, S_SCHEMA)


def test_cdc_truth_table(spark, small):
    # keys: 1 kept, 2 deleted, 3 updated, 4 null flag -> updated, 5 inserted, 6/7 dropped
    t, s = frames(
        spark,
        [(1, "a"), (2, "b"), (3, "c"), (4, "d")],
        [(2, "B", True), (3, "C", False), (4, "D", None), (5, "E", False), (6, "F", True), (7, "G", None)],
    )
    res = merge(t, s, ["id"], "CDC", small_source=small)
    assert rows(res.rows()) == [(1, "a"), (3, "C"), (4, "D"), (5, "E")]
    assert metrics(res) == (1, 2, 1, 2, 1)


def test_full_truth_table(spark, small):
    t, s = frames(
        spark,
        [(1, "a"), (2, "b"), (3, "c"), (4, "d")],
        [(2, "B", True), (3, "C", False), (4, "D", None), (5, "E", False), (6, "F", True), (7, "G", None)],
    )
    res = merge(t, s, ["id"], "FULL", small_source=small)
    # FULL: every matched row deleted; false rows (re)inserted; null flag row is lost.
    assert rows(res.rows()) == [(1, "a"), (3, "C"), (5, "E")]
    ins, upd, dele, drop, keep = metrics(res)
    assert (ins, upd, dele, keep) == (2, 0, 3, 1)


def test_null_keys_never_match(spark, small):
    t, s = frames(spark, [(None, "t0"), (1, "a")], [(None, "n1", False), (None, "n2", True), (1, "A", False)])
    res = merge(t, s, ["id"], "CDC", small_source=small)
    # the null-key target row stays, the null-key false row is inserted (every run)
    assert rows(res.rows()) == [(None, "n1"), (None, "t0"), (1, "A")]
    assert metrics(res)[:3] == (1, 1, 0)


def test_multi_match_raises(spark, small):
    t, s = frames(spark, [(1, "a")], [(1, "x", False), (1, "y", False)])
    with pytest.raises(PySparkException):
        merge(t, s, ["id"], "CDC", small_source=small).rows().collect()


def test_delete_and_reinsert_of_one_key(spark, small):
    t, s = frames(spark, [(1, "a"), (2, "b")], [(1, "old", True), (1, "new", False), (1, "lost", None), (3, "x", True), (3, "y", False)])
    res = merge(t, s, ["id"], "CDC", small_source=small)
    assert rows(res.rows()) == [(1, "new"), (2, "b"), (3, "y")]
    assert metrics(res) == (2, 0, 1, 2, 1)


def test_two_deletes_of_one_row_raise(spark, small):
    t, s = frames(spark, [(1, "a")], [(1, "x", True), (1, "y", True)])
    with pytest.raises(PySparkException):
        merge(t, s, ["id"], "CDC", small_source=small).rows().collect()


def test_unmatched_duplicates_are_all_inserted(spark, small):
    t, s = frames(spark, [(1, "a")], [(2, "x", False), (2, "y", False)])
    res = merge(t, s, ["id"], "CDC", small_source=small)
    assert rows(res.rows()) == [(1, "a"), (2, "x"), (2, "y")]


def test_bootstrap_counts(spark):
    s = spark.createDataFrame([(1, "a", True), (2, "b", False), (3, "c", None)], S_SCHEMA)
    res = merge(bootstrap_target(s), s, ["id"], "CDC")
    assert metrics(res)[:3] == (0, 2, 1)
    res_full = merge(bootstrap_target(s), s, ["id"], "FULL")
    assert metrics(res_full)[0] == 1 and metrics(res_full)[2] == 3


def test_composite_keys(spark, small):
    t = spark.createDataFrame([(1, "x", "a"), (1, "y", "b")], "k1 int, k2 string, v string")
    s = spark.createDataFrame([(1, "y", "B", False), (1, "z", "C", False)], "k1 int, k2 string, v string, IsDeleted boolean")
    res = merge(t, s, ["k1", "k2"], "CDC", small_source=small)
    assert sorted(tuple(r) for r in res.rows().collect()) == [(1, "x", "a"), (1, "y", "B"), (1, "z", "C")]


def test_source_values_take_target_types(spark):
    t = spark.createDataFrame([(1, 10)], "id int, n bigint")
    s = spark.createDataFrame([("1", "42", False)], "id string, n string, IsDeleted boolean")
    out = merge(t, s, ["id"], "CDC").rows()
    assert out.schema == t.schema
    assert out.collect() == [Row(id=1, n=42)]


def test_steps(spark):
    t, s = frames(spark, [(1, "a"), (2, "b"), (3, "c")], [(2, "B", True), (3, "C", False), (4, "D", False)])
    assert rows(delete_step(t, s, ["id"])) == [(1, "a"), (3, "c")]
    assert rows(insert_step(t, s, ["id"])) == [(4, "D")]
    assert rows(update_step(t, s, ["id"])) == [(3, "C")]


def test_duplicate_keys_and_latest(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], T_SCHEMA)
    s = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "z", 1), (3, "w", 2), (None, "n", 1), (None, "m", 2)], "id int, v string, seq int")
    assert [tuple(r) for r in duplicate_keys(t, s, ["id"]).collect()] == [(1, 2)]
    latest = sorted(((r["id"], r["v"]) for r in latest_per_key(s, ["id"], ["seq"]).collect()), key=str)
    assert latest == sorted([(1, "y"), (3, "w"), (None, "n"), (None, "m")], key=str)


# Model check: the merge equals a dictionary model of the two-step MERGE.

keys = st.integers(min_value=0, max_value=6)
flags = st.sampled_from([True, False, None])


def model(target, source, mode):
    table = dict(target)
    matched = {k for k, _, _ in source if k in table}
    if mode == "FULL":
        for k in matched:
            del table[k]
    else:
        for k, v, f in source:
            if k in matched and f is True:
                table.pop(k, None)
    after_delete = set(table)
    out = dict(table)
    for k, v, f in source:
        if k in after_delete:
            out[k] = v
        elif f is False:
            out[k] = v
    return sorted(out.items(), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))


@settings(max_examples=15, deadline=None)
@given(
    target=st.dictionaries(keys, st.text("abc", min_size=1, max_size=2), max_size=5),
    source=st.dictionaries(keys, st.tuples(st.text("xyz", min_size=1, max_size=2), flags), max_size=5),
    mode=st.sampled_from(["CDC", "FULL"]),
)
def test_merge_matches_model(spark, target, source, mode):
    src = [(k, v, f) for k, (v, f) in source.items()]
    t = spark.createDataFrame(list(target.items()), T_SCHEMA)
    s = spark.createDataFrame(src, S_SCHEMA)
    got = rows(merge(t, s, ["id"], mode, small_source=True).rows())
    assert got == model(target.items(), src, mode)


def test_orders_pair_counts(spark):
    from lakeload.plans import fixtures as fx

    res = merge(fx.orders_before(spark, "/root/testdata/sf0.01"), fx.orders_batch(spark, "/root/testdata/sf0.01"), ["o_orderkey"], "CDC")
    ins, upd, dele, drop, keep = metrics(res)
    before = fx.orders_before(spark, "/root/testdata/sf0.01").count()
    batch = fx.orders_batch(spark, "/root/testdata/sf0.01").count()
    assert upd + dele + keep == before
    assert ins + upd + dele + drop == batch
    assert res.rows().count() == keep + upd + ins


# Collapsing ordered batches to a net change equals applying them one by one.

from lakeload.operators.merge import collapse_changes  # noqa: E402

ops = st.lists(st.tuples(keys, st.text("pq", min_size=1, max_size=2), flags), max_size=6)


@settings(max_examples=15, deadline=None)
@given(
    target=st.dictionaries(keys, st.text("abc", min_size=1, max_size=2), max_size=4),
    batches=st.lists(ops, min_size=1, max_size=3),
    mode=st.sampled_from(["CDC", "FULL"]),
)
def test_collapse_equals_fold(spark, target, batches, mode):
    # at most one row per key per batch (the contract of collapse_changes)
    batches = [list({k: (k, v, f) for k, v, f in b}.values()) for b in batches]
    state = sorted(target.items())
    for b in batches:
        state = model(state, b, mode)
    rows_ = [(k, v, f, i) for i, b in enumerate(batches) for k, v, f in b]
    all_batches = spark.createDataFrame(rows_, "id int, v string, IsDeleted boolean, b int")
    net = collapse_changes(all_batches, ["id"], ["b"], mode).drop("b")
    t = spark.createDataFrame(list(target.items()), T_SCHEMA)
    got = rows(merge(t, net, ["id"], mode, small_source=True).rows())
    assert got == state


@settings(max_examples=12, deadline=None)
@given(
    target=st.dictionaries(keys, st.text("abc", min_size=1, max_size=2), max_size=5),
    source=st.dictionaries(keys, st.tuples(st.text("xyz", min_size=1, max_size=2), flags), max_size=5),
)
def test_cdc_reapply_is_idempotent(spark, target, source):
    src = spark.createDataFrame([(k, v, f) for k, (v, f) in source.items()], S_SCHEMA)
    t = spark.createDataFrame(list(target.items()), T_SCHEMA)
    once = merge(t, src, ["id"], "CDC", small_source=True).rows()
    once_rows = rows(once)
    twice = merge(spark.createDataFrame(once_rows, T_SCHEMA), src, ["id"], "CDC", small_source=True).rows()
    assert rows(twice) == once_rows


from lakeload.operators import change_feed as cf  # noqa: E402

maybe_keys = st.one_of(st.none(), st.integers(min_value=0, max_value=4))
row_lists = st.lists(st.tuples(maybe_keys, st.sampled_from(["a", "b", "c"])), max_size=7)


@settings(max_examples=12, deadline=None)
@given(before=row_lists, after=row_lists)
def test_change_feed_applies_back(spark, before, after):
    b = spark.createDataFrame(before, T_SCHEMA)
    a = spark.createDataFrame(after, T_SCHEMA)
    feed = cf.change_feed(b, a, ["id"])
    assert rows(cf.apply_change_feed(b, feed, ["id"])) == rows(a)
    kinds = [r[cf.CHANGE_TYPE] for r in feed.collect()]
    assert kinds.count(cf.PRE) == kinds.count(cf.POST)


def test_skewed_inputs_shuffle_plan(spark):
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # target: 3000 keyed rows + 1500 rows with a null key (a third of the table)
        t = spark.range(3000).select(F.col("id").cast("int").alias("id"), F.lit("t").alias("v")).unionByName(
            spark.range(1500).select(F.lit(None).cast("int").alias("id"), F.col("id").cast("string").alias("v"))
        )
        # source: one hot unmatched key holding a third of the rows, plus updates
        s = spark.range(1000).select(F.lit(99999).alias("id"), F.col("id").cast("string").alias("v"), F.lit(False).alias("IsDeleted")).unionByName(
            spark.range(2000).select(F.col("id").cast("int").alias("id"), F.lit("u").alias("v"), F.lit(False).alias("IsDeleted"))
        )
        res = merge(t, s, ["id"], "CDC", small_source=False)
        m = res.metrics().first()
        assert (m["num_inserted_rows"], m["num_updated_rows"], m["num_kept_rows"]) == (1000, 2000, 2500)
        out = res.rows()
        assert out.count() == 5500
        assert out.filter(F.col("id").isNull()).count() == 1500
        assert out.filter(F.col("id") == 99999).count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
