"""Uniqueness by hash first, exact decimal sums, stored load days."""

import random
from decimal import Decimal

import pytest

from lakeload.operators import dq, gold
from lakeload.operators.project import filter_load_date
from lakeload.operators.unique import possible_repeats, unique_metrics
from lakeload.session import work_dir


def _rule(attribute, *more):
    return dq.Rule(7, "isPrimaryKey" if more else "isUnique", attribute, "list", None, None, more)


def _rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("bits", [64, 6, 1])
@pytest.mark.parametrize("rule", [_rule("a"), _rule("a", "b"), _rule("b")])
def test_unique_metrics_with_forced_collisions(spark, bits, rule):
    r = random.Random(bits)
    rows = [(r.choice([None, *range(60)]), r.choice([None, "x", "y", ""])) for _ in range(80)] + [(1000 + i, f"v{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(4)
    assert _rows(unique_metrics(df, rule, bits=bits)) == _rows(dq.rule_metrics(df, [rule]))


def test_unique_metrics_of_unique_hot_null_and_empty_columns(spark):
    cases = [[(i,) for i in range(50)], [(3,)] * 40 + [(4,)], [(None,)] * 5, []]
    found = []
    for rows in cases:
        df = spark.createDataFrame(rows, "a int")
        found.append(_rows(unique_metrics(df, _rule("a"), bits=8)))
        assert found[-1] == _rows(dq.rule_metrics(df, [_rule("a")]))
    assert found[0] == [(7, 1.0, 1.0, True, 50)]


def test_unique_metrics_beyond_the_broadcast_bound(spark):
    df = spark.createDataFrame([(i // 2,) for i in range(40)], "a int")
    spark.conf.set("lakeload.broadcast.maxRows", "3")
    try:
        assert possible_repeats(df.toDF("__v")) is None
        assert _rows(unique_metrics(df, _rule("a"))) == _rows(dq.rule_metrics(df, [_rule("a")]))
    finally:
        spark.conf.unset("lakeload.broadcast.maxRows")


def test_only_possible_repeats_are_counted_by_value(spark):
    df = spark.createDataFrame([(f"value {i % 990}",) for i in range(1000)], "__v string")
    possible = possible_repeats(df)
    assert sorted({r[0] for r in possible.collect()}) == sorted(f"value {i}" for i in range(10)) and possible.count() == 20
    assert "SortMergeJoin" not in possible._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kinds", [("decimal(10,2)", "decimal(4,2)", "decimal(9,4)"), ("decimal(30,6)", "decimal(12,5)", "double"), ("double", "decimal(10,3)", "decimal(38,10)")])
def test_billing_sums_decimals_exactly(spark, kinds):
    r, places = random.Random(5), [int(k.rstrip(")").split(",")[1]) if "(" in k else 2 for k in kinds]
    rows = [(i % 6, *(Decimal(r.randint(0, 9999)).scaleb(-p) for p in places)) for i in range(200)]
    items = spark.createDataFrame([(o, *map(str, x)) for o, *x in rows], "o int, q string, p string, d string")
    items = items.selectExpr("o", *[f"cast({c} as {k}) {c}" for c, k in zip("qpd", kinds)])
    orders = spark.createDataFrame([(o, o % 2) for o in range(6)], "o int, c int")
    customers = spark.createDataFrame([(0, "a"), (1, "b")], "c int, name string")
    out = gold.billing_per_customer(
        orders, items, customers, order_id="o", order_customer="c", item_order="o", quantity="q", list_price="p",
        discount="d", customer_id="c", group_cols=["name"], order_cols=["name"],
    )
    for n, row in enumerate(out.collect()):
        mine = [x for x in rows if x[0] % 2 == n]
        assert row["billing"] == pytest.approx(float(sum(q * p for _, q, p, _ in mine)), rel=1e-15)
        assert row["discount"] == pytest.approx(float(sum(d for *_, d in mine)), rel=1e-15)


def test_stored_load_day_reaches_the_scan(spark):
    path = work_dir(spark, "stamped")
    spark.sql("SELECT id, date_add(date'2024-01-01', cast(id % 3 as int)) AS ts_load FROM range(9)").write.parquet(path)
    day = filter_load_date(spark.read.parquet(path), "2024-01-02")
    assert sorted(r["id"] for r in day.collect()) == [1, 4, 7]
    assert "EqualTo(ts_load,2024-01-02)" in day._jdf.queryExecution().executedPlan().toString()
