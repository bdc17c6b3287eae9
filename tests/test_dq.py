"""Rule parsing, per-rule metrics, report arithmetic and impact classes."""

import pytest
from pyspark.sql import functions as F

from lakeload.operators import dq
from lakeload.plans import catalog, jobs
from lakeload.sources import RULES_SCHEMA

from conftest import SF01


def rule_rows(spark, rows):
    return spark.createDataFrame(rows, RULES_SCHEMA)


def test_parse_rules_shapes(spark):
    rules = rule_rows(
        spark,
        [
            ("t", " a ", "d", "D", "X", 1, "isComplete", None, None, None),
            ("t", "a", "d", "D", "X", 2, "isContainedIn", "[x, y,z]", None, None),
            ("t", "a", "d", "D", "X", 3, "hasMaxLength", "lambda x: x <= 3", None, None),
            ("t", "a", "d", "D", "X", 4, "satisfies", "a > 0", 1, "p"),
            ("t", "a", "d", "D", "X", 5, "hasDataType", "Boolean", None, None),
            ("t", "a", "d", "D", "X", 6, "hasPattern", "^a", None, None),
        ],
    )
    p = {r["Key"]: r for r in dq.parse_rules(rules).collect()}
    assert p[1]["attribute"] == "a"
    assert [p[k]["rule_kind"] for k in range(1, 7)] == [
        dq.KIND_COLUMN, dq.KIND_LIST, dq.KIND_ASSERTION, dq.KIND_SATISFIES, dq.KIND_DATATYPE, dq.KIND_ARGUMENT,
    ]
    assert p[2]["list_values"] == ["x", " y", "z"]  # blanks kept, as configured
    trimmed = {r["Key"]: r for r in dq.parse_rules(rules, trim_items=True).collect()}
    assert trimmed[2]["list_values"] == ["x", "y", "z"]


def test_metrics_on_small_frame(spark):
    df = spark.createDataFrame(
        [(1, -1.0, "abc", "x"), (2, 2.0, None, "q"), (None, None, "abcd", "y")], "id int, bal double, name string, seg string"
    )
    rules = rule_rows(
        spark,
        [
            ("t", "id", "", "", "", 1, "isComplete", None, None, None),
            ("t", "bal", "", "", "", 2, "isNonNegative", None, None, None),
            ("t", "seg", "", "", "", 3, "isContainedIn", "[x,y]", None, None),
            ("t", "name", "", "", "", 4, "hasMaxLength", "lambda x: x <= 3", None, None),
            ("t", "id", "", "", "", 5, "isUnique", None, None, None),
            ("t", "bal", "", "", "", 6, "satisfies", "bal > 0", 0, "p"),
        ],
    )
    res = {r["Row Num"]: r for r in dq.results_frame(dq.check_table(df, rules, "t")).collect()}
    assert res[1]["metric_value"] == pytest.approx(2 / 3)
    assert res[2]["metric_value"] == pytest.approx(2 / 3)  # null passes
    assert res[3]["metric_value"] == pytest.approx(2 / 3)
    assert res[4]["metric_value"] == 4.0 and res[4]["Constraint Status"] == dq.FAILURE
    assert res[4]["pass_fraction"] == pytest.approx(2 / 3)  # rows meeting the length bound
    assert res[5]["metric_value"] == 1.0 and res[5]["Constraint Status"] == dq.SUCCESS
    assert res[6]["Constraint Status"] == dq.FAILURE  # 1/3 of rows, asserted == 0
    assert res[1]["Total Rows"] == 3
    assert res[5]["Constraint Message"] == ""
    assert res[1]["Constraint Message"].startswith(dq.MESSAGE_PREFIX)


def test_report_impact_classes(spark):
    tables = catalog.dq_tables(spark, SF01)
    rep = {(r["Table Name"], r["Rule Definition"]): r for r in jobs.dq_job(spark, tables, catalog.rules(spark), "2024-01-31").collect()}
    assert rep[("customer", "Customer key is always filled")]["Impact"] == "No Impact"
    assert rep[("customer", "Account balance is not negative")]["Impact"] == "Low Impact"
    assert rep[("customer", "Segment is automobile or building")]["Impact"] == "High Impact"
    r = rep[("customer", "Segment is automobile or building")]
    assert r["Pass %"] + r["Fail %"] == pytest.approx(100)
    assert r["Pass Count"] + r["Failure Count"] == pytest.approx(r["Total Rows"])
    assert r["Date"] == "31/01/2024"
    assert len(rep) == 12  # supplier has no rules and is skipped


def test_empty_report_is_typed(spark):
    empty = dq.empty_results(spark)
    assert empty.count() == 0
    assert empty.schema["Row Num"].dataType.simpleString() == "int"
    rep = dq.report(empty, "2024-01-31")
    assert rep.columns == dq.REPORT_COLUMNS


def test_message_scrape(spark):
    df = spark.createDataFrame(
        [("t", 1, "Value: 0.25 does not meet the constraint requirement!"), ("t", 2, ""), ("t", 3, "Value: 1e-1 x")],
        "`Table Name` string, `Row Num` int, `Constraint Message` string",
    )
    got = {r["Row Num"]: (r["Pass %"], r["Fail %"]) for r in dq.message_metric(df).collect()}
    assert got[1] == (25.0, 75.0)
    assert got[2] == (100.0, 0.0)
    assert got[3] == pytest.approx((10.0, 90.0))


def test_rules_for_table_filter(spark):
    rules = catalog.rules(spark)
    assert rules.filter(F.col("Table Name") == "orders").count() == 3
    assert rules.filter(F.col("Table Name") == "supplier").count() == 0


def test_local_rules_equal_spark_csv_reader(spark):
    from lakeload.sources import read_rules, rules_from_local_csv

    a = sorted(map(tuple, rules_from_local_csv(spark, catalog.RULES_PATH).collect()), key=str)
    b = sorted(map(tuple, read_rules(spark, catalog.RULES_PATH, "csv").collect()), key=str)
    assert a == b


def test_a_rule_that_cannot_run_fails_alone(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    rules = rule_rows(
        spark,
        [
            ("t", "id", "", "", "", 1, "isComplete", None, None, None),
            ("t", "nope", "", "", "", 2, "isComplete", None, None, None),
            ("t", "nope", "", "", "", 3, "isUnique", None, None, None),
            ("t", "id", "", "", "", 4, "noSuchRule", None, None, None),
        ],
    )
    res = {r["Row Num"]: r for r in dq.results_frame(dq.check_table(df, rules, "t")).collect()}
    assert [res[k]["Constraint Status"] for k in (1, 2, 3, 4)] == [dq.SUCCESS, dq.FAILURE, dq.FAILURE, dq.FAILURE]
    assert "nope" in res[2]["Constraint Message"] and "noSuchRule" in res[4]["Constraint Message"]
