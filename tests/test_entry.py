"""Driver contract: entry(), and queries() against oracle_sql() on DuckDB (sf0.001)."""

import hashlib
import json
import math

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if v is None or isinstance(v, (int, bool, str)):
        return v
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256(
        "\n".join(sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)).encode()
    ).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["c_name", "c_mktsegment", "billing", "discount"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 70


FAST = [
    "billing_for_each_customer", "merge_cdc", "merge_cdc_shuffle", "merge_full_metrics", "merge_composite_key",
    "change_feed", "gold_candidate_by_campaign", "gold_status_by_campaign", "dq_report", "merge_latest_per_key",
    "cdc_reconcile", "scan_by_execution", "load_log_full", "snapshot_restore",
]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(dcols, drows)
