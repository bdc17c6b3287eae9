"""Named SQL queries over temp views.

A query is configured as SQL text plus the tables it reads; running it registers
each input DataFrame as a temp view under the name the SQL uses and hands the text
to ``spark.sql`` — Catalyst plans it like any DataFrame query.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class NamedQuery:
    name: str
    sql: str
    inputs: tuple[str, ...]


def run_named(spark: SparkSession, query: NamedQuery, tables: Mapping[str, DataFrame]) -> DataFrame:
    missing = [t for t in query.inputs if t not in tables]
    if missing:
        raise KeyError(f"query {query.name} needs tables {missing}")
    for view in query.inputs:
        tables[view].createOrReplaceTempView(view)
    return spark.sql(query.sql)
