"""Projections: schema-driven casts and load stamps."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions import cast_columns
from lakeload.specs import TableSpec

LOAD_STAMP_COL = "ts_load"


def cast_projection(df: DataFrame, spec: TableSpec, lenient: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Keep the configured fields, cast to their configured types, in spec order.

    Columns of ``df`` not in the spec are pruned (and, for parquet, never read).
    Strict mode fails on a value that does not convert (ANSI); lenient mode turns it
    into null.  ``keep`` carries extra columns through unchanged (e.g. the op flag).
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(*cast_columns(spec.fields, lenient, types), *[F.col(f"`{c}`") for c in keep])


def _as_date(as_of: str | _dt.date | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def load_stamp(df: DataFrame, as_of: str | _dt.date | None = None) -> DataFrame:
    """Add ``ts_load`` (the load date); ``as_of`` pins it for reproducible runs."""
    return df.withColumn(LOAD_STAMP_COL, _as_date(as_of))


def filter_load_date(df: DataFrame, as_of: str | _dt.date | None = None) -> DataFrame:
    """Rows stamped on the given load date (today by default)."""
    return df.filter(F.col(LOAD_STAMP_COL) == _as_date(as_of))
