"""Proven size bounds before a broadcast.

A side is broadcast only after it has been shown to hold at most ``max_rows`` rows
and ``max_bytes`` of data:

1. When the frame reads files, their total size (file-system metadata, no job) is
   compared with the bound first: more bytes on disk than the bound means the frame
   is not small, and no data is read at all.
2. Otherwise one distributed aggregation (partial aggregates per task, a single
   small row at the end — nothing funnels through one task) measures the exact row
   count and data size.

Beyond the bound the caller keeps the shuffle join.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    IntegerType,
    ShortType,
    StringType,
)

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024


def input_bytes(df: DataFrame) -> int | None:
    """Total size of the files the frame reads, or None when it reads no files."""
    files = df.inputFiles()
    if not files:
        return None
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    wanted: dict[str, set[str]] = {}
    for f in files:
        parent, _, name = unquote(f).rpartition("/")  # file names come URL-encoded
        wanted.setdefault(parent, set()).add(name)
    total = 0
    for parent, names in wanted.items():  # one listing per folder, not one call per file
        p = jvm.org.apache.hadoop.fs.Path(parent)
        for st in p.getFileSystem(conf).listStatus(p):
            if st.getPath().getName() in names:
                total += st.getLen()
    return total


def _width(field) -> F.Column:
    t = field.dataType
    c = F.col(f"`{field.name}`")
    if isinstance(t, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(t, (BooleanType, ByteType)):
        return F.lit(1)
    if isinstance(t, ShortType):
        return F.lit(2)
    if isinstance(t, (IntegerType, DateType)):
        return F.lit(4)
    if isinstance(t, DecimalType):
        return F.lit(8 if t.precision <= 18 else 16)
    if t.simpleString() in ("bigint", "double", "float", "timestamp", "timestamp_ntz"):
        return F.lit(8)
    return F.coalesce(F.octet_length(c.cast("string")), F.lit(0))


def _bound(df: DataFrame, key: str, given: int | None, default: int) -> int:
    if given is not None:
        return given
    value = df.sparkSession.conf.get(key, None)
    return int(value) if value else default


def is_small(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """True when ``df`` holds at most ``max_rows`` rows and ``max_bytes`` bytes.

    Bounds default to the session settings ``lakeload.broadcast.maxRows`` and
    ``lakeload.broadcast.maxBytes`` (2,000,000 rows and 64 MB when unset).
    """
    max_rows = _bound(df, "lakeload.broadcast.maxRows", max_rows, DEFAULT_MAX_ROWS)
    max_bytes = _bound(df, "lakeload.broadcast.maxBytes", max_bytes, DEFAULT_MAX_BYTES)
    on_disk = input_bytes(df)
    if on_disk is not None and on_disk > max_bytes:
        return False
    width = sum((_width(f) + F.lit(8) for f in df.schema.fields), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    n, b = row["n"], row["b"] or 0
    return n <= max_rows and b <= max_bytes
