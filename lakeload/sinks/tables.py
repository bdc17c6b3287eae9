"""Replace-style sinks.

Row counts ride on the write itself through ``DataFrame.observe``: the rows read
and the rows written are known after one job, without a second count query.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _writer(df: DataFrame, partition_by: Sequence[str], mode: str):
    # A replace is a full replace even in sessions that default to dynamic overwrite.
    w = df.write.mode(mode).option("partitionOverwriteMode", "static")
    cols = [c for c in partition_by if c]
    return w.partitionBy(*cols) if cols else w


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Overwrite ``path`` with ``df`` (purging what was there) and return the rows written.

    ``partition_by`` entries that are empty strings are ignored, so a configuration of
    ``['']`` means an unpartitioned table.
    """
    obs = Observation(f"replace_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    _writer(observed, partition_by, "overwrite").format(fmt).save(path)
    return int(obs.get["rows"])


def save_table(
    df: DataFrame, qualified_name: str, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> int:
    """Overwrite a catalog table stored at an external ``path``; returns rows written."""
    obs = Observation(f"save_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    _writer(observed, partition_by, "overwrite").format(fmt).option("path", path).saveAsTable(qualified_name)
    return int(obs.get["rows"])


def drop_table(spark: SparkSession, qualified_name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {qualified_name}")


def create_databases(spark: SparkSession, locations: Mapping[str, str]) -> None:
    """Create the databases that are missing, each at its folder."""
    for name, folder in locations.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder}'")


def archive_batch(batch: DataFrame, archive_root: str, processed_at: str) -> int:
    """Append a processed batch below ``archive_root`` in yyyy/MM/dd/HH/mm folders.

    The folder parts are derived from ``processed_at`` (a timestamp literal) as
    partition columns, so archiving is one distributed append, not a file copy loop.
    """
    ts = F.to_timestamp(F.lit(processed_at))
    parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH", "minute": "mm"}
    out = batch.select("*", *[F.date_format(ts, fmt).alias(name) for name, fmt in parts.items()])
    obs = Observation(f"archive_{uuid.uuid4().hex[:8]}")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    out.write.mode("append").partitionBy(*parts).parquet(archive_root)
    return int(obs.get["rows"])
