"""Partition-scoped MERGE for partitioned parquet tables.

When the table is partitioned by columns that are part of the merge key, a change
batch can only match rows in the partitions its own rows fall into.  The merge then
reads only those partitions (partition pruning at the scan), writes their new
content to a staging folder, and replaces exactly those partitions with a dynamic
partition overwrite.  Cost grows with the partitions a batch touches, not with the
table.  Partitions that the merge leaves empty are removed.

The staging folder is kept until the swap has finished, so a failed swap can be
re-run from it; the swap reads staging, never the table it overwrites.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeload.functions import any_null
from lakeload.operators.merge import ACTION, LIVE_ACTIONS, merge, metric_columns
from lakeload.sources.files import _fs, path_exists
from lakeload.specs import CDC, DELETE_FLAG, EXECUTION


def _partition_filter(partition_by: Sequence[str], values: list[tuple]):
    cond = None
    for vals in values:
        c = None
        for col, v in zip(partition_by, vals):
            e = F.col(col).isNull() if v is None else (F.col(col) == F.lit(v))
            c = e if c is None else c & e
        cond = c if cond is None else cond | c
    return cond


def merge_into_partitions(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    batch: DataFrame,
    keys: Sequence[str],
    mode: str = CDC,
    flag: str = DELETE_FLAG,
    staging_root: str | None = None,
    execution: str | None = None,
) -> dict:
    """Merge ``batch`` into the partitioned parquet table at ``path``; return metrics.

    With ``execution`` every row carries the execution that wrote it, and a batch applied
    again first drops its own null-key rows, so a replay leaves the table as it was.
    """
    partition_by = list(partition_by)
    if execution is not None:
        batch = batch.withColumn(EXECUTION, F.lit(execution))
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the merge key")
    # The touched partition values: one row per partition, not per data row.
    touched = [tuple(r) for r in batch.select(*partition_by).distinct().collect()]
    if not touched:
        return {"num_inserted_rows": 0, "num_updated_rows": 0, "num_deleted_rows": 0, "num_dropped_rows": 0}
    # The batch's schema, so that partition values are not typed by their looks.
    schema, folders = batch.drop(flag).schema, []
    if path_exists(spark, path):
        target = spark.read.schema(schema).parquet(path).filter(_partition_filter(partition_by, touched))
        folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]+$", 1).alias("folder")
        folders = [r["folder"] for r in target.select(folder).distinct().collect()]  # of the touched partitions
        target = target.select(*[c for c in target.columns if c not in partition_by], *partition_by)
        if execution is not None:
            target = target.filter(~(any_null(keys) & F.coalesce(F.col(EXECUTION) == execution, F.lit(False))))
    else:
        target = spark.createDataFrame([], schema)
    cols = target.columns
    result = merge(target, batch.select(*cols, flag), keys, mode, flag=flag)
    obs = Observation(f"pmerge_{uuid.uuid4().hex[:8]}")
    rows = (
        result.tagged.observe(obs, *metric_columns())
        .filter(F.col(ACTION).isin(*LIVE_ACTIONS))
        .select(*cols)
    )
    staging = f"{staging_root or path.rstrip('/') + '/_staging'}/{uuid.uuid4().hex[:12]}"
    rows.write.mode("errorifexists").partitionBy(*partition_by).parquet(staging)
    metrics = dict(obs.get)
    # Swap: replace the partitions present in staging, remove the ones left empty.
    staged = spark.read.schema(rows.schema).parquet(staging).select(*cols)
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    fs, staging_path = _fs(spark, staging)
    jvm = spark.sparkContext._jvm
    for folder in folders:
        old = at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))  # the path is URL-encoded
        names = []
        for _ in partition_by:
            names.insert(0, at.getName())
            at = at.getParent()
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{staging}/{'/'.join(names)}")):
            fs.delete(old, True)
    fs.delete(staging_path, True)
    return metrics
