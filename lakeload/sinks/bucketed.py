"""Keyed tables in hash buckets: a load rewrites the buckets its keys fall into.

For tables without a partition column.  The table is plain parquet partitioned by
``hash_bucket = pmod(xxhash64(keys), n)``; ``n`` is part of the folder name, so a table is always
read with the count it was written with.  A change batch can only match rows of its own
buckets: the merge reads those (partition pruning), stages their new content in one job
and moves the bucket folders in place.  All other buckets keep their files.

Recovery.  The marker of the staged list of buckets is the commit point.  Before it, nothing
of the load is visible; after it, ``recover`` (called by every read and load) finishes the
moves, which can be repeated.  Each row carries the execution that wrote it (``_execution``), so a
batch applied again first drops its own null-key rows, the only ones a second
merge would add twice.

Rows with a null key go to a bucket by the hash of the whole row.  One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lakeload.functions import any_null, is_small
from lakeload.operators.merge import ACTION, LIVE_ACTIONS, heavy_keys, merge, metric_columns
from lakeload.operators.project import cast_projection
from lakeload.sources.files import _fs, list_dirs, path_exists
from lakeload.specs import DELETE_FLAG, EXECUTION, TableSpec

BUCKET = "hash_bucket"  # listings skip folders that start with an underscore
#: Table bytes a bucket is meant to hold, and the most buckets a table gets.
BUCKET_BYTES = 256 * 1024 * 1024
MAX_BUCKETS = 65_536


def bucket_of(keys, columns, n: int) -> Column:
    key = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    return F.pmod(F.when(any_null(keys), whole).otherwise(key), F.lit(n)).cast("int")


class BucketedTable:
    """The current state of a keyed table; ``spec`` gives columns and keys."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec
        self.columns = list(spec.fields)
        if {BUCKET, EXECUTION} & set(self.columns):
            raise ValueError(f"{spec.name}: {BUCKET} and {EXECUTION} are columns of the layout")
        self.schema = StructType([*spec.schema().fields, StructField(EXECUTION, StringType()), StructField(BUCKET, IntegerType())])

    def _count(self) -> int | None:
        names = [n for n in list_dirs(self.spark, self.root) if n.startswith("buckets=")]
        return int(names[0].split("=", 1)[1]) if names else None

    def _data(self, n: int) -> str:
        return f"{self.root}/buckets={n}"

    def exists(self) -> bool:
        self.recover()
        return self._count() is not None

    def read(self, stamped: bool = False) -> DataFrame:
        """All rows; with ``stamped`` also the execution that wrote each and its bucket."""
        self.recover()
        n = self._count()
        if n is None:
            raise FileNotFoundError(f"no table under {self.root}")
        rows = self.spark.read.schema(self.schema).parquet(self._data(n))
        return rows if stamped else rows.select(*[F.col(f"`{c}`") for c in self.columns])

    def _write(self, rows: DataFrame, n: int, path: str) -> None:
        """Bucket folders of ``rows``; AQE splits a large bucket and joins small ones."""
        placed = rows.withColumn(BUCKET, bucket_of(self.spec.keys, self.columns, n))
        placed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)

    def create(self, rows: DataFrame, execution: str = "", buckets: int | None = None, table_bytes: int | None = None) -> int:
        """Write a new table (typed rows); returns the bucket count."""
        if self.exists():
            raise ValueError(f"{self.root} exists already")
        n = max(1, min(MAX_BUCKETS, buckets or -(-(table_bytes or BUCKET_BYTES) // BUCKET_BYTES)))
        staged = f"{self.root}/_staged/{uuid.uuid4().hex[:12]}"
        self._write(rows.select(*self.columns, F.lit(execution).alias(EXECUTION)), n, f"{staged}/new={n}")
        self.recover()
        return n

    def apply(self, batch: DataFrame, executions: Sequence[str], flag: str = DELETE_FLAG, small_source: bool | None = None) -> dict:
        """Merge ``batch`` (raw columns and ``flag``); the counts and the buckets rewritten.

        ``executions`` are those the batch holds; with more than one, its ``_execution``
        column says which each row is from.
        """
        self.recover()
        n = self._count()
        keys = self.spec.keys
        if EXECUTION not in batch.columns:
            if len(executions) != 1:
                raise ValueError(f"a batch of several executions needs a column {EXECUTION}")
            batch = batch.withColumn(EXECUTION, F.lit(executions[0]))
        typed = cast_projection(batch, self.spec, keep=(flag, EXECUTION))
        bucket = bucket_of(keys, self.columns, n)
        touched = sorted(r[0] for r in typed.select(bucket.alias("b")).distinct().collect())  # n at most
        if not touched:
            return {f"num_{k}_rows": 0 for k in ("inserted", "updated", "deleted", "dropped", "kept")} | {"buckets": []}
        rows = self.spark.read.schema(self.schema).parquet(self._data(n)).filter(F.col(BUCKET).isin(*touched)).drop(BUCKET)
        own = F.coalesce(F.col(EXECUTION).isin(*executions), F.lit(False))
        target = rows.filter(~(any_null(keys) & own))
        small = is_small(typed) if small_source is None else small_source
        typed = typed.select(*target.columns, flag)
        result = merge(target, typed, keys, self.spec.load_type, flag=flag, small_source=small, heavy=None if small else heavy_keys(target, keys))
        obs = Observation(f"buckets_{uuid.uuid4().hex[:8]}")
        live = result.tagged.observe(obs, *metric_columns()).filter(F.col(ACTION).isin(*LIVE_ACTIONS)).drop(ACTION)
        staged = f"{self.root}/_staged/{uuid.uuid4().hex[:12]}"
        self._write(live, n, f"{staged}/rows={n}")
        full = {int(f.split("=", 1)[1]) for f in list_dirs(self.spark, f"{staged}/rows={n}")}
        plan = self.spark.createDataFrame([(b, b in full) for b in touched], "bucket int, full boolean")
        plan.coalesce(1).write.parquet(f"{staged}/plan")  # its marker commits the load
        # A write without rows is planned away from its shuffle on, and its observation with it.
        counts = dict(obs.get) if full else result.metrics().first().asDict()
        self.recover()
        return counts | {"buckets": touched}

    def recover(self) -> None:
        """Finish committed loads; drop what others left behind.  Every step can be repeated."""
        for name in list_dirs(self.spark, f"{self.root}/_staged"):
            staged = f"{self.root}/_staged/{name}"
            fs, path = _fs(self.spark, staged)
            for kind in [d for d in list_dirs(self.spark, staged) if "=" in d]:
                new, n = f"{staged}/{kind}", int(kind.split("=", 1)[1])
                if kind.startswith("new=") and path_exists(self.spark, f"{new}/_SUCCESS"):
                    self._move(new, self._data(n))
                elif path_exists(self.spark, f"{staged}/plan/_SUCCESS"):
                    for bucket, full in self.spark.read.parquet(f"{staged}/plan").collect():
                        self._move(f"{new}/{BUCKET}={bucket}", f"{self._data(n)}/{BUCKET}={bucket}", empty=not full)
            fs.delete(path, True)

    def _move(self, source: str, target: str, empty: bool = False) -> None:
        """Put a staged folder in place of the old one (none where it is ``empty``); nothing if it was moved before."""
        fs, new = _fs(self.spark, source)
        old = _fs(self.spark, target)[1]
        if empty or fs.exists(new):
            fs.delete(old, True)
        if fs.exists(new):
            fs.mkdirs(old.getParent())
            if not fs.rename(new, old):
                raise OSError(f"could not move {source} to {target}")
