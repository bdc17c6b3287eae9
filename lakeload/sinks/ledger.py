"""Ledger of applied batches.

Instead of deleting consumed raw input, every applied ``(table, execution_id)`` is
appended to a small parquet table.  Unprocessed batches are the executions that
have no ledger entry (a left anti join), so a re-run after a failure applies each
batch exactly once and the input is never destroyed.

``FileLedger`` books files (path, length, time) instead: pending input is a listing minus the
ledger, found before any data is read, and a file that arrives late in the
folder of an applied execution is pending too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakeload.sources.files import EXECUTION_COL, execution_id_of, path_exists

LEDGER_SCHEMA = StructType(
    [
        StructField("table_name", StringType(), False),
        StructField(EXECUTION_COL, StringType(), False),
        StructField("table_version", LongType(), True),
        StructField("num_inserted_rows", LongType(), True),
        StructField("num_updated_rows", LongType(), True),
        StructField("num_deleted_rows", LongType(), True),
    ]
)


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    def applied(self, table_name: str) -> set[str]:
        """Names of the executions applied to a table (folder names, one an execution)."""
        rows = self.read().filter(F.col("table_name") == table_name).select(EXECUTION_COL).distinct()
        return {r[EXECUTION_COL] for r in rows.collect()}

    def record(self, table_name: str, execution_id: str, version: int, ins: int, upd: int, dele: int) -> None:
        self.record_many(table_name, [execution_id], version, ins, upd, dele)

    def record_many(self, table_name: str, execution_ids, version: int, ins: int, upd: int, dele: int) -> None:
        """One append for several executions applied by the same table version."""
        rows = [(table_name, ex, int(version), int(ins), int(upd), int(dele)) for ex in execution_ids]
        self.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def record_rows(self, table_name: str, rows) -> None:
        """One append for several ``(execution_id, version, ins, upd, del)`` rows."""
        data = [(table_name, str(ex), int(v), int(i), int(u), int(d)) for ex, v, i, u, d in rows]
        if data:
            self.spark.createDataFrame(data, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def unprocessed(self, executions: DataFrame, table_name: str) -> DataFrame:
        """Rows of ``executions`` (with ``execution_id``) whose batch is not in the ledger."""
        done = self.read().filter(F.col("table_name") == table_name).select(EXECUTION_COL)
        return executions.join(done, EXECUTION_COL, "left_anti")


FILES_SCHEMA = "table_name string, path string, length bigint, modificationTime timestamp"
_FILE = ["path", "length", "modificationTime"]


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, length, modificationTime)`` of the parquet files below ``root``; no content is read."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], FILES_SCHEMA).select(*_FILE)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return reader.load(root).select(*_FILE)


class FileLedger:
    """Files applied to each table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], FILES_SCHEMA)
        return self.spark.read.schema(FILES_SCHEMA).parquet(self.path)

    def pending(self, root: str, table_name: str) -> DataFrame:
        """Files below ``root`` that are not booked for the table as they are now."""
        done = self.read().filter(F.col("table_name") == table_name).select(*_FILE)
        return list_files(self.spark, root).join(done, _FILE, "left_anti")

    def scan(self, root: str, table_name: str) -> tuple[DataFrame | None, list[str]]:
        """Rows of the pending files with their ``execution_id``, and the files; only those files are opened.

        The names go through the driver, as those of any file scan do.
        """
        paths = sorted(r["path"] for r in self.pending(root, table_name).select("path").collect())
        if not paths:
            return None, []
        rows = self.spark.read.parquet(*paths)
        return rows.withColumn(EXECUTION_COL, execution_id_of(F.col("_metadata.file_path"))), paths

    def record(self, root: str, table_name: str, paths: list[str]) -> None:
        """Book files as applied, with the length and time they have now."""
        names = self.spark.createDataFrame([(p,) for p in paths], "path string")
        rows = list_files(self.spark, root).join(names, "path", "left_semi").select(F.lit(table_name).alias("table_name"), *_FILE)
        rows.coalesce(1).write.mode("append").parquet(self.path)
