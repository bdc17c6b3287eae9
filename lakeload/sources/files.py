"""File and catalog sources.

Directory listings go through the Hadoop FileSystem of the session, so they work
the same on a local disk and on object storage; only names and sizes reach the
driver, never data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lakeload.specs import TableSpec

# Column that carries the execution (batch) directory of each raw row.
EXECUTION_COL = "execution_id"

# The ten columns of a data-quality rule table.
RULES_SCHEMA = StructType(
    [
        StructField("Table Name", StringType(), True),
        StructField("Attribute Name", StringType(), True),
        StructField("Rule Definition", StringType(), True),
        StructField("Domain", StringType(), True),
        StructField("DQ Dimension", StringType(), True),
        StructField("Key", IntegerType(), True),
        StructField("Rule Function", StringType(), True),
        StructField("Condition", StringType(), True),
        StructField("Value", IntegerType(), True),
        StructField("Pattern", StringType(), True),
    ]
)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path exists (file or directory)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` in name order (hidden ones skipped)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Plain parquet scan; parquet is self-describing, so no inference is needed."""
    return spark.read.parquet(path)


def scan_explicit_schema(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Scan with the spec's schema (all columns nullable) instead of the file footers."""
    return spark.read.schema(spec.schema()).parquet(path)


def execution_id_of(file_path):
    """Execution id of a raw file: its folder's name, without a ``key=`` prefix.

    ``_metadata.file_path`` is URL-encoded; a plus sign in it is a plus sign.
    """
    folder = F.regexp_extract(file_path, r"/([^/]+)/[^/]+$", 1)
    folder = F.url_decode(F.regexp_replace(folder, r"\+", "%2B"))
    return F.regexp_replace(folder, r"^[^=]*=", "")


def scan_executions(spark: SparkSession, root: str) -> DataFrame:
    """One scan over every execution directory below ``root``.

    Instead of one read per directory, the files of all executions are read in one
    job and each row keeps its directory's execution id in ``execution_id``.
    """
    df = spark.read.parquet(f"{root.rstrip('/')}/*")
    return df.withColumn(EXECUTION_COL, execution_id_of(F.col("_metadata.file_path")))


def table_exists(spark: SparkSession, qualified_name: str) -> bool:
    return spark.catalog.tableExists(qualified_name)


def rules_from_local_csv(spark: SparkSession, path: str) -> DataFrame:
    """A rule table shipped with the code (a file only the driver sees).

    Rules are a small, bounded configuration, so they are parsed on the driver and
    handed to Spark as a DataFrame; empty fields are null, as with the CSV reader.
    """
    import csv

    def value(field, text):
        if text == "":
            return None
        return int(text) if field.dataType.simpleString() == "int" else text

    with open(path, newline="", encoding="utf-8") as fh:
        reader = csv.reader(fh)
        header = next(reader)
        if header != RULES_SCHEMA.fieldNames():
            raise ValueError(f"unexpected rule columns {header}")
        rows = [tuple(value(f, v) for f, v in zip(RULES_SCHEMA.fields, r)) for r in reader if r]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def read_rules(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Rule table from a CSV (with header), JSON or parquet file, with the fixed schema."""
    reader = spark.read.schema(RULES_SCHEMA)
    if fmt == "csv":
        return reader.option("header", True).option("enforceSchema", True).csv(path)
    if fmt == "json":
        return reader.json(path)
    return reader.parquet(path)
