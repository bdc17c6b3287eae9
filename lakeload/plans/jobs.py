"""User-facing jobs: full load, CDC load, gold loads, data quality, reconciliation.

Each job loops over its (small) table configuration on the driver and runs one
Spark plan per table; per-table failures are isolated and logged.  Logs are
DataFrames built from the counts the jobs observed while writing.
"""

from __future__ import annotations

import datetime as _dt
import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeload.functions import is_small
from lakeload.functions.sizing import input_bytes
from lakeload.operators import dq as dqmod
from lakeload.operators.dq_states import DqStates
from lakeload.operators import change_feed as cf
from lakeload.operators.merge import ACTION, LIVE_ACTIONS, MergeResult, collapse_changes, heavy_keys, merge, metric_columns, repeats_keys
from lakeload.operators.project import cast_projection
from lakeload.sinks import Ledger, VersionedTable, archive_batch, create_databases, drop_table
from lakeload.sinks.bucketed import BucketedTable
from lakeload.sources import EXECUTION_COL, list_dirs, path_exists, scan_executions
from lakeload.sources.files import execution_id_of
from lakeload.specs import CDC, DELETE_FLAG, EXECUTION, GoldSpec, TableSpec

LOG = logging.getLogger(__name__)

# Status texts of the load logs (kept verbatim).
STATUS_LOADED = "Table Sucessfull Loaded"
STATUS_NO_DATA = "Don't exist data for the table"
STATUS_ERROR = "Error loading table please review the code "

FULL_LOG_SCHEMA = "TableName string, Status string, Rows_Loaded bigint, Rows_Readed bigint"
CDC_LOG_SCHEMA = "TableName string, Status string, num_inserted_rows bigint, num_updated_rows bigint, num_deleted_rows bigint"
CDC_TEST_LOG_SCHEMA = CDC_LOG_SCHEMA + ", num_read_deleted_regs bigint, num_read_upsert_regs bigint"


@dataclass
class Zones:
    """Folder layout of one lake: raw input, silver and gold tables, bookkeeping."""

    raw: str
    silver: str
    gold: str
    meta: str

    @classmethod
    def under(cls, root: str) -> "Zones":
        root = root.rstrip("/")
        return cls(raw=f"{root}/raw", silver=f"{root}/silver", gold=f"{root}/gold", meta=f"{root}/_meta")

    def silver_table(self, spark: SparkSession, spec: TableSpec) -> VersionedTable:
        return VersionedTable(spark, f"{self.silver}/{spec.name}", spec.partition_by)

    def gold_table(self, spark: SparkSession, spec: GoldSpec) -> VersionedTable:
        return VersionedTable(spark, f"{self.gold}/{spec.name}", spec.partition_by)


def write_executions(df: DataFrame, root: str, execution: F.Column) -> None:
    """Lay raw rows out as execution folders (``exec=<id>``) in one distributed write."""
    df.withColumn("exec", execution.cast("string")).write.mode("overwrite").partitionBy("exec").parquet(root)


def execution_name(folder: str) -> str:
    return folder.split("=", 1)[1] if "=" in folder else folder


# ---------------------------------------------------------------------------
# Full load raw -> silver
# ---------------------------------------------------------------------------


def execution_counts(
    spark: SparkSession, path: str, spec: TableSpec | None = None, lenient: bool = False
) -> DataFrame:
    """Rows per execution folder from one scan.

    With ``spec`` every row goes through the table's cast projection first, so a
    value that does not convert (strict mode) or a missing column fails this job:
    each execution is validated as the reference's per-execution load would be.
    Without it, no column is decoded for the count.
    """
    rows = scan_executions(spark, path)
    if spec is not None:
        rows = cast_projection(rows, spec, lenient, keep=(EXECUTION_COL,))
    exec_id = F.col(EXECUTION_COL)
    if spec is None:
        return rows.select(exec_id).groupBy(EXECUTION_COL).agg(F.count(F.lit(1)).alias("rows"))
    # Consume every cast column (a hash of them) so that column pruning cannot drop
    # the casts, and with them the validation.
    checked = rows.select(exec_id, F.hash(*[F.col(f"`{c}`") for c in spec.fields]).alias("__h"))
    return checked.groupBy(EXECUTION_COL).agg(F.count(F.lit(1)).alias("rows"), F.max("__h").alias("__check"))


def full_load(
    spark: SparkSession, specs: Sequence[TableSpec], zones: Zones, lenient: bool = False
) -> DataFrame:
    """Replace each silver table with its latest execution; log every execution.

    The load commits the next version of the same table that ``cdc_load`` merges
    into, so changes apply to what was loaded and a crash leaves the old version.

    Executions replace one another, so only the last one (in name order) is
    written.  First one job casts every execution (strict mode fails on a bad
    value, as a per-execution load would) and counts its rows; if that fails the
    table logs an error row and its silver table is left as it was.
    """
    log = []
    for spec in specs:
        raw = f"{zones.raw}/{spec.path or spec.name}"
        try:
            if not path_exists(spark, raw):
                log.append((spec.name, STATUS_NO_DATA, 0, 0))
                continue
            folders = list_dirs(spark, raw)
            if not folders:
                log.append((spec.name, STATUS_NO_DATA, 0, 0))
                continue
            last = folders[-1]
            counts = {r[EXECUTION_COL]: r["rows"] for r in execution_counts(spark, raw, spec, lenient).collect()}
            obs = Observation(f"read_{uuid.uuid4().hex[:8]}")
            batch = spark.read.parquet(f"{raw}/{last}").observe(obs, F.count(F.lit(1)).alias("rows"))
            _, m = zones.silver_table(spark, spec).commit(cast_projection(batch, spec, lenient))
            written = int(m["rows"])
            for folder in folders:
                name = execution_name(folder)
                n = int(obs.get["rows"]) if folder == last else int(counts.get(name, 0))
                loaded = written if folder == last else n
                log.append((spec.name, STATUS_LOADED, loaded, n))
        except Exception:  # noqa: BLE001 - one table's failure must not stop the others
            LOG.exception("%s: full load failed", spec.name)
            log.append((spec.name, STATUS_ERROR, 0, 0))
    return spark.createDataFrame(log, FULL_LOG_SCHEMA)


# ---------------------------------------------------------------------------
# CDC load raw -> silver
# ---------------------------------------------------------------------------


def commit_merge(
    table: VersionedTable, result: MergeResult, batch_ids: Sequence[str] = (), base_version: int | None = None
) -> tuple[int, dict]:
    """Write the merged rows as the table's next version; metrics ride on the write.

    ``batch_ids`` are recorded with the version, atomically with its commit;
    ``base_version`` (the version the merge read) guards against a concurrent writer."""
    obs = Observation(f"merge_{uuid.uuid4().hex[:8]}")
    observed = result.tagged.observe(obs, *metric_columns())
    rows = observed.filter(F.col(ACTION).isin(*LIVE_ACTIONS)).select(*[F.col(f"`{c}`") for c in result.columns])
    version, _ = table.commit(rows, batch_ids=batch_ids, base_version=base_version)
    return version, dict(obs.get)


def apply_batch(
    spark: SparkSession,
    table: VersionedTable,
    spec: TableSpec,
    batch: DataFrame,
    small_source: bool | None = None,
    flag: str = DELETE_FLAG,
    batch_ids: Sequence[str] = (),
) -> dict:
    """Bootstrap the table from the batch when it is missing, then merge the batch."""
    typed = cast_projection(batch, spec, keep=(flag,))
    if not table.exists():
        table.commit(typed.drop(flag))
    base = table.latest_version()
    target = table.read(base)
    small = is_small(typed) if small_source is None else small_source
    heavy = None if small else heavy_keys(target, spec.keys)
    result = merge(target, typed, spec.keys, spec.load_type, flag=flag, small_source=small, heavy=heavy)
    version, m = commit_merge(table, result, batch_ids, base_version=base)
    m["version"] = version
    return m


def apply_collapsed(
    spark: SparkSession, table: VersionedTable, spec: TableSpec, raw: str, folders: Sequence[str], flag: str = DELETE_FLAG
) -> dict:
    """Merge several execution folders as one net change (see ``collapse_changes``).

    When one of them holds a key twice they are applied one by one instead, as the
    batch-by-batch job does.
    """
    rows = scan_executions(spark, raw)
    wanted = [execution_name(f) for f in folders]
    rows = rows.filter(F.col(EXECUTION_COL).isin(*wanted))
    typed = cast_projection(rows, spec, keep=(flag, EXECUTION_COL))
    if repeats_keys(typed, spec.keys, [EXECUTION_COL]):
        for folder in folders:  # no net change exists: batch by batch
            m = apply_batch(spark, table, spec, spark.read.parquet(f"{raw}/{folder}"), flag=flag, batch_ids=[execution_name(folder)])
        return m
    if not table.exists():
        first = typed.filter(F.col(EXECUTION_COL) == wanted[0]).drop(flag, EXECUTION_COL)
        table.commit(first)
    net = collapse_changes(typed, spec.keys, [EXECUTION_COL], spec.load_type, flag).drop(EXECUTION_COL)
    # The net change is never larger than the raw rows: bound it by the (cheaper,
    # early-stopping) check on the raw batch instead of computing the collapse twice.
    base = table.latest_version()
    result = merge(table.read(base), net, spec.keys, spec.load_type, flag=flag, small_source=is_small(typed))
    version, m = commit_merge(table, result, wanted, base_version=base)
    m["version"] = version
    return m


def cdc_load(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    zones: Zones,
    processed_at: str | None = None,
    archive: bool = True,
    with_read_counts: bool = False,
    collapse: bool = False,
    layout: str = "versioned",
) -> DataFrame:
    """Apply every unprocessed execution folder of each table, in name order.

    The ledger makes re-runs idempotent (a batch is applied once); the log keeps
    the counts of the last batch applied per table.  With ``collapse`` all pending
    executions are reduced to one net change per key and merged in a single job
    (one table rewrite instead of one per execution); the log then holds the net
    counts of that merge.

    ``layout="partitioned"`` keeps the silver table as a plain parquet folder
    partitioned by ``spec.partition_by`` (columns of the key) and merges each batch
    into only the partitions it touches (``sinks.partitioned``); applied batches
    are then tracked by the ledger (a batch applied again leaves the table as it was, so a
    replay after a crash is harmless).

    ``layout="bucketed"`` is the same for tables without a partition column: hash buckets
    of the key (``sinks.bucketed``), of which a batch rewrites those its keys fall into.
    ``collapse`` works for it too.
    """
    if layout in ("partitioned", "bucketed"):
        return _cdc_load_in_place(spark, specs, zones, processed_at, archive, layout, collapse)
    processed_at = processed_at or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    ledger = Ledger(spark, f"{zones.meta}/ledger")
    log = []
    for spec in specs:
        raw = f"{zones.raw}/{spec.path_cdc or spec.name}"
        try:
            if not path_exists(spark, raw):
                log.append((spec.name, STATUS_NO_DATA, 0, 0, 0) + ((0, 0) if with_read_counts else ()))
                continue
            table = zones.silver_table(spark, spec)
            # Applied batches are recorded with the table versions themselves (atomic
            # with the commit); the ledger is the readable log of the same facts.
            done = table.applied_batches()
            last = {"num_inserted_rows": 0, "num_updated_rows": 0, "num_deleted_rows": 0}
            reads = (0, 0)
            if collapse:
                pending = [f for f in list_dirs(spark, raw) if execution_name(f) not in done]
                if pending:
                    last = apply_collapsed(spark, table, spec, raw, pending)
                    ledger.record_many(
                        spec.name, [execution_name(f) for f in pending], last["version"],
                        last["num_inserted_rows"], last["num_updated_rows"], last["num_deleted_rows"],
                    )
                    if archive:
                        batch = spark.read.parquet(*[f"{raw}/{f}" for f in pending])
                        archive_batch(batch, f"{zones.raw}/_processed/{spec.name}", processed_at)
                log.append((spec.name, STATUS_LOADED, last["num_inserted_rows"], last["num_updated_rows"], last["num_deleted_rows"]) + (reads if with_read_counts else ()))
                continue
            applied, applied_folders = [], []
            try:
                for folder in list_dirs(spark, raw):
                    ex = execution_name(folder)
                    if ex in done:
                        continue
                    batch = spark.read.parquet(f"{raw}/{folder}")
                    if with_read_counts:
                        r = batch.agg(
                            F.count(F.when(F.col(DELETE_FLAG) == F.lit(True), 1)).alias("d"),
                            F.count(F.when(F.col(DELETE_FLAG) == F.lit(False), 1)).alias("u"),
                        ).first()
                        reads = (int(r["d"]), int(r["u"]))
                    last = apply_batch(spark, table, spec, batch, batch_ids=[ex])
                    applied.append((ex, last["version"], last["num_inserted_rows"], last["num_updated_rows"], last["num_deleted_rows"]))
                    applied_folders.append(f"{raw}/{folder}")
            finally:
                # Bookkeeping once per table: the ledger rows and one archive append
                # for every batch applied in this run (what counts as applied is
                # recorded atomically with each table version).
                ledger.record_rows(spec.name, applied)
                if archive and applied_folders:
                    archive_batch(spark.read.parquet(*applied_folders), f"{zones.raw}/_processed/{spec.name}", processed_at)
            row = (spec.name, STATUS_LOADED, last["num_inserted_rows"], last["num_updated_rows"], last["num_deleted_rows"])
            log.append(row + (reads if with_read_counts else ()))
        except Exception:  # noqa: BLE001
            LOG.exception("%s: load failed", spec.name)
            log.append((spec.name, STATUS_ERROR, 0, 0, 0) + ((0, 0) if with_read_counts else ()))
    return spark.createDataFrame(log, CDC_TEST_LOG_SCHEMA if with_read_counts else CDC_LOG_SCHEMA)


def partitioned_path(zones: Zones, spec: TableSpec) -> str:
    return f"{zones.silver}/{spec.name}/partitioned"


def bucketed_table(spark: SparkSession, zones: Zones, spec: TableSpec) -> BucketedTable:
    return BucketedTable(spark, f"{zones.silver}/{spec.name}/bucketed", spec)


def _apply_partitioned(spark: SparkSession, zones: Zones, spec: TableSpec, batch: DataFrame, executions: Sequence[str]) -> dict:
    from lakeload.sinks.partitioned import merge_into_partitions

    (execution,) = executions
    path = partitioned_path(zones, spec)
    typed = cast_projection(batch, spec, keep=(DELETE_FLAG,))
    if not path_exists(spark, path):  # bootstrap from the whole first batch
        typed.drop(DELETE_FLAG).withColumn(EXECUTION, F.lit(execution)).write.partitionBy(*spec.partition_by).parquet(path)
    return merge_into_partitions(spark, path, spec.partition_by, typed, spec.keys, spec.load_type, execution=execution)


def _apply_bucketed(spark: SparkSession, zones: Zones, spec: TableSpec, batch: DataFrame, executions: Sequence[str]) -> dict:
    table = bucketed_table(spark, zones, spec)
    if not table.exists():  # bootstrap from the whole first batch
        typed = cast_projection(batch, spec, keep=(DELETE_FLAG,))
        table.create(typed.drop(DELETE_FLAG), executions[0], table_bytes=input_bytes(batch))
    return table.apply(batch, executions)


def _collapsed_batch(spark: SparkSession, spec: TableSpec, raw: str, folders: Sequence[str]) -> DataFrame | None:
    """Pending executions as one net change, each row with its (last) execution; None where one of them repeats a key."""
    rows = scan_executions(spark, raw).filter(F.col(EXECUTION_COL).isin(*[execution_name(f) for f in folders]))
    typed = cast_projection(rows, spec, keep=(DELETE_FLAG, EXECUTION_COL)).withColumn(EXECUTION, F.col(EXECUTION_COL))
    if repeats_keys(typed, spec.keys, [EXECUTION_COL]):
        return None
    return collapse_changes(typed, spec.keys, [EXECUTION_COL], spec.load_type).drop(EXECUTION_COL)


def _cdc_load_in_place(
    spark: SparkSession, specs: Sequence[TableSpec], zones: Zones, processed_at: str | None, archive: bool, layout: str, collapse: bool
) -> DataFrame:
    processed_at = processed_at or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    ledger = Ledger(spark, f"{zones.meta}/ledger")
    apply = _apply_partitioned if layout == "partitioned" else _apply_bucketed
    log = []
    for spec in specs:
        raw = f"{zones.raw}/{spec.path_cdc or spec.name}"
        try:
            if layout == "partitioned" and not (spec.partition_by and set(spec.partition_by) <= set(spec.keys)):
                raise ValueError(f"{spec.name}: partitioned layout needs partition columns inside the key")
            if not path_exists(spark, raw):
                log.append((spec.name, STATUS_NO_DATA, 0, 0, 0))
                continue
            done = ledger.applied(spec.name)
            pending = [f for f in list_dirs(spark, raw) if execution_name(f) not in done]
            groups = [[f] for f in pending]
            if collapse and layout == "bucketed" and len(pending) > 1 and bucketed_table(spark, zones, spec).exists():
                net = _collapsed_batch(spark, spec, raw, pending)
                groups = groups if net is None else [pending]
            last = {"num_inserted_rows": 0, "num_updated_rows": 0, "num_deleted_rows": 0}
            for folders in groups:
                batch = net if len(folders) > 1 else spark.read.parquet(f"{raw}/{folders[0]}")
                names = [execution_name(f) for f in folders]
                last = apply(spark, zones, spec, batch, names)
                ledger.record_many(spec.name, names, 0, last["num_inserted_rows"], last["num_updated_rows"], last["num_deleted_rows"])
                if archive:
                    archive_batch(spark.read.parquet(*[f"{raw}/{f}" for f in folders]), f"{zones.raw}/_processed/{spec.name}", processed_at)
            log.append((spec.name, STATUS_LOADED, last["num_inserted_rows"], last["num_updated_rows"], last["num_deleted_rows"]))
        except Exception:  # noqa: BLE001
            LOG.exception("%s: load failed", spec.name)
            log.append((spec.name, STATUS_ERROR, 0, 0, 0))
    return spark.createDataFrame(log, CDC_LOG_SCHEMA)


def apply_with_feed(spark: SparkSession, target: DataFrame, batch: DataFrame, keys: Sequence[str], path: str, mode: str = CDC) -> tuple[DataFrame, DataFrame, dict]:
    """Merge and keep the change feed: ``(table, feed, counts)`` from one staged job.

    The tagged rows, with the images from before the merge, are written once, partitioned by
    action.  The table is the live partitions of that write and the feed comes from the
    changed ones, so kept rows are neither compared nor shuffled for it.
    """
    small = is_small(batch)
    result = merge(target, batch, keys, mode, small_source=small, heavy=None if small else heavy_keys(target, keys), images=True)
    obs = Observation(f"feed_{uuid.uuid4().hex[:8]}")
    result.tagged.observe(obs, *metric_columns()).write.partitionBy(ACTION).parquet(path)
    schema = result.tagged.schema
    staged = spark.read.schema(schema).parquet(path)
    rows = MergeResult(staged, result.columns, mode, result.broadcast).rows()
    return rows, cf.feed_of_merge(staged, result.columns, keys), dict(obs.get)


def fold_batches(
    spark: SparkSession, table: VersionedTable, spec: TableSpec, batches: DataFrame, small_source: bool | None = None
) -> DataFrame:
    """Apply a frame of CDC rows batch by batch, in ``execution_id`` order.

    The frame is computed once and written below the shared checkpoint folder,
    partitioned by execution id; each batch is then a read of one partition
    folder (no recomputation of the frame per batch, lineage cut).  Each batch is
    one merge whose result is written as a version.  Returns per-batch metrics.
    """
    from lakeload.session import work_dir

    staged = work_dir(spark, "fold")
    batches.write.partitionBy(EXECUTION_COL).parquet(staged)
    rows = []
    for folder in list_dirs(spark, staged):
        ex = execution_name(folder)
        batch = spark.read.parquet(f"{staged}/{folder}")
        m = apply_batch(spark, table, spec, batch, small_source, batch_ids=[ex])
        rows.append((ex, m["version"], m["num_inserted_rows"], m["num_updated_rows"], m["num_deleted_rows"]))
    return spark.createDataFrame(
        rows, f"{EXECUTION_COL} string, table_version bigint, num_inserted_rows bigint, num_updated_rows bigint, num_deleted_rows bigint"
    )


# ---------------------------------------------------------------------------
# Gold loads
# ---------------------------------------------------------------------------


def gold_full_load(
    spark: SparkSession, golds: Sequence[GoldSpec], silver: Mapping[str, DataFrame], zones: Zones
) -> DataFrame:
    """Replace each gold table with its builder's result; rows read = rows written."""
    log = []
    for g in golds:
        try:
            table = zones.gold_table(spark, g)
            _, m = table.commit(g.build(silver))
            log.append((g.name, STATUS_LOADED, int(m["rows"]), int(m["rows"])))
        except Exception:  # noqa: BLE001
            LOG.exception("%s: load failed", g.name)
            log.append((g.name, STATUS_ERROR, 0, 0))
    return spark.createDataFrame(log, FULL_LOG_SCHEMA)


def gold_cdc_load(
    spark: SparkSession, golds: Sequence[GoldSpec], silver: Mapping[str, DataFrame], zones: Zones
) -> DataFrame:
    """Merge each builder's view (IsDeleted = false) into the existing gold table."""
    log = []
    for g in golds:
        try:
            table = zones.gold_table(spark, g)
            if not table.exists():
                raise FileNotFoundError(f"gold table {g.name} must exist before a CDC load")
            view = g.build(silver).withColumn(DELETE_FLAG, F.lit(False))
            base = table.latest_version()
            result = merge(table.read(base), view, g.keys, g.load_type)
            _, m = commit_merge(table, result, base_version=base)
            log.append((g.name, STATUS_LOADED, m["num_inserted_rows"], m["num_updated_rows"], m["num_deleted_rows"]))
        except Exception:  # noqa: BLE001
            LOG.exception("%s: load failed", g.name)
            log.append((g.name, STATUS_ERROR, 0, 0, 0))
    return spark.createDataFrame(log, CDC_LOG_SCHEMA)


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------


def dq_results(spark: SparkSession, tables: Mapping[str, DataFrame], rules: DataFrame) -> DataFrame:
    """Constraint results of every table that has rules (tables without are skipped).

    The metrics (one row per rule) are computed when this is called, so that a rule that fails
    at run time ends neither the other rules nor the report.
    """
    rows = dqmod.metric_rows(tables, dqmod.collect_rules(rules))
    if not rows:
        return dqmod.empty_results(spark)
    return dqmod.results_frame(dqmod.with_rules(spark.createDataFrame(rows, dqmod.METRIC_ROWS), rules))


def dq_job(spark: SparkSession, tables: Mapping[str, DataFrame], rules: DataFrame, as_of: str) -> DataFrame:
    return dqmod.report(dq_results(spark, tables, rules), as_of)


def dq_job_incremental(spark: SparkSession, roots: Mapping[str, str], rules: DataFrame, as_of: str, states: DqStates) -> DataFrame:
    """The report over raw execution folders, reading only executions without a stored state.

    ``roots`` maps table to raw folder.  States of all executions are summed, so the report
    equals that of the whole tables.
    """
    rows = []
    for name, parsed in dqmod.collect_rules(rules).items():
        if name not in roots:
            continue
        done = states.executions(name, parsed)
        new = [f for f in list_dirs(spark, roots[name]) if execution_name(f) not in done]
        if new:
            states.refresh(name, spark.read.parquet(*[f"{roots[name]}/{f}" for f in new]).withColumn(EXECUTION_COL, execution_id_of(F.col("_metadata.file_path"))), parsed)
        rows += states.metric_rows(name, parsed)
    if not rows:
        return dqmod.report(dqmod.empty_results(spark), as_of)
    return dqmod.report(dqmod.results_frame(dqmod.with_rules(spark.createDataFrame(rows, dqmod.METRIC_ROWS), rules)), as_of)


# ---------------------------------------------------------------------------
# Reconciliation
# ---------------------------------------------------------------------------


def file_rows(spark: SparkSession, path: str) -> int:
    """Rows of the parquet files below ``path`` by their footers.

    The columnar reader answers the count from file statistics (aggregate push-down),
    so no page is read whatever the size of the table.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).first()["n"]


def load_reconcile_files(spark: SparkSession, specs: Sequence[TableSpec], zones: Zones) -> DataFrame:
    """Rows read against rows written for each full-loaded table, both counted in the files themselves.

    Independent of the load's own log: the raw files of the last execution against
    the files of the current silver version.
    """
    out = []
    for spec in specs:
        raw = f"{zones.raw}/{spec.path or spec.name}"
        folders = list_dirs(spark, raw)
        table = zones.silver_table(spark, spec)
        read = file_rows(spark, f"{raw}/{folders[-1]}") if folders else None
        written = file_rows(spark, table.path()) if table.exists() else None
        out.append((spec.name, read, written, read is not None and read == written))
    return spark.createDataFrame(out, "TableName string, Rows_Readed bigint, Rows_Written bigint, ok boolean")


def load_reconcile(log: DataFrame) -> DataFrame:
    """Per full-load log row: did every row read get written?"""
    return log.select(
        "TableName", "Status", "Rows_Loaded", "Rows_Readed",
        ((F.col("Status") == STATUS_LOADED) & (F.col("Rows_Loaded") == F.col("Rows_Readed"))).alias("ok"),
    )


def _one_row_union(*frames: DataFrame) -> DataFrame:
    """Combine single-row frames side by side (unpivot, union, pivot back)."""
    names, parts = [], []
    for f in frames:
        names += f.columns
        kv = [F.struct(F.lit(c).alias("k"), F.col(f"`{c}`").cast("bigint").alias("v")) for c in f.columns]
        parts.append(f.select(F.inline(F.array(*kv))))
    kv = parts[0]
    for p in parts[1:]:
        kv = kv.unionByName(p)
    return kv.agg(*[F.max(F.when(F.col("k") == n, F.col("v"))).alias(n) for n in names])


def cdc_reconcile(batch: DataFrame, result: MergeResult, flag: str = DELETE_FLAG) -> DataFrame:
    """Compare a batch's read counts with what the merge did to it.

    Every source row is inserted, updated, deleted or dropped exactly once (unique
    keys), so ``ok_total`` must hold; ``ok_upsert`` is the check "rows read with
    flag false = inserted + updated", which holds when no flag is null.
    """
    reads = batch.agg(
        F.count(F.when(F.col(flag) == F.lit(True), 1)).alias("num_read_deleted_regs"),
        F.count(F.when(F.col(flag) == F.lit(False), 1)).alias("num_read_upsert_regs"),
        F.count(F.when(F.col(flag).isNull(), 1)).alias("num_read_null_flag_regs"),
    )
    both = _one_row_union(reads, result.metrics().drop("num_kept_rows"))
    c = F.col
    return both.select(
        "*",
        (c("num_inserted_rows") + c("num_updated_rows")).alias("upsert_rows"),
        (
            c("num_read_deleted_regs") + c("num_read_upsert_regs") + c("num_read_null_flag_regs")
            == c("num_inserted_rows") + c("num_updated_rows") + c("num_deleted_rows") + c("num_dropped_rows")
        ).alias("ok_total"),
        (c("num_read_upsert_regs") == c("num_inserted_rows") + c("num_updated_rows")).alias("ok_upsert"),
    )


# ---------------------------------------------------------------------------
# End to end: databases -> silver -> data quality -> gold
# ---------------------------------------------------------------------------


def register_external(spark: SparkSession, qualified_name: str, path: str) -> None:
    """(Re)register a parquet folder as a catalog table without rewriting it."""
    drop_table(spark, qualified_name)
    spark.sql(f"CREATE TABLE {qualified_name} USING parquet LOCATION '{path}'")


def create_zone_databases(spark: SparkSession, zones: Zones, databases: Mapping[str, str]) -> None:
    create_databases(spark, {db: f"{getattr(zones, zone, zones.meta)}/_db_{db}" for zone, db in databases.items()})


def register_current(spark: SparkSession, db: str, tables: Mapping[str, VersionedTable]) -> dict[str, DataFrame]:
    """Catalog tables over the latest version of each table that has one."""
    out = {}
    for name, table in tables.items():
        if table.exists():
            register_external(spark, f"{db}.{name}", table.path())
            out[name] = spark.table(f"{db}.{name}")
    return out


def run_cdc_pipeline(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    golds: Sequence[GoldSpec],
    zones: Zones,
    rules: DataFrame,
    as_of: str,
    databases: Mapping[str, str],
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Apply pending changes to silver, check it, merge the gold views; (load log, DQ report).

    ``options`` go to ``cdc_load``.  Silver and gold are in the catalog afterwards.
    """
    create_zone_databases(spark, zones, databases)
    log = cdc_load(spark, specs, zones, **options)
    present = register_current(spark, databases["silver"], {s.name: zones.silver_table(spark, s) for s in specs})
    report = dq_job(spark, present, rules, as_of)
    gold_log = gold_cdc_load(spark, golds, present, zones)
    register_current(spark, databases["gold"], {g.name: zones.gold_table(spark, g) for g in golds})
    return log.unionByName(gold_log), report


def run_full_pipeline(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    golds: Sequence[GoldSpec],
    zones: Zones,
    rules: DataFrame,
    as_of: str,
    databases: Mapping[str, str],
) -> tuple[DataFrame, DataFrame]:
    """Create the zone databases, full-load silver, check it, build gold.

    ``databases`` maps zone ('raw', 'silver', 'gold') to a database name.  Silver
    tables are registered in the catalog over the files the load wrote; the data
    quality sweep checks every configured table that exists there; gold builders
    read the silver tables from the catalog.  Returns (load log, DQ report).
    """
    create_zone_databases(spark, zones, databases)
    log = full_load(spark, specs, zones)
    present = register_current(spark, databases["silver"], {s.name: zones.silver_table(spark, s) for s in specs})
    report = dq_job(spark, present, rules, as_of)
    gold_log = gold_full_load(spark, golds, present, zones)
    register_current(spark, databases["gold"], {g.name: zones.gold_table(spark, g) for g in golds})
    return log.unionByName(gold_log), report


# ---------------------------------------------------------------------------
# Loader with rollback (explicit schema, load stamp, restore on failure)
# ---------------------------------------------------------------------------

STATUS_ROLLED_BACK = "Load failed, table rolled back to the last good version"


def load_with_rollback(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    zones: Zones,
    as_of: str,
    lenient: bool = False,
    validate=None,
) -> DataFrame:
    """Load each table from raw with its explicit schema, stamped with ``as_of``.

    The new snapshot is committed as a version; then the rows stamped ``as_of`` are
    checked against the rows written, and ``validate(df) -> bool`` (optional, e.g. a
    data-quality gate) runs on the new version.  A failed write never becomes
    visible; a failed check makes the last good version current again (by
    re-committing it).  Log columns: TableName, Status, Rows_Loaded, table_version.
    """
    from lakeload.operators.project import filter_load_date, load_stamp
    from lakeload.sources import scan_explicit_schema

    log = []
    for spec in specs:
        table = zones.silver_table(spark, spec)
        good = table.latest_version()
        try:
            raw = scan_explicit_schema(spark, f"{zones.raw}/{spec.path or spec.name}/*", spec)
            stamped = load_stamp(cast_projection(raw, spec, lenient), as_of)
            version, m = table.commit(stamped)
            loaded = filter_load_date(table.read(version), as_of).agg(F.count(F.lit(1)).alias("n")).first()["n"]
            if loaded != m["rows"]:
                raise RuntimeError(f"{spec.name}: {loaded} rows stamped {as_of}, {m['rows']} written")
            if validate is not None and not validate(table.read(version)):
                raise RuntimeError(f"{spec.name}: version {version} failed validation")
            log.append((spec.name, STATUS_LOADED, int(loaded), int(version)))
        except Exception:  # noqa: BLE001
            LOG.exception("%s: load failed", spec.name)
            current, bad = good, table.latest_version()
            if bad != good:
                if good is None:  # a first load: nothing to go back to, so nothing stays readable
                    table.retract(bad)
                else:
                    current = table.restore(good)
            log.append((spec.name, STATUS_ROLLED_BACK, 0, int(current or 0)))
    return spark.createDataFrame(log, "TableName string, Status string, Rows_Loaded bigint, table_version bigint")
