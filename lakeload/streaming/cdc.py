"""Structured Streaming CDC apply.

Raw execution folders are a file stream; each micro-batch is merged into the
versioned table by ``foreachBatch``.  A micro-batch may hold files of several
executions, so the batch is folded per execution id in order (as the batch job
does).  The stream's checkpoint decides which files are new, so files of one
execution may arrive in any number of micro-batches.  What a version has applied is
stored with it (stream, micro-batch number, execution; committed by the same
``_SUCCESS`` marker), so a micro-batch replayed after a failure is a no-op.

``stream_cdc_ordered`` is for files that arrive in any order.  The table keeps for each key
the execution its values are from and the last flag with its execution, deleted keys
included, so a late, older execution never overwrites a newer one and the result does not
depend on the order of arrival.  The file source moves finished files to an archive folder.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from lakeload.functions import all_not_null, any_null, is_small
from lakeload.operators.merge import collapse_changes, merge, repeats_keys
from lakeload.operators.project import cast_projection
from lakeload.plans.jobs import apply_batch, commit_merge
from lakeload.sinks import Ledger, VersionedTable
from lakeload.sources import EXECUTION_COL
from lakeload.sources.files import execution_id_of
from lakeload.specs import DELETE_FLAG, EXECUTION, TableSpec


def cdc_stream(
    spark: SparkSession, source_dir: str, spec: TableSpec, flag: str = DELETE_FLAG, max_files: int | None = None, archive_dir: str | None = None
) -> DataFrame:
    """Streaming frame of the raw CDC rows with their execution id; at most ``max_files`` files a micro-batch.

    With ``archive_dir`` the source moves files there once a later micro-batch is committed.
    """
    schema = StructType(spec.schema().fields + [StructField(flag, BooleanType(), True)])
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.parquet(source_dir).withColumn(EXECUTION_COL, execution_id_of(F.col("_metadata.file_path")))


def stream_cdc_apply(
    spark: SparkSession,
    source_dir: str,
    spec: TableSpec,
    table: VersionedTable,
    ledger: Ledger,
    checkpoint: str,
    flag: str = DELETE_FLAG,
    max_files_per_trigger: int | None = None,
    collapse: bool = False,
) -> None:
    """Apply every available CDC file to ``table`` and stop (``availableNow``).

    With ``collapse`` the executions of a micro-batch are reduced to one net change
    per key and merged in one job (one table rewrite per micro-batch).
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        done = table.applied_batches()  # recorded atomically with each table version
        ids = sorted(r[EXECUTION_COL] for r in batch.select(EXECUTION_COL).distinct().collect())
        marks = {ex: f"{stream_id}/{batch_id}/{ex}" for ex in ids}
        ids = [ex for ex in ids if marks[ex] not in done]
        if not ids:
            return
        typed = cast_projection(batch.filter(F.col(EXECUTION_COL).isin(*ids)), spec, keep=(flag, EXECUTION_COL))
        if collapse and not repeats_keys(typed, spec.keys, [EXECUTION_COL]):
            if not table.exists():
                table.commit(typed.filter(F.col(EXECUTION_COL) == ids[0]).drop(flag, EXECUTION_COL))
            net = collapse_changes(typed, spec.keys, [EXECUTION_COL], spec.load_type, flag).drop(EXECUTION_COL)
            small = is_small(typed)  # bounds the net change (never larger than the raw rows)
            base = table.latest_version()
            version, m = commit_merge(
                table, merge(table.read(base), net, spec.keys, spec.load_type, flag=flag, small_source=small), list(marks.values()), base
            )
            ledger.record_many(spec.name, ids, version, m["num_inserted_rows"], m["num_updated_rows"], m["num_deleted_rows"])
            return
        for ex in ids:
            part = batch.filter(F.col(EXECUTION_COL) == ex).drop(EXECUTION_COL)
            m = apply_batch(spark, table, spec, part, flag=flag, batch_ids=[marks[ex]])
            ledger.record(spec.name, ex, m["version"], m["num_inserted_rows"], m["num_updated_rows"], m["num_deleted_rows"])

    stream_id = "stream-" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    stream = cdc_stream(spark, source_dir, spec, flag, max_files_per_trigger)
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = writer.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


FLAG_EXECUTION = "_flag_execution"


def key_states(rows: DataFrame, spec: TableSpec, flag: str = DELETE_FLAG) -> DataFrame:
    """One state a complete key from rows (typed columns, ``flag``, ``_execution``, ``_flag_execution``).

    Values come from the last execution, the flag from the last execution that has one (null
    says nothing of whether the key exists).  Both are maxima, so states can be
    merged again, in any order and any number of times.  Rows with a null key stay rows.
    """
    keys, others = list(spec.keys), [c for c in spec.fields if c not in spec.keys]
    at, flag_at = F.col(EXECUTION), F.when(F.col(flag).isNotNull(), F.col(FLAG_EXECUTION))
    # equal executions (a key twice in one batch): the greatest values, so that the order of rows never matters
    last = F.max(F.struct(at.alias("at"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("v")))
    told = F.max(F.when(flag_at.isNotNull(), F.struct(flag_at.alias("at"), F.col(flag).alias("f"))))
    merged = rows.filter(all_not_null(keys)).groupBy(*keys).agg(last.alias("__v"), told.alias("__f"))
    merged = merged.select(
        *[F.col(f"`{c}`") if c in keys else F.col("__v")["v"][c].alias(c) for c in spec.fields],
        F.col("__f")["f"].alias(flag), F.col("__v")["at"].alias(EXECUTION), F.col("__f")["at"].alias(FLAG_EXECUTION),
    )
    return merged.unionByName(rows.filter(any_null(keys)).select(*merged.columns))


def current_rows(states: DataFrame, spec: TableSpec, flag: str = DELETE_FLAG) -> DataFrame:
    """The table behind key states: keys whose last flag says that they exist."""
    return states.filter(F.col(flag) == F.lit(False)).select(*[F.col(f"`{c}`") for c in spec.fields])


def stream_cdc_ordered(
    spark: SparkSession,
    source_dir: str,
    spec: TableSpec,
    states: VersionedTable,
    checkpoint: str,
    archive_dir: str | None = None,
    flag: str = DELETE_FLAG,
    max_files_per_trigger: int | None = None,
) -> None:
    """Merge every available CDC file into the key states and stop; ``current_rows`` is the table.

    Executions compare by name.  A micro-batch is one merge and one version, whatever
    executions its files belong to.
    """
    stream_id = "ordered-" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def apply(batch: DataFrame, batch_id: int) -> None:
        mark = f"{stream_id}/{batch_id}"
        if mark in states.applied_batches():
            return
        typed = cast_projection(batch.withColumn(EXECUTION, F.col(EXECUTION_COL)), spec, keep=(flag, EXECUTION))
        new = typed.withColumn(FLAG_EXECUTION, F.when(F.col(flag).isNotNull(), F.col(EXECUTION)))
        new = new.filter(all_not_null(spec.keys) | (F.col(flag) == F.lit(False)))  # a null key can only be inserted
        base = states.latest_version()
        rows = new if base is None else states.read(base).select(*new.columns).unionByName(new)
        states.commit(key_states(rows, spec, flag), batch_ids=[mark], base_version=base)

    stream = cdc_stream(spark, source_dir, spec, flag, max_files_per_trigger, archive_dir)
    q = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


__all__ = ["cdc_stream", "current_rows", "key_states", "stream_cdc_apply", "stream_cdc_ordered"]
