"""Token ids in Arrow stream files of equal-length rows, and reading them back without copies.

Format.  Documents are ordered by id and cut into ranges, one pair of Arrow IPC
files for each range.  ``ids-N.arrow`` holds batches of two fixed-size-list
columns: ``ids`` (``seq_len`` ids; 16-bit when the vocabulary allows, else 32-bit)
and ``mask`` (``seq_len`` bits, false on the padding of the last row), so row r
is found at a known place and a memory map reads both without copying.
``docs-N.arrow`` holds the documents of the range: id, place of the first id in the
range, number of ids.  Every document ends with ``end_id``.

A task writes both files under a name of its own attempt and hands that name to the manifest, of
which Spark commits one attempt: a task that runs again after a lost executor
writes other files, and a range is always read from one attempt.  Nothing is renamed, so object
stores serve as well.  Arrow opens the files in the tasks; ``arrow_uri`` qualifies a folder
by Spark's default file system and names it as Arrow does, or says that Arrow has no
client for it.

Cases.  Null or empty text: the end id only.  Ids that are null come first.  Rows of equal id
are ordered by text (null first).  Repeated rows: each is written.  Empty table: no rows.  Long
texts are encoded whole.  Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import uuid
import zlib
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeload.functions.sizing import input_bytes
from lakeload.llm.graph import stage
from lakeload.llm.text import lean
from lakeload.llm.tokens import KEPT, encoded
from lakeload.session import work_dir

#: Rows of a record batch.
BATCH_ROWS = 64
#: Input bytes of a range of documents.
RANGE_BYTES = 64 * 1024 * 1024


#: Hadoop's scheme -> Arrow's, for the file systems that Arrow opens itself.
ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def arrow_uri(spark: SparkSession, folder: str) -> str:
    """``folder`` as Arrow names it: a bare path is one of Spark's default file system, as everywhere in Spark."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.toUri()
    if uri.getScheme() is None:
        uri = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark.sparkContext._jsc.hadoopConfiguration()).resolve(uri)
    return _arrow_name(uri.getScheme(), uri.getRawAuthority(), uri.getPath())


def _arrow_name(scheme: str, authority: str | None, path: str) -> str:
    if scheme == "dbfs":  # mounted on every node
        return f"file:///dbfs{quote(path)}"
    if scheme not in ARROW_SCHEMES:
        known = ", ".join(sorted({*ARROW_SCHEMES, "dbfs"}))
        raise ValueError(f"token files cannot be written to {scheme}:// (Arrow has no client for it); use one of {known}")
    return f"{ARROW_SCHEMES[scheme]}://{authority or ''}{quote(path)}"


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it, for an ``arrow_uri``."""
    return pafs.FileSystem.from_uri(uri)


class _Writer:
    """Cuts a stream of ids into full rows and writes them batch by batch."""

    def __init__(self, sink, seq_len: int, kind):
        self.seq_len, self.kind = seq_len, kind
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.out = pa.ipc.new_file(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= BATCH_ROWS * self.seq_len:
            flat = np.concatenate(self.held)
            full = len(flat) // (BATCH_ROWS * self.seq_len) * BATCH_ROWS * self.seq_len
            for i in range(0, full, BATCH_ROWS * self.seq_len):
                self._batch(flat[i : i + BATCH_ROWS * self.seq_len])
            self.held, self.size = [flat[full:]], len(flat) - full

    def _batch(self, flat: np.ndarray) -> None:
        rows = -(-len(flat) // self.seq_len)
        ids = np.zeros(rows * self.seq_len, self.kind)
        ids[: len(flat)] = flat
        mask = pa.array(np.arange(len(ids)) < len(flat))
        cols = [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.seq_len), pa.FixedSizeListArray.from_arrays(mask, self.seq_len)]
        self.out.write_batch(pa.RecordBatch.from_arrays(cols, schema=self.schema))

    def close(self) -> None:
        if self.size:
            self._batch(np.concatenate(self.held))
        self.out.close()


def _names(top: str, attempt: str) -> dict[str, str]:
    return {k: f"{top}/{k}-{attempt}.arrow" for k in ("ids", "docs")}


def _write(folder: str, path: str, spaced: bool, end_id: int, seq_len: int, kind):
    def run(batches):
        part = TaskContext.get().partitionId()
        fs, top = open_fs(folder)
        fs.create_dir(top, recursive=True)
        attempt = f"{part:06d}-{uuid.uuid4().hex[:8]}"
        names = _names(top, attempt)
        writer, docs_out = None, None
        schema = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])
        total = docs = 0
        for b in batches:
            if writer is None:
                streams = {k: fs.open_output_stream(v) for k, v in names.items()}
                writer, docs_out = _Writer(streams["ids"], seq_len, kind), pa.ipc.new_file(streams["docs"], schema)
            doc_ids = b.column(0)
            for first, ids, off in encoded(path, spaced, b.column(1)):
                n = len(off) - 1
                if len(ids) and int(ids.max()) > np.iinfo(kind).max:
                    raise ValueError("an id does not fit the file's type")
                writer.add(np.insert(ids, off[1:], end_id).astype(kind))  # the end id after each document
                size = np.diff(off) + 1
                starts = total + np.cumsum(size) - size
                docs_out.write_batch(pa.RecordBatch.from_arrays([doc_ids.slice(first, n), pa.array(starts), pa.array(size)], schema=schema))
                total, docs = total + int(size.sum()), docs + n
        if writer is not None:
            writer.close()
            docs_out.close()
            for stream in streams.values():
                stream.close()
            cols = [pa.array([part], pa.int32()), pa.array([attempt]), pa.array([docs], pa.int64()), pa.array([total], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["part", "attempt", "docs", "total"])

    return run


def write_token_files(
    documents: DataFrame,
    folder: str,
    tokenizer_path: str,
    *,
    end_id: int = 2,
    seq_len: int = 2048,
    spaced: bool = True,
    vocabulary: int = 50_257,
    ranges: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the files; ``(part, attempt, docs, total, base)`` for each range, base being the ids of all ranges before it."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    spark = documents.sparkSession
    folder = arrow_uri(spark, folder)
    if ranges is None:
        ranges = max(2 * spark.sparkContext.defaultParallelism, -(-(input_bytes(documents) or 0) // RANGE_BYTES))
    kind = np.dtype(np.uint16 if max(vocabulary, end_id + 1) <= 1 << 16 else np.uint32)
    ordered = docs.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    write = lean(_write(folder, tokenizer_path, spaced, end_id, seq_len, kind), keeps=KEPT)
    made = stage(ordered.mapInArrow(write, "part int, attempt string, docs long, total long"), "token-manifest")
    # One row for each range; a task that ran twice wrote the same row once (Spark commits one attempt).
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("base", F.coalesce(F.sum("total").over(earlier), F.lit(0)).cast("long"))


def read_range(folder: str, attempt: str):
    """``(ids, docs)`` of one range of a manifest: ids batch by batch, without copies where the store maps files."""
    fs, top = open_fs(folder)
    names = _names(top, attempt)
    local = isinstance(fs, pafs.LocalFileSystem) or getattr(fs, "type_name", "") == "local"
    opened = pa.memory_map if local else fs.open_input_file
    ids = pa.ipc.open_file(opened(names["ids"]))
    docs = pa.ipc.open_file(opened(names["docs"])).read_all()
    return ids, docs


def row(reader: pa.ipc.RecordBatchFileReader, r: int) -> tuple[np.ndarray, pa.BooleanArray]:
    """Ids and mask of row ``r`` of an open ids file: views of the mapped file (the mask as Arrow's bits)."""
    b = reader.get_batch(r // BATCH_ROWS)
    ids, mask = b.column(0), b.column(1)
    n = ids.type.list_size
    at = r % BATCH_ROWS
    return ids.values.to_numpy()[at * n : (at + 1) * n], mask.values.slice(at * n, n)


def _read(folder: str):
    def run(batches):
        for b in batches:
            for attempt, base in zip(b.column("attempt").to_pylist(), b.column("base").to_pylist()):
                reader, docs = read_range(folder, attempt)
                yield from _documents(reader, docs, base)

    return run


def _documents(reader, docs: pa.Table, base: int):
    """crc32 of each document's ids, walking the batches once."""
    first, size = docs["first"].to_numpy(), docs["n_tokens"].to_numpy()
    ids = docs["doc_id"].combine_chunks()
    per = BATCH_ROWS * reader.schema.field("ids").type.list_size
    crc = np.zeros(len(first), np.int64)
    at, held = -1, None
    for d in range(len(first)):
        c, p, stop = 0, int(first[d]), int(first[d] + size[d])
        while p < stop:
            if p // per != at:
                at = p // per
                held = reader.get_batch(at).column(0).values.to_numpy()
            upto = min(stop, (at + 1) * per)
            c = zlib.crc32(held[p - at * per : upto - at * per].astype("<u4"), c)
            p = upto
        crc[d] = c
    for i in range(0, len(first), 10_000):
        j = min(len(first), i + 10_000)
        cols = [ids.slice(i, j - i) if not isinstance(ids, pa.ChunkedArray) else ids.slice(i, j - i).combine_chunks(), pa.array(first[i:j] + base), pa.array(size[i:j]), pa.array(crc[i:j])]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files of a manifest."""
    spark = manifest.sparkSession
    spread = manifest.select("part", "attempt", "base").repartition(max(2, spark.sparkContext.defaultParallelism), "part")
    return spread.mapInArrow(lean(_read(arrow_uri(spark, folder))), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(documents: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write to a fresh folder below the checkpoint folder and read back."""
    folder = work_dir(documents.sparkSession, "token-files")
    return read_token_files(write_token_files(documents, folder, tokenizer_path, **options), folder)
