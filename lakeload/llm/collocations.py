"""Phrase collocations of two and three words, counted in counting quotient filters.

Method.  Texts are lower-cased (A-Z), split at punctuation and line ends into pieces and at
blanks into words.  A chunk (some texts of one language) keeps its words once, as a local
dictionary, and its tokens as places in it.  Words with ``min_count`` occurrences in
their language get a global id: no phrase of a rarer word can be a candidate.  A chunk is
then a shard, where its tokens meet the ids of its words: its n-grams of frequent words, packed as word ids, go into a
counting quotient filter (``quotient_filter``), cut into blocks by the leading bits of the
permuted keys.  The sorted filters of a block are merged across shards, and what reaches
``min_count`` is read back exactly from quotient and remainder.  Scores are whole-number
divisions of decimals, so they are exact beyond 64 bits.

Memory.  A row is a word of a chunk or a run of its tokens, never a whole chunk, and texts come in
batches of few rows: neither the JVM's heap nor its buffers hold more than that of a chunk,
however many chunks a partition has.  A task of Python holds a chunk and what is short of one.

Skew.  Permuted keys are dealt out evenly whatever the language or phrase, and a
phrase has one entry a shard; blocks are made for about ``BLOCK_ENTRIES`` entries each.  A word
has one dictionary row a chunk, and every table joined by word is a written one, so
AQE may split a frequent word.  Nothing is broadcast or pruned.

Cases.  Null language: ``und`` (one with a language of that name).  Null or empty text, or
one without words: adds nothing.  Repeated rows count each time.  Long texts are read whole
(one chunk holds one text at least).  Ties: equal scores go by occurrences, then by
the phrase's bytes; equal cuts go to the first.  Empty table: no rows.  Only the text and
language columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeload.llm import quotient_filter as qf
from lakeload.llm.graph import stage
from lakeload.llm.text import LOWER, byte_set, chunks, lean, trim, words

#: Characters that end a piece: ``[.,;:!?\x0A-\x0D]``.
SPLITTERS = byte_set((0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))
#: Characters that end a word: a splitter, a blank or a tab.
BREAKS = SPLITTERS | byte_set((0x20, 0x20), (0x09, 0x09))
#: Text bytes of a chunk.
CHUNK_BYTES = 2 << 20
#: Text bytes that a task keeps over all languages until they fill a chunk.
HELD_BYTES = 8 * CHUNK_BYTES
#: Tokens of a row.
RUN_TOKENS = 1 << 16
#: Rows and bytes of a batch of texts, each with Spark's own default.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("1000", "10000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("8388608b", "67108864b")}
#: Filter entries a merging task is meant to hold.
BLOCK_ENTRIES = 1 << 20
#: Number ranges of word ids that are counted side by side.
ID_RANGES = 256

#: A word (its place in the chunk, its occurrences) or a run of tokens (its number, how many they are).
_CHUNKS = "chunk long, lang string, place int, n long, word binary, tokens binary"


def _local(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array] | None:
    """``(tokens, words)``: 1-based places in ``words``, negative at the start of a piece; None without words."""
    low = LOWER[data]
    start, end, doc = words(low, offsets, BREAKS)
    if not len(start):
        return None
    kept = np.ascontiguousarray(low[~BREAKS[low]])
    ends = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    spelled = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(kept)]).dictionary_encode()
    piece = np.cumsum(SPLITTERS[low])[start]
    first = np.ones(len(start), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (piece[1:] != piece[:-1])
    tokens = spelled.indices.to_numpy() + 1
    return np.where(first, -tokens, tokens).astype(np.int32), spelled.dictionary


def _texts(batches) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """``(lang, bytes, offsets)`` of each chunk; what does not fill one waits for the next batch."""
    held: dict[str, pa.Array] = {}
    for b in batches:
        lang, text = b.column(0).dictionary_encode(), b.column(1)
        code = lang.indices.to_numpy()
        for k, name in enumerate(lang.dictionary.to_pylist()):
            own = text.take(pa.array(np.flatnonzero(code == k)))
            own = pa.concat_arrays([held[name], own]) if name in held else own
            *full, last = chunks(own, CHUNK_BYTES)
            for _, _, data, offsets in full:
                yield name, data, offsets
            held[name] = pa.concat_arrays([own.slice(last[0])])
        if sum(x.nbytes for x in held.values()) > HELD_BYTES:
            yield from _rest(held)
            held = {}
    yield from _rest(held)


def _rest(held: dict[str, pa.Array]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    for name, own in held.items():
        for _, _, data, offsets in chunks(own, CHUNK_BYTES):
            yield name, data, offsets


def _rows(chunk: int, lang: str, **cols) -> pa.RecordBatch:
    n = len(cols["place"])
    schema = pa.schema({"chunk": pa.int64(), "lang": pa.string(), "place": pa.int32(), "n": pa.int64(), "word": pa.binary(), "tokens": pa.binary()})
    cols |= {"chunk": pa.repeat(pa.scalar(chunk), n), "lang": pa.repeat(lang, n)}
    return pa.RecordBatch.from_arrays([cols[f.name].cast(f.type) if f.name in cols else pa.nulls(n, f.type) for f in schema], schema=schema)


def _chunk_task(batches):
    made = TaskContext.get().partitionId() << 32
    for lang, data, offsets in _texts(batches):
        found = _local(data, offsets)
        if found is None:
            continue
        tokens, spelled = found
        counts = np.bincount(np.abs(tokens) - 1, minlength=len(spelled))
        yield _rows(made, lang, place=pa.array(np.arange(len(spelled))), n=pa.array(counts), word=spelled)
        runs = np.split(tokens, range(RUN_TOKENS, len(tokens), RUN_TOKENS))
        packed = pa.array([pa.compress(np.ascontiguousarray(x, "<i4"), "zstd", asbytes=True) for x in runs], pa.binary())
        yield _rows(made, lang, place=pa.array(np.arange(len(runs))), n=pa.array([len(x) for x in runs]), tokens=packed)
        made += 1


def _grams(tokens: np.ndarray, ids: np.ndarray, bits: int) -> qf.Keys:
    """Keys of the 2- and 3-word phrases of frequent words; ``ids`` gives each local word its id, 0 for none."""
    w = ids[np.abs(tokens) - 1]
    joined = (tokens[1:] > 0) & (w[1:] > 0) & (w[:-1] > 0)
    two = np.flatnonzero(joined)
    three = np.flatnonzero(joined[1:] & joined[:-1])
    none = np.zeros(len(two), np.int64)
    pairs, triples = qf.pack(w[two], w[two + 1], none, bits), qf.pack(w[three], w[three + 1], w[three + 2], bits)
    return tuple(np.concatenate(x) for x in zip(pairs, triples))


def _filters(bits: int, block_bits: int):
    h = qf.half_bits(bits)
    schema = pa.schema({"lang": pa.string(), "block": pa.int32(), "filter": pa.binary()})

    def run(runs: pa.Table, known: pa.Table) -> pa.Table:
        runs = runs.sort_by("place").combine_chunks()
        packed = zip(runs.column("tokens"), runs.column("n").to_pylist())
        tokens = np.concatenate([np.zeros(0, "<i4"), *(np.frombuffer(pa.decompress(x.as_buffer(), 4 * n, "zstd"), "<i4") for x, n in packed)])
        lut = np.zeros(np.abs(tokens).max(initial=0), np.int64)
        lut[known.column("place").to_numpy()] = known.column("id").to_numpy()
        hi, lo, n = qf.tally(*qf.permute(*_grams(tokens, lut, bits), h), None, h)
        found = list(qf.split(hi, lo, n, h, block_bits))
        out = {"lang": [runs.column("lang")[0].as_py()] * len(found) if found else [], "block": [x[0] for x in found], "filter": [x[2] for x in found]}
        out = pa.table(out, schema)
        del hi, lo, n, found, tokens, lut
        trim()
        return out

    return run


def _merge(bits: int, block_bits: int, min_count: int):
    h = qf.half_bits(bits)

    def run(table: pa.Table) -> pa.Table:
        blobs = (x.as_buffer() for x in table.column("filter"))
        hi, lo, n = qf.merged(blobs, h, block_bits)
        often = n >= min_count
        w1, w2, w3 = qf.unpack(*qf.unpermute(hi[often], lo[often], h), bits)
        lang = pa.repeat(table.column("lang")[0], len(w1))
        return pa.table({"lang": lang, "w1": w1, "w2": w2, "w3": w3, "a": n[often]})

    return run


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of texts are those of ``BATCH`` meanwhile, unless the session says otherwise."""
    changed = [k for k, (_, default) in BATCH.items() if spark.conf.get(k, default) == default]
    try:
        for k in changed:
            spark.conf.set(k, BATCH[k][0])
        yield
    finally:
        for k in changed:
            spark.conf.unset(k)


def _score(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 a a / (left right))`` in whole decimals."""
    a, left, right = (x.cast("decimal(19,0)") for x in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def _words(table: DataFrame, n: int) -> DataFrame:
    return table.select("lang", F.col("id").alias(f"w{n}"), F.col("word").alias(f"t{n}"), F.col("n").alias(f"n{n}"))


def collocations(documents: DataFrame, *, min_count: int = 10, top: int = 2000, absorb_percent: int = 50, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of two words goes when a candidate of three words holds it and has
    ``absorb_percent`` of its occurrences.
    """
    docs = documents.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text"))
    with _small_batches(documents.sparkSession):
        table = stage(docs.where(F.length("text") > 0).mapInArrow(lean(_chunk_task), _CHUNKS), "phrase-chunks")
    runs = table.where("tokens IS NOT NULL").select("chunk", "lang", "place", "n", "tokens")
    totals = stage(runs.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    met = table.where("word IS NOT NULL").select("chunk", "lang", "place", "word", "n")
    often = met.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    often = often.withColumn("range", F.pmod(F.xxhash64("word"), F.lit(ID_RANGES)))
    place = F.row_number().over(Window.partitionBy("lang", "range").orderBy("word"))
    known = stage(often.select("lang", "word", "n", ((place - 1) * ID_RANGES + F.col("range") + 1).alias("id")), "phrase-words")

    size = known.agg(F.max("id")).first()[0] or 1
    tokens = totals.agg(F.sum("n")).first()[0] or 0
    bits = int(size).bit_length()
    if bits > qf.MAX_BITS:
        raise ValueError(f"{size} word ids do not fit {qf.MAX_BITS} bits")
    block_bits = min(qf.half_bits(bits), max(0, (2 * int(tokens) // BLOCK_ENTRIES).bit_length()))

    ids = met.select("chunk", "lang", "place", "word").join(known.select("lang", "word", "id"), ["lang", "word"])
    ids = ids.select(F.col("chunk").alias("shard"), F.col("place").alias("place"), "id")
    filters = runs.groupBy("chunk").cogroup(ids.groupBy("shard")).applyInArrow(_filters(bits, block_bits), "lang string, block int, filter binary")
    grams = filters.groupBy("lang", "block").applyInArrow(_merge(bits, block_bits, min_count), "lang string, w1 long, w2 long, w3 long, a long")
    grams = stage(grams.hint("rebalance", "w1", "w2", "w3"), "phrase-grams")  # a file for some MB, not one for each merging task

    pairs, triples = grams.where("w3 = 0"), grams.where("w3 > 0")
    inside = triples.select("lang", "a", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"))
    inside = inside.groupBy("lang", F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2")).agg(F.max("a").alias("longer"))
    kept = pairs.join(inside, ["lang", "w1", "w2"], "left").where(F.coalesce(100 * F.col("longer") < absorb_percent * F.col("a"), F.lit(True)))
    two = kept.join(_words(known, 1), ["lang", "w1"]).join(_words(known, 2), ["lang", "w2"])
    two = two.select("lang", F.concat_ws(" ", F.col("t1").cast("string"), F.col("t2").cast("string")).alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"))

    three = triples.join(_words(known, 1), ["lang", "w1"]).join(_words(known, 2).drop("n2"), ["lang", "w2"]).join(_words(known, 3), ["lang", "w3"])
    three = three.join(pairs.select("lang", "w1", "w2", F.col("a").alias("f12")), ["lang", "w1", "w2"])
    three = three.join(pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23")), ["lang", "w2", "w3"])
    first = _score(F.col("a"), F.col("n1"), F.col("f23")) <= _score(F.col("a"), F.col("f12"), F.col("n3"))
    spelled = F.concat_ws(" ", *[F.col(t).cast("string") for t in ("t1", "t2", "t3")])
    three = three.select("lang", spelled.alias("phrase"), "a", F.when(first, F.col("n1")).otherwise(F.col("f12")).alias("l"), F.when(first, F.col("f23")).otherwise(F.col("n3")).alias("r"))

    scored = two.unionByName(three).withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
