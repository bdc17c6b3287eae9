"""SimHash near-duplicates: 64-bit fingerprints that differ in at most two bits are linked.

Method.  A fingerprint is read as eight positional bytes.  Two flipped bits touch at
most two bytes, so a pair to be linked shares at least six of the eight
(``MIN_SHARED``).  The inverted index is over byte positions: with four blocks of two
positions each, two blocks at least are whole, so every fingerprint is posted under the
six choices of two blocks (four positional bytes a key).  Fingerprints of one posting
list are paired, the positional bytes each pair shares are tallied, pairs below
``MIN_SHARED`` go, and the rest are verified by counting the differing bits.

Skew.  Equal fingerprints are one node, so copies never pair up.  Only lists of at most
``POSTING`` fingerprints are paired, so a row meets a bounded number of others.  For a
longer list every member is posted under itself and its 64 one-bit neighbours: members
that meet there differ in two bits at most, and two members of the list within two bits
meet at the word between them, so a link from each to the smallest one there, tallied and
verified like any other pair, joins all of them.  That is linear in the rows (65 a
member) and no list is held by one task; no link between different components is lost.

Cases.  Null or empty text, or text without words: fingerprint zero, linked like any
other.  Fewer words than a shingle: the whole sequence is one shingle.  Ties: a bit set in
exactly half the hashes is 0; the smallest id names a component.  Repeated rows: every row
is returned.  Null ids: returned with the component of their fingerprint, null where no
member has an id.  Long texts are read whole, ``BLOCK_BYTES`` at a time.  Empty table: no
rows.  Only the id and text columns are read, so other columns may have any name; ids may be
of any type that has an order.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakeload.llm.graph import components, scratch, stage
from lakeload.llm.text import lean

SEED = 42
#: Differing bits up to which fingerprints link.
MAX_BITS = 2
#: Positional bytes that two such fingerprints share at least.
MIN_SHARED = 8 - MAX_BITS
#: Fingerprints of a posting list that are paired directly.
POSTING = 32
#: Bytes of a text that are cut into words at once.
BLOCK_BYTES = 1 << 20

_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def _word_blocks(text: bytes):
    """The words of a text in runs; a run ends where a word ends."""
    at = 0
    while at < len(text):
        stop = _BLANK.search(text, min(at + BLOCK_BYTES, len(text)))
        upto = stop.start() if stop else len(text)
        yield text[at:upto].split()
        at = upto


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, joined by one blank."""
    joined, one = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - size + 1
    return np.fromiter((one(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist())), np.uint64, n)


def fingerprint(text: bytes, size: int = 3) -> int:
    """The fingerprint of a UTF-8 text as an unsigned number."""
    ones, n, held = np.zeros(64, np.int64), 0, []
    for words in _word_blocks(text.lower()):
        held += words
        if len(held) >= size:
            h = _hashes(held, size)
            ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n, held = n + len(h), held[len(held) - size + 1 :]
    if n == 0 and held:
        return xxhash.xxh64_intdigest(b" ".join(held), SEED)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    def run(batches):
        for b in batches:
            found = (fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", size) for x in b.column(1))
            prints = np.fromiter(found, np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view(np.int64))], names=["id", "fp"])

    return run


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(id, fp)`` of every row; ``fp`` is the fingerprint's 64 bits as a long."""
    kind = documents.schema[id_col].dataType
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return docs.mapInArrow(lean(_fingerprints(size)), StructType([StructField("id", kind), StructField("fp", LongType())]))


def _posting_keys(fp: Column) -> Column:
    """The six index keys: two of the four 16-bit blocks and their number."""
    block = [F.shiftrightunsigned(fp, 16 * i).bitwiseAND(0xFFFF) for i in range(4)]
    return F.array(*[F.lit(k << 32) + F.shiftleft(block[i], 16) + block[j] for k, (i, j) in enumerate(combinations(range(4), 2))])


def _shared_bytes(a: Column, b: Column) -> Column:
    """How many of the eight positional bytes are equal."""
    differ = a.bitwiseXOR(b)
    return sum(((F.shiftrightunsigned(differ, 8 * p).bitwiseAND(0xFF)) == 0).cast("int") for p in range(8))


def _confirmed(pairs: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` that pass the count filter and differ in ``MAX_BITS`` bits at most."""
    a, b = F.col("a"), F.col("b")
    return pairs.where(_shared_bytes(a, b) >= MIN_SHARED).where(F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS).distinct()


def links(prints: DataFrame) -> DataFrame:
    """``(a, b)`` links between distinct fingerprints ``fp`` that give the components of all pairs within two bits."""
    posts = prints.select("fp", F.explode(_posting_keys(F.col("fp"))).alias("key"))
    lists = stage(posts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-lists")
    met = stage(posts.join(lists, "key"), "simhash-met")
    short = met.where(F.col("n") <= POSTING)
    pairs = short.select("key", F.col("fp").alias("a")).join(short.select("key", F.col("fp").alias("b")), "key").where("a < b").select("a", "b")
    words = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(-(1 << 63) if i == 63 else 1 << i).cast("long")) for i in range(64)])
    near = met.where(F.col("n") > POSTING).select("fp").distinct().select("fp", F.explode(words).alias("word"))
    hubs = stage(near.groupBy("word").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").select("word", "a"), "simhash-hubs")
    stars = near.join(hubs, "word").where("a <> fp").select("a", F.col("fp").alias("b")).distinct()
    return _confirmed(pairs.union(stars))


def simhash_classes(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """Per row: id, ``fp`` and ``component_id``, the smallest id reachable by links (its own fingerprint included)."""
    with scratch(documents.sparkSession) as keep:
        docs, named = _named(documents, id_col, text_col, size)
        keep(docs, named)
    return docs.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def _named(documents: DataFrame, id_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """Written ``(id, fp)`` and ``(fp, component_id)``."""
    spark = documents.sparkSession
    docs = stage(fingerprints(documents, id_col, text_col, size), "simhash-prints")
    nodes = stage(docs.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    roots = stage(components(spark, links(nodes)).withColumnRenamed("node", "fp"), "simhash-roots")
    rooted = stage(nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return docs, stage(rooted.select("fp", "root").join(stage(names, "simhash-names"), "root").select("fp", "component_id"), "simhash-named")
