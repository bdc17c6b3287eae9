"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Method.  Benchmark items become windows of ``window`` consecutive words (a shorter
item is one window).  Windows of one length share a block shift table: for the hash
of a two-word block it holds how far the search may move when that block ends at the
current word; a block in no window moves the whole window length.  Where the shift
is zero, a bucket of windows with that suffix is selected; the first block and then
all word hashes are compared, and the bytes of the words confirm the occurrence.
All documents of a chunk are searched in step, cut into overlapping lanes.

The windows reach the tasks as one block of at most ``block_words`` item words.
A larger benchmark is cut into several blocks by item; each block is searched in
all documents and the few rows with occurrences are merged by document.

Cases.  Null or empty text or text without words: no words, not contaminated.  No
item, or items without words: nothing is hit.  Equal windows of several items count
for each of them; repeated items of one id count once.  Null item ids are left out.
Repeated documents get equal rows.  Only the named columns are read.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.graph import fresh
from lakeload.llm.text import LOWER, NOT_ALNUM, U64, chunks, mix, span_hash, words, lean

#: Words that one lane starts in; longer documents are several lanes.
LANE = 256
BLOCK_WORDS = 500_000


def _two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(a * U64(3) + b)


class Windows:
    """Search tables for windows of one length."""

    def __init__(self, texts: list[bytes], owners: list[list[str]]):
        self.texts, self.owners = texts, owners
        data = np.frombuffer(b"".join(texts), np.uint8)
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        start, end, _ = words(data, off, NOT_ALNUM)
        self.hash = span_hash(data, start, end).reshape(len(texts), -1)
        self.length = m = self.hash.shape[1]
        self.block = min(2, m)
        key = self.keys(self.hash.ravel()).reshape(len(texts), m) if self.block == 1 else _two(self.hash[:, :-1], self.hash[:, 1:])
        bits = max(10, min(22, int(8 * key.size).bit_length()))
        self.mask = U64((1 << bits) - 1)
        self.shift = np.full(1 << bits, m - self.block + 1, np.int64)
        for j in range(key.shape[1]):
            np.minimum.at(self.shift, (key[:, j] & self.mask).astype(np.int64), key.shape[1] - 1 - j)
        by = np.argsort(key[:, -1], kind="stable")
        self.suffix, self.order, self.first = key[by, -1], by, key[:, 0]

    def keys(self, h: np.ndarray) -> np.ndarray:
        """Key of the block that ends at each word (of its document or not)."""
        if self.block == 1:
            return mix(h)
        out = np.zeros(len(h), U64)
        out[1:] = _two(h[:-1], h[1:])
        return out

    def search(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(start word, window)`` of all occurrences; ``first`` cuts the words into documents."""
        m = self.length
        size = np.diff(first)
        lanes = np.maximum(0, -(-(size - m + 1) // LANE))
        doc = np.repeat(np.arange(len(size)), lanes)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        pos = first[doc] + nth * LANE + m - 1
        stop = np.minimum(pos + LANE, first[doc + 1])
        key = self.keys(h)
        step = self.shift[(key & self.mask).astype(np.int64)]
        starts, found = [], []
        while len(pos):
            s = step[pos]
            at = pos[s == 0]
            if len(at):
                lo = np.searchsorted(self.suffix, key[at], side="left")
                n = np.searchsorted(self.suffix, key[at], side="right") - lo
                some = n > 0
                at, lo, n = at[some], lo[some], n[some]
                where = np.repeat(at, n)
                which = self.order[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
                same = key[where - m + self.block] == self.first[which]
                where, which = where[same], which[same]
                if len(where):
                    same = (h[where[:, None] + np.arange(1 - m, 1)] == self.hash[which]).all(axis=1)
                    starts.append(where[same] - m + 1)
                    found.append(which[same])
            pos = pos + np.maximum(s, 1)
            live = pos < stop
            pos, stop = pos[live], stop[live]
        none = np.zeros(0, np.int64)
        return np.concatenate(starts) if starts else none, np.concatenate(found) if found else none


def window_tables(items: list[tuple[str, str]], window: int) -> list[Windows]:
    """Search tables for ``(item id, text)`` rows, one for each window length."""
    by: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        data = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
        start, end, _ = words(data, np.array([0, len(data)]), NOT_ALNUM)
        raw = data.tobytes()
        w = [raw[a:b] for a, b in zip(start, end)]
        for i in range(max(1, len(w) - window + 1) if w else 0):
            part = w[i : i + window]
            by[len(part)][b" ".join(part) + b" "].add(item)
    return [Windows(list(t), [sorted(o) for o in t.values()]) for _, t in sorted(by.items())]


def _scan(tables: list[Windows]):
    """Task: id, n_words, hit spans (word from, word after; merged) and items of each document."""

    def run(batches):
        for b in batches:
            for i, j, data, off in chunks(b.column(1)):
                data = LOWER[data]
                n = j - i
                start, end, doc = words(data, off, NOT_ALNUM)
                first = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int64)
                h = span_hash(data, start, end)
                spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
                items: dict[int, set[str]] = defaultdict(set)
                raw = data.tobytes()
                for t in tables:
                    for s, k in zip(*(x.tolist() for x in t.search(h, first))):
                        text = b" ".join(raw[start[w] : end[w]] for w in range(s, s + t.length)) + b" "
                        if text == t.texts[k]:
                            d = int(doc[s])
                            spans[d].append((s - int(first[d]), s - int(first[d]) + t.length))
                            items[d].update(t.owners[k])
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).slice(i, n),
                        pa.array(np.diff(first)),
                        pa.array([merge(spans[d]) if d in spans else [] for d in range(n)], SPANS),
                        pa.array([sorted(items[d]) if d in items else [] for d in range(n)], pa.list_(pa.string())),
                        b.column(2).slice(i, n),
                    ],
                    names=["id", "n_words", "spans", "items", "key"],
                )

    return run


SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def merge(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Spans (first word, word after) without overlaps, in order; touching spans become one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"first": a, "last": b} for a, b in out]


def _merge_rows(batches):
    for b in batches:
        spans = [merge([(s["first"], s["last"]) for s in row]) for row in b.column("spans").to_pylist()]
        names = ["id", "n_words", "spans", "items", "key"]
        yield pa.RecordBatch.from_arrays([pa.array(spans, SPANS) if c == "spans" else b.column(c) for c in names], names=names)


_ROW = "id long, n_words long, spans array<struct<first: long, last: long>>, items array<string>, key long"


def find_items(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per document: id, ``n_words``, ``spans`` (hit words, merged), ``items`` (sorted ids as strings), ``n_hit``."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")).where("item is not null")
    # An item of w words makes w windows of `window` words at most; a blank is the least that parts two words.
    total = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) / 2 + 1)).first()[0] or 0
    blocks = max(1, int(-(-total // block_words)))
    text = F.col(text_col).cast("string")
    docs = documents.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), (F.xxhash64(text) if blocks > 1 else F.lit(0).cast("long")).alias("key"))
    parts = []
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).collect()  # one block, bounded by block_words
        parts.append(docs.mapInArrow(lean(_scan(window_tables([(r["item"], r["text"]) for r in rows], window))), _ROW))
    out = parts[0]
    if blocks > 1:
        hits = parts[0].where("size(items) > 0")
        for p in parts[1:]:
            hits = hits.union(p.where("size(items) > 0"))
        hits = hits.groupBy("id", "key").agg(
            F.flatten(F.collect_set("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
        )
        base = parts[0].select("id", "key", "n_words")
        hits = hits.select(F.col("id").alias("_id"), F.col("key").alias("_key"), "spans", "items")
        out = base.join(hits, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
        empty = F.array().cast("array<struct<first: long, last: long>>")
        out = out.select("id", "n_words", F.coalesce("spans", empty).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), "key")
        out = out.mapInArrow(lean(_merge_rows), _ROW)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"])
    return out.select(F.col("id").alias(id_col), "n_words", "spans", "items", n_hit.alias("n_hit"))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words", share: int = 20):
    """Contamination rule: some word is hit, and at least one in ``share`` words."""
    return (F.col(n_hit) > 0) & (share * F.col(n_hit) >= F.col(n_words))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``documents`` without contaminated ones.

    Rows are matched by id; a null id is matched with null ids.  Ids that occur more
    than once go together.
    """
    id_col, bad_id = options.get("id_col", "doc_id"), fresh(documents, "bad_id")
    bad = find_items(documents, benchmark, **options).where(contaminated()).select(F.col(id_col).alias(bad_id)).distinct()
    return documents.join(bad, F.col(id_col).eqNullSafe(F.col(bad_id)), "left_anti")
