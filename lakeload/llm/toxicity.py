"""Toxicity by averaged subword embeddings and a linear softmax.

Method.  A text is cut into runs of ``SEGMENT`` words.  A run is the bag of the 3-,
4- and 5-byte n-grams of its words (one blank may stand at either end, so word
starts and ends count); each hashed n-gram has an embedding, the bag is their
average, and a linear softmax turns it into two class scores.  Only n-grams whose
share of documents differs between the labels beyond chance (``MIN_Z`` standard
errors, ``MIN_DOCS`` documents) have an embedding; others are not part of a bag.  A text counts as its
most toxic run, so that a few words in a long text are not averaged away.
Embeddings and softmax are trained jointly in numpy, with the maximum over runs
softened; misspellings share most n-grams with the words learned.

Training takes a bounded sample: about ``per_class`` labelled rows of label 1 and
three times as many of label 0, whole texts, in one task.

Cases.  Null or empty text or text without words: score 0.  No labelled rows, or
one label only: that label for every text with words (0 without labels).  Null
labels or ids are not learned from; of a repeated label row one counts.  Repeated
documents get equal scores.  Empty table: empty result.  Only the named columns are
read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.graph import stage
from lakeload.llm.text import LOWER, byte_set, chunks

SEGMENT = 64
BUCKETS = 1 << 20
WIDTH = 8
MIN_Z, MIN_DOCS = 4.5, 3
#: Controls and ASCII punctuation part words; digits and all other bytes belong to them.
_FOLD = LOWER.copy()
_FOLD[byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))] = 0x20


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bucket, run, doc of each run)``: hashed n-grams and the run each one is in.

    Texts are padded with a blank on both sides, so edges count as word ends.
    """
    n = len(offsets) - 1
    size = np.diff(offsets)
    pad = np.full(len(data) + 2 * n, 0x20, np.uint8)
    to = np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, size)
    pad[to] = _FOLD[data]
    inside = pad != 0x20
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    count = np.cumsum(first)  # words begun so far
    begin = offsets[:-1] + 2 * np.arange(n)
    before = np.concatenate([[0], count])[begin]
    words = np.concatenate([[0], count])[begin + size + 2] - before
    runs = -(-words // SEGMENT)
    base = np.cumsum(runs) - runs
    doc_of = np.repeat(np.arange(n), size + 2)
    word = np.maximum(count - before[doc_of] - 1, 0)  # a blank before the first word goes with it
    run = np.minimum(base[doc_of] + word // SEGMENT, int(runs.sum()) - 1)
    wide = pad.astype(np.uint64)
    buckets, where = [], []
    packed, blank = wide, ~inside
    inner = np.ones(len(pad), bool)  # no blank after the first byte
    for k in range(1, 5):
        packed = (packed[:-1] << np.uint64(8)) | wide[k:]
        if k >= 2:
            inner = inner[:-1] & inside[k - 1 : -1] if k > 2 else inside[1:-1]
            m = k + 1
            both = inner & ~(blank[: len(inner)] & blank[k:] & (m <= 2))
            with np.errstate(over="ignore"):
                h = ((packed[both] + np.uint64(m) * np.uint64(0x100000001B3)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
            buckets.append(h.astype(np.uint32))
            where.append(run[k - 1 : len(pad) - 1][both])  # the run of the byte before the last
    doc = np.repeat(np.arange(n), runs)
    return np.concatenate(buckets), np.concatenate(where), doc


def telling(bags: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """Buckets whose share of documents differs between the labels beyond chance."""
    in1, both = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bag, y in zip(bags, label):
        seen = np.unique(bag)
        both[seen] += 1
        in1[seen] += y
    n1, n0 = max(int(label.sum()), 1), max(int((1 - label).sum()), 1)
    p = both / (n1 + n0)
    error = np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
    z = (in1 / n1 - (both - in1) / n0) / error
    return np.flatnonzero((np.abs(z) >= MIN_Z) & (both >= MIN_DOCS))


def fit(bags: list[np.ndarray], sizes: list[np.ndarray], label: np.ndarray, steps: int = 200, seed: int = 0) -> dict:
    """Embeddings and softmax from the bags of documents; ``sizes`` cuts a bag into its runs.  Classes weigh the same."""
    kept = telling(bags, label)
    number = np.full(BUCKETS, -1, np.int32)
    number[kept] = np.arange(len(kept))
    doc = np.repeat(np.arange(len(bags)), [len(x) for x in sizes])
    features, runs, base = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
    for bag, size in zip(bags, sizes):
        f = number[bag]
        at = f >= 0
        features.append(f[at])
        runs.append(np.repeat(base + np.arange(len(size)), size)[at])
        base += len(size)
    feature, run = np.concatenate(features), np.concatenate(runs)
    per = 1.0 / np.maximum(np.bincount(run, minlength=len(doc)), 1)[run]
    begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    y = label.astype(np.float64)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.1, (len(kept), WIDTH))
    w = rng.normal(0, 0.5, (WIDTH, 2))
    bias = np.zeros(2)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (e, w, bias)]
    for t in range(1, steps + 1):
        d = w[:, 1] - w[:, 0]
        z = np.bincount(run, weights=per * (e @ d)[feature], minlength=len(doc)) + (bias[1] - bias[0])
        soft = np.exp(z - np.maximum.reduceat(z, begin)[doc])
        soft /= np.add.reduceat(soft, begin)[doc]
        pooled = np.add.reduceat(soft * z, begin)
        delta = weight * (1 / (1 + np.exp(-np.clip(pooled, -30, 30))) - y)
        dz = delta[doc] * soft
        g = np.bincount(feature, weights=per * dz[run], minlength=len(kept))
        gw1 = e.T @ g
        grads = (g[:, None] * d[None, :] + 1e-6 * e, np.stack([-gw1, gw1], 1) + 1e-5 * w, np.array([-dz.sum(), dz.sum()]))
        for p, gr, (m, v) in zip((e, w, bias), grads, state):
            m += 0.1 * (gr - m)
            v += 0.01 * (gr * gr - v)
            p -= 0.03 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
    scalar = np.full(BUCKETS, np.nan, np.float32)
    scalar[kept] = e @ (w[:, 1] - w[:, 0])
    return {"scalar": scalar, "bias": float(bias[1] - bias[0]), "kept": kept, "embedding": e, "softmax": w}


def scores(model: dict | None, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of label 1 of each text.

    The softmax of an average is linear before the exponential, so each n-gram's
    embedding enters as one number, its product with the softmax weights.
    """
    n = len(offsets) - 1
    out = np.zeros(n)
    if model is None or not len(data):
        return out
    bucket, run, doc = subwords(data, offsets)
    if not len(doc):
        return out
    if "constant" in model:
        out[doc] = model["constant"]
        return out
    part = model["scalar"][bucket]
    known = ~np.isnan(part)
    run = run[known]
    total = np.bincount(run, weights=part[known], minlength=len(doc))
    z = total / np.maximum(np.bincount(run, minlength=len(doc)), 1) + model["bias"]
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    np.maximum.at(out, doc, p)
    return out


def _sample_rows(batches):
    for b in batches:
        for i, j, data, off in chunks(b.column(0)):
            bucket, run, doc = subwords(data, off)
            order = np.argsort(run, kind="stable")
            bucket, run = bucket[order], run[order]
            cut = np.searchsorted(run, np.arange(len(doc) + 1))
            edge = np.searchsorted(doc, np.arange(j - i + 1))
            bags = [bucket[cut[edge[d]] : cut[edge[d + 1]]].tobytes() for d in range(j - i)]
            lens = [np.diff(cut[edge[d] : edge[d + 1] + 1]).astype(np.uint32).tobytes() for d in range(j - i)]
            yield pa.RecordBatch.from_arrays([b.column(1).slice(i, j - i), b.column(2).slice(i, j - i), pa.array(bags, pa.binary()), pa.array(lens, pa.binary())], names=["id", "label", "bag", "runs"])


def _fit_task(batches):
    rows = sorted(r for b in batches for r in zip(*(b.column(c).to_pylist() for c in range(4))) if r[3])
    if not rows:
        return
    label = np.array([r[1] for r in rows])
    if label.min() == label.max():
        model = {"constant": float(label[0])}
    else:
        model = fit([np.frombuffer(r[2], np.uint32) for r in rows], [np.frombuffer(r[3], np.uint32) for r in rows], label)
        model = {"scalar": model["scalar"], "bias": model["bias"]}
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def train(documents: DataFrame, labels: DataFrame, may_learn: Column, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_class: int = 1000) -> dict | None:
    """A model from a bounded sample of the labelled rows where ``may_learn`` (on the id) holds."""
    known = labels.where(may_learn & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    counts = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    draw = F.pmod(F.xxhash64(F.col("_id"), F.lit("toxicity")), F.lit(1_000_000))
    limit = {k: min(1.0, per_class * (1 if k else 3) / n) * 1e6 for k, n in counts.items()}
    picked = known.where(draw < F.when(F.col("_label") == 1, F.lit(limit.get(1, 0.0))).otherwise(F.lit(limit.get(0, 0.0))))
    picked = stage(picked, "toxicity-picked")  # about four times per_class rows at most: safe to broadcast
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = docs.join(F.broadcast(picked), docs["id"] == picked["_id"]).select("text", "id", F.col("_label").alias("label"))
    bags = stage(rows.mapInArrow(_sample_rows, "id long, label int, bag binary, runs binary"), "toxicity-bags")
    made = bags.repartition(1).mapInArrow(_fit_task, "model binary").first()
    return pickle.loads(made["model"]) if made else None


def _score(model: dict | None):
    def run(batches):
        for b in batches:
            for i, j, data, off in chunks(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(scores(model, data, off))], names=["id", "score"])

    return run


def score_documents(documents: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``score`` (probability of label 1), ``predicted`` (1 from 0.5 on)."""
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = docs.mapInArrow(_score(model), "id long, score double")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
