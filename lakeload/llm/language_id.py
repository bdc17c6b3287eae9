"""Language identification by error-correcting output codes.

Method.  Every language has a codeword of bits; one binary linear classifier on
hashed byte n-grams (1 to 3 bytes) predicts each bit.  A text gets the language
whose codeword has the least logistic loss over all bits, each bit weighted by how
well its classifier separated the training texts (loss-weighted decoding).  The
classifiers are trained jointly in numpy, in one task, on a bounded sample of the
labelled texts: about ``per_language`` rows of each language.

Cases.  Null text or text without a letter of any script: ``und``, score 0, not
ambiguous.  No labelled row: ``und`` for all.  One language learned: that one,
score 1.  Rows with a null label or id are never learned from.  Repeated rows get
equal predictions.  Empty table: empty result.  Only the named columns are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.graph import scratch, stage
from lakeload.llm.text import byte_set, chunks, has_letter, lean

FEATURES = 4096
#: Documents whose features are made at once (8 bytes a feature).
FEATURE_ROWS = 256
#: Bytes that count as one blank: controls, digits and ASCII punctuation.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_FOLD[byte_set((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))] = 0x20


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of hashed n-gram counts, scaled to length 1: one row for each text."""
    n = len(offsets) - 1
    b = _FOLD[data].astype(np.uint32)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets)) * FEATURES
    out = np.bincount(doc + (b * np.uint32(2654435761) >> np.uint32(20)), minlength=n * FEATURES)
    h = b
    for k in (1, 2):
        h = h[:-1] * np.uint32(0x01000193) + b[k:] + np.uint32(k)
        same = doc[k:] == doc[:-k]
        out += np.bincount((doc[k:] + (h * np.uint32(2654435761) >> np.uint32(20)))[same], minlength=n * FEATURES)
    x = np.sqrt(out.reshape(n, FEATURES).astype(np.float32))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6)


def codebook(k: int) -> np.ndarray:
    """Codewords of -1 and 1, a row for each of ``k`` classes.

    Up to seven classes: all splits of the classes in two.  More: seeded random
    words of ``10 log2 k`` bits, the draw with the largest least distance.
    """
    if k <= 7:
        bits = max(1, 2 ** (k - 1) - 1)
        return np.array([[1 if not c or (b >> (c - 1)) & 1 == 0 else -1 for b in range(1, bits + 1)] for c in range(k)], dtype=np.int8)
    rng, best, score = np.random.default_rng(k), None, -1
    for _ in range(50):
        m = rng.choice(np.array([-1, 1], np.int8), size=(k, int(np.ceil(10 * np.log2(k)))))
        d = (m[:, None, :] != m[None, :, :]).sum(2) + np.eye(k, dtype=int) * m.shape[1]
        if (np.abs(m.sum(0)) < k).all() and d.min() > score:
            best, score = m, d.min()
    return best if best is not None else m


def fit(x: np.ndarray, labels: list[str], steps: int = 150) -> dict:
    """All bit classifiers at once: logistic loss, Adam on the whole sample."""
    langs = sorted(set(labels))
    code = codebook(len(langs))
    cls = np.array([langs.index(v) for v in labels])
    y = code[cls].astype(np.float32)
    share = np.bincount(cls, minlength=len(langs))
    weight = (1.0 / share[cls] / len(langs)).astype(np.float32)[:, None]
    w = np.zeros((x.shape[1], code.shape[1]), np.float32)
    bias = np.zeros(code.shape[1], np.float32)
    m = [np.zeros_like(w), np.zeros_like(bias)]
    v = [np.zeros_like(w), np.zeros_like(bias)]
    for t in range(1, steps + 1):
        margin = np.clip(y * (x @ w + bias), -30, 30)
        g = -y * weight / (1 + np.exp(margin))
        for i, (p, d) in enumerate(((w, x.T @ g), (bias, g.sum(0)))):
            m[i] = 0.9 * m[i] + 0.1 * d
            v[i] = 0.999 * v[i] + 0.001 * d * d
            p -= 0.3 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    right = (weight * ((y * (x @ w + bias)) > 0)).sum(0)
    bit_weight = np.maximum(right - 0.5, 1e-3)
    return {"langs": langs, "code": code, "w": w, "bias": bias, "bit_weight": bit_weight / bit_weight.sum()}


def decode(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(class, score, gap)``: score in 0..1 from the losses, gap between the two best losses."""
    margin = np.clip(x @ model["w"] + model["bias"], -30, 30)
    loss = np.stack([(np.log1p(np.exp(-margin * c)) * model["bit_weight"]).sum(1) for c in model["code"]], 1)
    best = loss.argmin(1)
    if loss.shape[1] == 1:
        return best, np.ones(len(x)), np.full(len(x), np.inf)
    p = np.exp(-(loss - loss.min(1, keepdims=True)) * 4)
    two = np.partition(loss, 1, axis=1)
    return best, 1.0 / p.sum(1), two[:, 1] - two[:, 0]


def _feature_rows(batches):
    for b in batches:
        for i, j, data, off in chunks(b.column(0), rows=FEATURE_ROWS):
            x = features(data, off).astype(np.float16)
            yield pa.RecordBatch.from_arrays([b.column(1).slice(i, j - i), pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "x"])


def _fit_task(batches):
    rows = [(lang, x) for b in batches for lang, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    if rows:
        rows.sort()
        x = np.stack([np.frombuffer(r[1], np.float16) for r in rows]).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(x, [r[0] for r in rows]))], pa.binary())], names=["model"])


def train(documents: DataFrame, may_learn: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_language: int = 1500) -> dict | None:
    """A model from about ``per_language`` rows of each language where ``may_learn`` holds; None without any."""
    rows = documents.where(may_learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) > 0))
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("language")), F.lit(1_000_000)).alias("draw"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language
    if not counts:
        return None
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, per_language / n) * 1e6)])
    sample = rows.where(F.col("draw") < share[F.col("lang")]).select("text", "lang").mapInArrow(lean(_feature_rows), "lang string, x binary")
    with scratch(documents.sparkSession):
        made = stage(sample, "language-sample").repartition(1).mapInArrow(lean(_fit_task), "model binary").first()
    return pickle.loads(made["model"]) if made else None


def _predict(model: dict | None, min_gap: float):
    def run(batches):
        for b in batches:
            for i, j, data, off in chunks(b.column(1), rows=FEATURE_ROWS):
                n = j - i
                lang, score, unsure = ["und"] * n, np.zeros(n), np.zeros(n, bool)
                if model is not None:
                    read = has_letter(data, off)
                    cls, p, gap = decode(model, features(data, off))
                    lang = [model["langs"][c] if ok else "und" for c, ok in zip(cls, read)]
                    score, unsure = np.where(read, p, 0.0).astype(np.float64), read & (gap < min_gap)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, n), pa.array(lang), pa.array(score), pa.array(unsure)], names=["id", "lang_pred", "score", "ambiguous"])

    return run


def identify(documents: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", min_gap: float = 0.05) -> DataFrame:
    """Per document: id, ``lang_pred``, ``score``, ``ambiguous`` (the two best codewords differ by less than ``min_gap`` in loss)."""
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = docs.mapInArrow(lean(_predict(model, min_gap)), "id long, lang_pred string, score double, ambiguous boolean")
    return out.withColumnRenamed("id", id_col)


def _clear(model: dict | None, min_gap: float):
    """Arrow function: whether the language of a text is clear."""
    predict = _predict(model, min_gap)

    def rows(texts: pa.Array) -> Iterator[bool]:
        two = pa.RecordBatch.from_arrays([pa.nulls(len(texts), pa.int64()), texts], names=["id", "text"])
        for p in predict([two]):
            yield from (lang != "und" and not unsure for lang, unsure in zip(p.column(1).to_pylist(), p.column(3).to_pylist()))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return lean(lambda texts: (pa.array(rows(t), pa.bool_()) for t in texts))(batches)

    return F.arrow_udf(run, "boolean")


def keep_clear(documents: DataFrame, model: dict | None, text_col: str = "text", min_gap: float = 0.05) -> DataFrame:
    """``documents`` without those of no or of ambiguous language; only texts leave the JVM."""
    return documents.where(_clear(model, min_gap)(F.col(text_col).cast("string")))
