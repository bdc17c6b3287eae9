"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

Method.  The model is over word n-grams of order ``WORD_ORDER`` (hashes of runs without
white space).  Counts of all trusted texts are summed in each task and then across
tasks; lower orders use continuation counts, the number of distinct words before an
n-gram.  Every order has its three discounts from its own counts of counts, and is
interpolated with the order below, down to a uniform distribution over the words and
one unknown word.  An n-gram that was not counted gets its probability through the
weights of its contexts.  A document's perplexity is
the exponential of its mean negative log probability a word.  One in
``HELD_OUT`` trusted texts, by a hash of its id, is left out of the counts and only
sets the thresholds, since a text that was counted looks more likely than it is.
Documents above the ``upper`` quantile of these texts in their language are rejected;
a language with fewer than ``1 / (1 - upper)`` of them, too few for that quantile,
takes the quantile of all languages together.

Passes.  The n-grams of all texts are larger than the texts, so they are worked on in up
to ``PASSES`` passes, each for the n-grams whose middle word has a hash of its range; the
texts are read again and the tables of a pass are deleted before the next.  A pass keeps
together what shares a middle word: counts, contexts, the order below and the n-grams of
the documents meet in one bucket and are summed for each document.  A middle word of more
than ``SLICE_WORDS`` occurrences is spread over several buckets by the word before, and
the order below goes to each of these.  Words whose pair was never counted meet the
unigrams in a join.  ``word_tables`` and ``word_log_probabilities`` are the same model in
whole tables.

Log probabilities are summed as multiples of 1 / ``UNIT``, so the order of rows has no
effect.  ``model_tables`` and ``log_probabilities`` are the same model over bytes.

Cases.  Null text or text without a word: no perplexity, not kept.  No trusted text: no
perplexity, all texts with bytes are kept.  Null language is a language of its own.
Repeated rows get equal results.  Empty table: empty result.  A null id is never
trusted.  Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.sizing import is_small
from lakeload.llm.graph import free_shuffles, release, stage
from lakeload.llm.text import U64, WHITE, chunks, i64, lean, mix, span_hash, words

ORDER = 4
WORD_ORDER = 3
UNIT = 1 << 32
HELD_OUT = 5
#: n-grams held before a task sums them up.
HELD = 4_000_000
#: Passes over the texts at most, and words that are worth a pass of their own.
PASSES = 10
PASS_WORDS = 2_000_000
#: Words of all documents in a bucket of a pass, and occurrences of a middle word in one bucket.
BUCKET_WORDS = 600_000
SLICE_WORDS = 4_000_000
#: n-grams of documents held before a task sends them to their buckets.
SENT = 500_000


def _mask(k: int) -> int:
    return (1 << 8 * k) - 1


def grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """``(n-gram ending at each byte, document)``; bytes before a document count as zero."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    wide = data.astype(np.int64)
    out = wide.copy()
    for k in range(1, order):
        same = doc[k:] == doc[: len(doc) - k]
        out[k:][same] |= wide[: len(wide) - k][same] << np.int64(8 * k)
    return out, doc


def _count(order: int, counted: bool):
    """Task: distinct n-grams of all texts, with counts."""

    def run(batches):
        held, size = [], 0

        def rows():
            g, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return g, np.bincount(at, weights=np.concatenate([h[1] for h in held])).astype(np.int64)

        for b in batches:
            for _, _, data, off in chunks(b.column(0)):
                g, c = np.unique(grams(data, off, order)[0], return_counts=True)
                held.append((g, c))
                size += len(g)
                if size > HELD:
                    held = [rows()]
                    size = len(held[0][0])
        if held:
            g, c = rows()
            for i in range(0, len(g), 100_000):
                cols = [pa.array(g[i : i + 100_000])] + ([pa.array(c[i : i + 100_000])] if counted else [])
                yield pa.RecordBatch.from_arrays(cols, names=["g", "c"][: len(cols)])

    return run


def _discount(c: Column, d: tuple[float, float, float]) -> Column:
    return F.when(c == 1, F.lit(d[0])).when(c == 2, F.lit(d[1])).otherwise(F.lit(d[2]))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three modified Kneser-Ney discounts from counts of counts; 0.5 where they are undefined."""
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2)
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw))


def model_tables(trusted: DataFrame, order: int = ORDER) -> tuple[list[DataFrame], list[DataFrame]] | None:
    """``(probabilities (g, p), context weights (h, w))`` of orders 1.. from (text) rows; None without text."""
    counts = {order: stage(trusted.select("text").mapInArrow(_count(order, True), "g long, c long").groupBy("g").agg(F.sum("c").alias("c")), "lm-counts")}
    for k in range(order - 1, 0, -1):
        counts[k] = stage(counts[k + 1].groupBy(F.col("g").bitwiseAND(F.lit(_mask(k))).alias("g")).agg(F.count(F.lit(1)).alias("c")), "lm-counts")
    of_counts = None
    for k, t in counts.items():
        row = t.agg(F.lit(k).alias("k"), *[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)], F.count(F.lit(1)).alias("n"))
        of_counts = row if of_counts is None else of_counts.union(row)
    stats = {r["k"]: r for r in of_counts.collect()}  # one row for each order
    if not stats[1]["n"]:
        return None
    probs, weights = [], []
    for k in range(1, order + 1):
        r = stats[k]
        d = _discount(F.col("c"), discounts(r["n1"], r["n2"], r["n3"], r["n4"]))
        t = counts[k].select("g", "c", F.shiftright("g", 8).alias("h"), d.alias("d"))
        ctx = stage(t.groupBy("h").agg(F.sum("c").alias("total"), F.sum("d").alias("off")), "lm-contexts")
        t = t.join(ctx, "h")
        if k == 1:
            lower = F.lit(1 / 256)
        else:
            below = probs[-1].toDF("low", "below")
            t = t.withColumn("low", F.col("g").bitwiseAND(F.lit(_mask(k - 1)))).join(below, "low")
            lower = F.col("below")
        p = (F.col("c") - F.col("d")) / F.col("total") + F.col("off") / F.col("total") * lower
        probs.append(stage(t.select("g", p.alias("p")), "lm-probabilities"))
        weights.append(ctx.select("h", (F.col("off") / F.col("total")).alias("w")))
    return probs, weights


def log_probabilities(wanted: DataFrame, probs: list[DataFrame], weights: list[DataFrame]) -> DataFrame:
    """``(g, lp)`` for the n-grams (g) wanted: sharded joins with the tables of every order."""
    order = len(probs)
    out = wanted.select("g")
    for k in range(order, 0, -1):
        gk = F.col("g").bitwiseAND(F.lit(_mask(k)))
        out = out.withColumns({f"g{k}": gk, f"h{k}": F.shiftright(gk, 8)})
        out = out.join(probs[k - 1].toDF(f"g{k}", f"p{k}"), f"g{k}", "left").join(weights[k - 1].toDF(f"h{k}", f"w{k}"), f"h{k}", "left").drop(f"g{k}", f"h{k}")
    p = F.lit(1 / 256)
    for k in range(1, order + 1):
        p = F.coalesce(F.col(f"p{k}"), F.coalesce(F.col(f"w{k}"), F.lit(1.0)) * p)
    return out.select("g", F.log(p).alias("lp"))


def word_columns(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """``(the words of the n-gram ending at each word, document)``; words before a document count as zero."""
    start, end, doc = words(data, offsets, WHITE)
    own = span_hash(data, start, end)
    cols = []
    for k in range(order - 1, 0, -1):
        before = np.zeros(len(own), U64)
        same = doc[k:] == doc[: len(doc) - k]
        before[k:][same] = own[: len(own) - k][same]
        cols.append(before)
    cols.append(own)
    return cols, doc


def gram_hash(cols: list[np.ndarray]) -> np.ndarray:
    g = np.zeros(len(cols[0]), U64)
    for c in cols:
        g = mix(mix(g) + c)
    return g


def pass_of(middle: np.ndarray, passes: int) -> np.ndarray:
    """The pass that works on the n-grams of a middle word."""
    return (middle >> U64(33)) % U64(passes)


def _names(order: int) -> list[str]:
    return [f"w{k}" for k in range(1, order + 1)]


def _count_words(order: int, part: int = 0, passes: int = 1):
    """Task: distinct word n-grams of some texts (the words, count), those of a pass."""
    names = [*_names(order), "c"]

    def rows(held):
        cols = [np.concatenate(x) for x in zip(*held)]
        _, first, at = np.unique(gram_hash(cols[:-1]), return_index=True, return_inverse=True)
        c = np.bincount(at, weights=cols[-1]).astype(np.int64)
        return [*(x[first] for x in cols[:-1]), c]

    def run(batches):
        held, size = [], 0
        for b in batches:
            for _, _, data, off in chunks(b.column(0)):
                cols, _ = word_columns(data, off, order)
                if passes > 1:
                    own = np.flatnonzero(pass_of(cols[-2], passes) == part)
                    cols = [x[own] for x in cols]
                if len(cols[0]):
                    held.append([*cols, np.ones(len(cols[0]), np.int64)])
                    size += len(cols[0])
                if size > HELD // 4:
                    yield from send(rows(held))
                    held, size = [], 0
        if held:
            yield from send(rows(held))

    def send(cols):
        cols = [*map(i64, cols[:-1]), cols[-1]]
        for i in range(0, len(cols[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 100_000]) for x in cols], names=names)

    return lean(run)


def _count_fields(order: int) -> str:
    return ", ".join(f"{n} long" for n in [*_names(order), "c"])


def _near(t: DataFrame) -> DataFrame:
    return F.broadcast(t) if is_small(t) else t


def word_tables(trusted: DataFrame, order: int = WORD_ORDER) -> tuple[list[DataFrame], list[DataFrame], float] | None:
    """``(probabilities (words, p) of orders 1.., context weights (words, w) of orders 2.., p of an unknown word)``; None without a word."""
    names = _names(order)
    found = trusted.select("text").mapInArrow(_count_words(order), _count_fields(order))
    counts = {order: stage(found.groupBy(names).agg(F.sum("c").alias("c")), "lm-counts")}
    for k in range(order - 1, 0, -1):
        counts[k] = stage(counts[k + 1].groupBy(names[-k:]).agg(F.count(F.lit(1)).alias("c")), "lm-counts")
    of_counts = None
    for k, t in counts.items():
        row = t.agg(F.lit(k).alias("k"), *[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)], F.count(F.lit(1)).alias("n"), F.sum("c").alias("total"))
        of_counts = row if of_counts is None else of_counts.union(row)
    stats = {r["k"]: r for r in of_counts.collect()}  # one row for each order
    if not stats[1]["n"]:
        return None
    probs, weights, unknown = [], [], 0.0
    for k in range(1, order + 1):
        r = stats[k]
        cut = discounts(r["n1"], r["n2"], r["n3"], r["n4"])
        t = counts[k].withColumn("d", _discount(F.col("c"), cut))
        if k == 1:
            off = cut[0] * r["n1"] + cut[1] * r["n2"] + cut[2] * (r["n"] - r["n1"] - r["n2"])
            unknown = off / r["total"] / (r["n"] + 1)
            p = (F.col("c") - F.col("d")) / F.lit(r["total"]) + F.lit(unknown)
        else:
            ctx = stage(t.groupBy(names[-k:-1]).agg(F.sum("c").alias("total"), F.sum("d").alias("off")), "lm-contexts")
            weights.append(ctx.select(*names[-k:-1], (F.col("off") / F.col("total")).alias("w")))
            t = t.join(_near(ctx), names[-k:-1]).join(_near(probs[-1].withColumnRenamed("p", "below")), names[-k + 1 :])
            p = (F.col("c") - F.col("d")) / F.col("total") + F.col("off") / F.col("total") * F.col("below")
        probs.append(stage(t.select(*names[-k:], p.alias("p")), "lm-probabilities"))
    return probs, weights, unknown


def word_log_probabilities(wanted: DataFrame, tables: tuple[list[DataFrame], list[DataFrame], float]) -> DataFrame:
    """``wanted`` (words and more) with ``lp``: sharded joins with the tables of every order."""
    probs, weights, unknown = tables
    order = len(probs)
    names, out, p = _names(order), wanted, F.lit(unknown)
    for k in range(order, 0, -1):
        out = out.join(_near(probs[k - 1].withColumnRenamed("p", f"p{k}")), names[-k:], "left")
        if k > 1:
            out = out.join(_near(weights[k - 2].withColumnRenamed("w", f"b{k}")), names[-k:-1], "left")
    for k in range(1, order + 1):
        p = F.coalesce(F.col(f"p{k}"), F.coalesce(F.col(f"b{k}"), F.lit(1.0)) * p if k > 1 else p)
    return out.select(*wanted.columns, F.log(p).alias("lp"))


def _census():
    """Task: (word, count) of the words that are at least one in 4,000 of a chunk, and with a null word the count of all."""

    def run(batches):
        for b in batches:
            for _, _, data, off in chunks(b.column(0)):
                start, end, _ = words(data, off, WHITE)
                w, c = np.unique(span_hash(data, start, end), return_counts=True)
                often = c * 4000 >= len(start)
                yield pa.RecordBatch.from_arrays([pa.array([None, *i64(w[often]).tolist()], pa.int64()), pa.array([len(start), *c[often].tolist()], pa.int64())], names=["w", "c"])

    return lean(run)


class Buckets:
    """Where the n-grams of a middle word meet: one bucket, or several by the word before where the word is frequent."""

    def __init__(self, count: int, frequent: dict[int, int]):
        self.count = count
        self.words = np.array(sorted(frequent), U64)
        self.slices = np.array([min(frequent[w], count) for w in sorted(frequent)], U64)

    def spread(self, middle: np.ndarray) -> np.ndarray:
        """Number of buckets of each middle word."""
        out = np.ones(len(middle), U64)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, middle), len(self.words) - 1)
            own = self.words[at] == middle
            out[own] = self.slices[at[own]]
        return out

    def of(self, middle: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The bucket of slice ``k``."""
        return ((middle >> U64(13)) + k) % U64(self.count)

    def place(self, before: np.ndarray, middle: np.ndarray) -> np.ndarray:
        return self.of(middle, mix(before) % self.spread(middle))


#: Kinds of rows in a bucket, and the columns of each.
DOCUMENT, COUNT, PAIR, WORD = range(4)
PACKED = "bucket int, kind int, data binary"
SCORED = pa.schema([("key", pa.int64()), ("w3", pa.int64()), ("n", pa.int64()), ("s", pa.int64()), ("share", pa.float64())])


def _split(bucket: np.ndarray, middle: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """``(order by bucket and middle word, (bucket, first, end) of each bucket in it)``."""
    by = np.argsort((bucket << U64(40)) | (middle >> U64(24)))
    bucket = bucket[by]
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])).tolist()
    return by, [(int(bucket[i]), i, j) for i, j in zip(edge[:-1], edge[1:])]


def _packed(kind: int, rows: list[tuple[int, list[np.ndarray]]]) -> pa.RecordBatch:
    """One row for each bucket: its columns, one after the other."""
    data = pa.array([b"".join(c.tobytes() for c in cols) for _, cols in rows], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([kind] * len(rows), pa.int32()), data], names=["bucket", "kind", "data"])


def _code_type(n: int) -> type:
    return np.uint16 if n <= 1 << 16 else np.uint32


def _pack_documents(buckets: Buckets, middle: np.ndarray, before: np.ndarray, last: np.ndarray, doc: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """In each bucket words and documents are coded by their places in its lists of them, and equal middle words are told once."""
    by, spans = _split(buckets.place(before, middle), middle)
    rows = []
    for bucket, i, j in spans:
        own = by[i:j]
        vocabulary, code = np.unique(np.concatenate([before[own], last[own]]), return_inverse=True)
        docs, at = np.unique(doc[own], return_inverse=True)
        m = middle[own]
        run = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
        head = np.array([j - i, len(docs), len(vocabulary), len(run)], np.int64)
        times = np.diff(np.append(run, j - i)).astype(np.uint32)
        rows.append((bucket, [head, keys[docs], vocabulary, m[run], times, code.astype(_code_type(len(vocabulary))), at.astype(_code_type(len(docs)))]))
    return _packed(DOCUMENT, rows)


def _unpack_documents(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(middle, before, last, document, keys)``."""
    n, docs, size, runs = np.frombuffer(data, np.int64, 4).tolist()
    at, out = 32, []
    for t, k in ((np.int64, docs), (U64, size), (U64, runs), (np.uint32, runs), (_code_type(size), 2 * n), (_code_type(docs), n)):
        out.append(np.frombuffer(data, t, k, at))
        at += out[-1].nbytes
    keys, vocabulary, middle, times, code, doc = out
    return np.repeat(middle, times), vocabulary[code[:n]], vocabulary[code[n:]], doc.astype(np.int64), keys


def _document_grams(part: int, passes: int, buckets: Buckets):
    """Task: the 3-grams of each text (text, key) that belong to a pass, by bucket; a text met again in the task is left out."""

    def run(batches):
        held, keys, size, met = [], [], 0, set()

        def send():
            return _pack_documents(buckets, *(np.concatenate(x) for x in zip(*held)), np.concatenate(keys))

        for b in batches:
            key = b.column(1).to_numpy()
            new = np.zeros(len(key), bool)
            for d, k in enumerate(key.tolist()):
                new[d] = k not in met
                met.add(k)
            if not new.any():
                continue
            texts = b.column(0)
            if not new.all():
                texts, key = texts.filter(pa.array(new)), key[new]
            for i, j, data, off in chunks(texts):
                (before, middle, last), doc = word_columns(data, off, WORD_ORDER)
                own = np.flatnonzero(pass_of(middle, passes) == part)
                if len(own):
                    held.append([middle[own], before[own], last[own], doc[own] + sum(map(len, keys))])
                    keys.append(key[i:j])
                    size += len(own)
                if size > SENT:
                    yield send()
                    held, keys, size = [], [], 0
        if held:
            yield send()

    return lean(run)


def _model_rows(kind: int, buckets: Buckets):
    """Task: rows of counts (w2, w1, w3, c), of pairs (w2, w3, p) or of words (w2, weight), by bucket; below the 3-grams, to every slice of the middle word."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy() for c in b.columns]
            cols = [c.view(U64) if c.dtype == np.int64 else c for c in cols]
            if kind == COUNT:
                bucket = buckets.place(cols[1], cols[0])
            else:
                times = buckets.spread(cols[0]).astype(np.int64)
                at = np.repeat(np.arange(len(times)), times)
                nth = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
                cols = [c[at] for c in cols]
                bucket = buckets.of(cols[0], nth.astype(U64))
            by, spans = _split(bucket, cols[0])
            yield _packed(kind, [(k, [np.array([j - i], np.int64), *(c[by[i:j]] for c in cols)]) for k, i, j in spans])

    return lean(run)


def _find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(which of wanted are known, their places in known)``; ``known`` is sorted."""
    if not len(known):
        return np.zeros(len(wanted), bool), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    hit = known[at] == wanted
    return hit, at[hit]


def _read(rows: list[bytes], types: list) -> list[np.ndarray]:
    parts = []
    for r in rows:
        n, at, own = int(np.frombuffer(r, np.int64, 1)[0]), 8, []
        for t in types:
            own.append(np.frombuffer(r, t, n, at))
            at += n * np.dtype(t).itemsize
        parts.append(own)
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, t) for t in types]


def _log_units(p: np.ndarray) -> np.ndarray:
    return np.round(np.log(p) * UNIT).astype(np.int64)


def _score_bucket(cut: tuple[float, float, float]):
    """Group: the ``SCORED`` rows of a bucket: words and summed log probabilities of each document (w3 null), and the words that only the unigrams can tell, with the weight of these."""

    def run(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        rows = table.column("data").to_pylist()
        of = [[r for r, k in zip(rows, kinds) if k == kind] for kind in range(4)]
        middle, before, last, c = _read(of[COUNT], [U64, U64, U64, np.int64])
        context, at = np.unique(gram_hash([before, middle]), return_inverse=True)
        d = np.where(c == 1, cut[0], np.where(c == 2, cut[1], cut[2]))
        total, off = np.bincount(at, c, len(context)), np.bincount(at, d, len(context))
        two, last2, p2 = _read(of[PAIR], [U64, U64, np.float64])
        pair = gram_hash([two, last2])
        by = np.argsort(pair)
        pair, p2 = pair[by], p2[by]
        _, below = _find(pair, gram_hash([middle, last]))
        p3 = (c - d) / total[at] + off[at] / total[at] * p2[below]
        gram = gram_hash([before, middle, last])
        by = np.argsort(gram)
        gram, lp3 = gram[by], _log_units(p3[by])
        weight = off / total
        word, w = _read(of[WORD], [U64, np.float64])
        by = np.argsort(word)
        word, w = word[by], w[by]

        out = []
        for r in of[DOCUMENT]:
            middle, before, last, doc, key = _unpack_documents(r)
            docs = len(key)
            s = np.zeros(len(doc), np.int64)
            known, place = _find(gram, gram_hash([before, middle, last]))
            s[known] = lp3[place]
            rest = np.flatnonzero(~known)
            share = np.ones(len(rest))
            known, place = _find(context, gram_hash([before[rest], middle[rest]]))
            share[known] = weight[place]
            known, place = _find(pair, gram_hash([middle[rest], last[rest]]))
            s[rest[known]] = _log_units(share[known] * p2[place])
            rest, share = rest[~known], share[~known]
            known, place = _find(word, middle[rest])
            share[known] *= w[place]
            sums = np.zeros(docs, np.int64)
            np.add.at(sums, doc, s)
            out.append(pa.table([pa.array(key), pa.nulls(docs, pa.int64()), pa.array(np.bincount(doc, minlength=docs)), pa.array(sums), pa.nulls(docs, pa.float64())], schema=SCORED))
            none = np.zeros(len(rest), np.int64)
            out.append(pa.table([pa.array(key[doc[rest]]), pa.array(i64(last[rest])), pa.array(none), pa.array(none), pa.array(share)], schema=SCORED))
        return pa.concat_tables(out) if out else SCORED.empty_table()

    return lambda table: list(lean(lambda t: [run(t)])(table))[0]


def _unigrams(trusted: DataFrame, passes: int) -> tuple[DataFrame, list[dict]]:
    """``(words (w3, c) by continuation count, counts of counts of orders 1 to 3)``."""
    parts, few = [], range(1, 5)
    for r in range(passes):
        found = trusted.select("text").mapInArrow(_count_words(WORD_ORDER, r, passes), _count_fields(WORD_ORDER))
        grams = found.repartition("w2", "w3").groupBy("w1", "w2", "w3").agg(F.sum("c").alias("c"))
        pairs = grams.groupBy("w2", "w3").agg(F.count(F.lit(1)).alias("c"), *[F.count_if(F.col("c") == i).alias(f"t{i}") for i in few])
        own = pairs.groupBy("w3").agg(F.count(F.lit(1)).alias("c"), *[F.sum(f"t{i}").alias(f"t{i}") for i in few], *[F.count_if(F.col("c") == i).alias(f"p{i}") for i in few])
        parts.append(stage(own, "lm-counts"))
        free_shuffles(trusted.sparkSession)
    every = parts[0]
    for t in parts[1:]:
        every = every.union(t)
    row = every.agg(*[F.coalesce(F.sum(f"{k}{i}"), F.lit(0)).alias(f"{k}{i}") for k in "tp" for i in few]).first()
    unigrams = stage(every.groupBy("w3").agg(F.sum("c").alias("c")), "lm-words")
    first = unigrams.agg(*[F.count_if(F.col("c") == i).alias(f"n{i}") for i in few], F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("c"), F.lit(0)).alias("total")).first()
    release(*parts)
    return unigrams, [first.asDict(), {f"n{i}": row[f"p{i}"] for i in few}, {f"n{i}": row[f"t{i}"] for i in few}]


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame | None:
    """``(id, lang, n_bytes, perplexity)`` of (id, text, lang) rows under the model of the trusted (text) rows; None where these have no word."""
    spark = docs.sparkSession
    census = docs.select("text").mapInArrow(_census(), "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))
    census = {r["w"]: r["c"] for r in census.where(F.col("w").isNull() | (F.col("c") > SLICE_WORDS)).collect()}  # a row for each frequent word
    size = census.pop(None, 0)
    passes = max(1, min(PASSES, size // PASS_WORDS))
    frequent = {w % (1 << 64): -(-c // SLICE_WORDS) for w, c in census.items()}
    buckets = Buckets(max(8, size // passes // BUCKET_WORDS), frequent)
    unigrams, stats = _unigrams(trusted, -(-passes // 4))
    first = stats[0]
    if not first["n"]:
        return None
    cuts = [discounts(*(s[f"n{i}"] for i in range(1, 5))) for s in stats]
    unknown = (cuts[0][0] * first["n1"] + cuts[0][1] * first["n2"] + cuts[0][2] * (first["n"] - first["n1"] - first["n2"])) / first["total"] / (first["n"] + 1)
    p1 = (F.col("c") - _discount(F.col("c"), cuts[0])) / F.lit(first["total"]) + F.lit(unknown)
    words_p = stage(unigrams.select("w3", p1.alias("p1")), "lm-probabilities")
    release(unigrams)
    alone_lp = F.round(F.log(F.col("share") * F.coalesce("p1", F.lit(unknown))) * UNIT).cast("long")

    keyed = docs.select("id", "text", "lang", F.xxhash64("text").alias("key"))
    parts = []
    for r in range(passes):
        found = trusted.select("text").mapInArrow(_count_words(WORD_ORDER, r, passes), _count_fields(WORD_ORDER))
        grams = stage(found.groupBy("w1", "w2", "w3").agg(F.sum("c").alias("c")), "lm-counts")
        pairs = stage(grams.groupBy("w2", "w3").agg(F.count(F.lit(1)).alias("c")).withColumn("d", _discount(F.col("c"), cuts[1])), "lm-counts")
        context = stage(pairs.groupBy("w2").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("w")), "lm-contexts")
        p2 = (F.col("c") - F.col("d")) / F.col("total") + F.col("w") * F.col("p1")
        pair_p = stage(pairs.join(context, "w2").join(words_p, "w3").select("w2", "w3", p2.alias("p")), "lm-probabilities")
        release(pairs)
        free_shuffles(spark)
        rows = [
            keyed.select("text", "key").mapInArrow(_document_grams(r, passes, buckets), PACKED),
            grams.select("w2", "w1", "w3", "c").mapInArrow(_model_rows(COUNT, buckets), PACKED),
            pair_p.mapInArrow(_model_rows(PAIR, buckets), PACKED),
            context.select("w2", "w").mapInArrow(_model_rows(WORD, buckets), PACKED),
        ]
        packed = rows[0].union(rows[1]).union(rows[2]).union(rows[3])
        out = stage(packed.groupBy("bucket").applyInArrow(_score_bucket(cuts[2]), "key long, w3 long, n long, s long, share double"), "lm-scored")
        release(grams, pair_p, context)
        free_shuffles(spark)
        alone = out.where("w3 is not null").join(words_p, "w3", "left").select("key", "n", alone_lp.alias("s"))
        sums = out.where("w3 is null").select("key", "n", "s").union(alone).groupBy("key").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        parts.append(stage(sums, "lm-sums"))
        release(out)
        free_shuffles(spark)
    every = parts[0]
    for t in parts[1:]:
        every = every.union(t)
    # Copies share a key: sums and words grow alike, their ratio stays.
    mean = stage(every.groupBy("key").agg((F.sum("s") / F.sum("n") / UNIT).alias("mean")), "lm-means")
    release(*parts, words_p)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    rows = keyed.select("id", "lang", "key", n_bytes).join(_near(mean), "key", "left")
    return rows.select("id", "lang", "n_bytes", F.exp(-F.col("mean")).alias("perplexity"))


def classify(documents: DataFrame, labels: DataFrame, *, upper: float = 0.95, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """Per document: id, lang, ``n_bytes``, ``perplexity``, ``threshold``, ``kept``."""
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("_id")).where("_id is not null").distinct()
    good = stage(good, "lm-trusted")
    near = is_small(good)
    small = F.broadcast(good) if near else good
    held = F.pmod(F.xxhash64("_id", F.lit("quality")), F.lit(HELD_OUT)) == 0
    trusted = docs.join(small.where(~held), F.col("id") == F.col("_id"), "left_semi").where("length(text) > 0")
    if not near:  # the join sends all texts along: once, not in each pass
        trusted = stage(trusted.select("text"), "lm-trusted-texts")
        free_shuffles(docs.sparkSession)
    found = perplexities(docs, trusted)
    if not near:
        release(trusted)
    if found is None:
        size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
        none = F.lit(None).cast("double")
        out = docs.select(F.col("id").alias(id_col), "lang", size.alias("n_bytes"), none.alias("perplexity"), none.alias("threshold"))
        return out.withColumn("kept", F.col("n_bytes") > 0)
    scored = stage(found, "lm-perplexity")
    known = scored.join(small.where(held), F.col("id") == F.col("_id"), "left_semi").where("perplexity is not null")
    edge = F.percentile_approx("perplexity", upper, 10_000).alias("threshold")
    enough = F.count(F.lit(1)) * (1 - upper) > 1 - 1e-9
    by_lang = known.groupBy(F.col("lang").alias("_lang")).agg(edge, enough.alias("enough")).where("enough").drop("enough")
    every = known.agg(edge.alias("every"))
    out = scored.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left").join(F.broadcast(every))  # one row
    out = out.withColumn("threshold", F.coalesce("threshold", "every"))
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.select(F.col("id").alias(id_col), "lang", "n_bytes", "perplexity", "threshold", kept.alias("kept"))
