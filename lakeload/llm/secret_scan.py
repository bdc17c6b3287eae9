"""Secret scan: candidates by pattern, false positives removed by a random forest.

Method.  A candidate is a run of at least ``MIN_CHARS`` characters of the base64 and
hex alphabets.  Its features are its length, the shares of digits and capitals, how
often neighbouring characters change class, its entropy, whether it is hexadecimal,
how much of it the corpus dictionary covers, marks of a path, and the words and
signs beside it.  A random forest trained on labelled findings gives the
probability that it is a secret.  The dictionary holds the words that make up at
least one in ``COMMON`` of all words of 3 to 12 letters, so it has at most ``COMMON``
entries, whatever the corpus.

Labels.  Where no findings are labelled by hand, ``labelled`` settles some by evidence
that is no feature: the published format of a key, the check digit of a card number,
letter pairs that read as the corpus does.  A value assigned to a key name counts as a
secret too, but the forest never sees that cause: such findings are learned with their
neighbour features blank.  To these come ``PLANTED`` findings of each label: drawn
random keys, and compounds, paths and numbers made of dictionary words, each with the
neighbours of some finding of the corpus.  The forest is fitted in one task on about
``per_label`` findings of each kind of label; one in ``HELD_OUT`` values is never
learned, and ``held_out_counts`` judges the forest by these.

Cases.  Null or empty text: no finding.  No labelled finding: the planted ones alone
teach.  Very long texts and runs are read whole.  Repeated rows repeat their findings,
equal values and neighbours get equal scores.  Empty table: empty result.  Only the id
and text columns are read.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.graph import release, stage
from lakeload.llm.text import chunks

MIN_CHARS = 16
#: A dictionary word is at least one in so many of all words.
COMMON = 200_000
HELD_OUT = 5
PLANTED = 1500
#: Letter pairs that are so much likelier (mean log ratio) than random letters read as language.
READS = 0.5
_RUN = re.compile(rb"[A-Za-z0-9+/_\-]{%d,}" % MIN_CHARS)
_NAME = re.compile(rb"([A-Za-z_\-]+)[\"']?\s*([=:])\s*[\"']?\Z")
_WORD = re.compile(rb"([A-Za-z_]+)\W*\Z")
_KEYS = re.compile(rb"(?i)pass|secret|token|api|key|auth|cred")
_LETTERS = re.compile(rb"[a-z]+")
#: What stands between a candidate and the text that no longer says anything about it.
_BESIDE = re.compile(rb"[A-Za-z_\-]*[\"']?\s*[=:]?\s*[\"']?\Z")
#: Published key formats.
_FORMATS = re.compile(rb"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|AIza[A-Za-z0-9_\-]{35}|glpat-[A-Za-z0-9_\-]{20}|[sr]k_live_[A-Za-z0-9]{24,}|xox[baprs]-[A-Za-z0-9\-]{20,}")
FEATURES = ("length", "digits", "capitals", "changes", "entropy", "hex", "covered", "slashes", "dot_beside", "assigned", "quoted", "key_name", "key_word")
#: Features of an assignment.
_ASSIGNED = slice(9, 13)
_NEIGHBOURS = slice(8, 13)


def covered(value: bytes, words: frozenset[bytes]) -> float:
    """Share of the characters that the longest dictionary words, read from the left, cover."""
    got, low = 0, value.lower()
    for m in _LETTERS.finditer(low):
        part, i = m[0], 0
        while i < len(part):
            for n in range(min(12, len(part) - i), 2, -1):
                if part[i : i + n] in words:
                    got += n
                    i += n
                    break
            else:
                i += 1
    return got / len(value)


def _before(text: bytes, start: int) -> bytes:
    """The text before a candidate, back to where the word beside it begins, however far that is."""
    n = 64
    while True:
        part = text[max(0, start - n) : start]
        if n >= start:
            return part
        word = _WORD.search(part)
        if _BESIDE.search(part).start() > 0 and word and word.start() > 0:
            return part
        n *= 4


def describe(text: bytes, start: int, end: int, words: frozenset[bytes]) -> list[float]:
    """Features of one candidate, in the order of ``FEATURES``."""
    value, before, after = text[start:end], _before(text, start), text[end : end + 1]
    raw = np.frombuffer(value, np.uint8)
    kind = np.select([(raw >= 48) & (raw <= 57), (raw >= 65) & (raw <= 90), (raw >= 97) & (raw <= 122)], [0, 1, 2], 3)
    share = np.bincount(raw, minlength=128) / len(raw)
    share = share[share > 0]
    name, word = _NAME.search(before), _WORD.search(before)
    return [
        float(len(raw)),
        float((kind == 0).mean()),
        float((kind == 1).mean()),
        float((kind[1:] != kind[:-1]).mean()),
        float(-(share * np.log2(share)).sum()),
        float(re.fullmatch(rb"[0-9a-fA-F]+", value) is not None),
        covered(value, words),
        float(value.count(b"/")),
        float(after == b"." or before[-1:] in (b".", b"/")),
        float(name is not None),
        float(before[-1:] in (b'"', b"'")),
        float(name is not None and _KEYS.search(name[1]) is not None),
        float(word is not None and _KEYS.search(word[1]) is not None),
    ]


def _checks(value: bytes) -> bool:
    """Is it a number whose last digit is the check digit of a card number?"""
    if not (13 <= len(value) <= 19 and value.isdigit()):
        return False
    digits = [c - 48 for c in reversed(value)]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def pair_odds(counts: dict[bytes, int]) -> np.ndarray:
    """Log ratio of each pair of letters in the dictionary words to random letters, 26 by 26."""
    met = np.ones((26, 26))
    for word, n in counts.items():
        at = np.frombuffer(word, np.uint8) - 97
        np.add.at(met, (at[:-1], at[1:]), n)
    return np.log(met / met.sum() * 676)


def reads(value: bytes, odds: np.ndarray) -> bool:
    """Mostly letters, in pairs as the corpus has them."""
    at = np.frombuffer(value.lower(), np.uint8).astype(np.int64) - 97
    letter = (at >= 0) & (at < 26)
    both = letter[1:] & letter[:-1]
    return bool(letter.mean() >= 0.8 and both.any() and odds[at[:-1][both], at[1:][both]].mean() > READS)


def labelled(value: bytes, f: list[float], odds: np.ndarray) -> int | None:
    """1: format of a key; 2: assigned to a key name, and nothing against it; 0: card number or language; None: unsettled."""
    if _FORMATS.fullmatch(value):
        return 1
    against, named = _checks(value) or reads(value, odds), bool(f[11])
    return None if against == named else 2 if named else 0


def planted(words: frozenset[bytes], each: int, rng, kinds: tuple[str, ...] = ("hex", "base62", "base64")) -> list[tuple[bytes, int]]:
    """``(value, label)``: drawn keys of the kinds given, and as many compounds, paths, names and numbers."""
    digits = b"0123456789"
    upper, lower = bytes(range(65, 91)), bytes(range(97, 123))
    alphabet = {"hex": digits + b"abcdef", "base62": digits + upper + lower, "base64": digits + upper + lower + b"+/"}
    known, out = sorted(words) or [b"word"], []
    for i in range(each):
        chars = np.frombuffer(alphabet[kinds[i % len(kinds)]], np.uint8)
        out.append((rng.choice(chars, int(rng.integers(MIN_CHARS, 65))).tobytes(), 1))
        value = b""
        if i % 4 == 3:
            value = rng.choice(np.frombuffer(digits, np.uint8), int(rng.integers(MIN_CHARS, 25))).tobytes()
        while len(value) < MIN_CHARS:
            value += (b"", b"/", b"_")[i % 4] + known[int(rng.integers(len(known)))]
        out.append((value.title() if i % 8 > 3 else value, 0))
    return out


def _find(words: frozenset[bytes], odds: np.ndarray):
    """Task: findings (id, start, length, value, label, features)."""

    def run(batches):
        for b in batches:
            for i, j, data, off in chunks(b.column(1)):
                raw = data.tobytes()
                rows = []
                for d in range(j - i):
                    text = raw[off[d] : off[d + 1]]
                    for m in _RUN.finditer(text):
                        f = describe(text, m.start(), m.end(), words)
                        rows.append((d, m.start(), m.end() - m.start(), m[0].decode("ascii"), labelled(m[0], f, odds), f))
                cols = list(zip(*rows)) if rows else [[]] * 6
                ids = b.column(0).slice(i, j - i).take(pa.array(cols[0], pa.int64()))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([ids] + [pa.array(c, t) for c, t in zip(cols[1:], kinds)], names=["id", "start", "length", "value", "label", "features"])

    return run


def grow(x: np.ndarray, y: np.ndarray, rng, depth: int = 8, least: int = 3):
    """One tree as nested tuples ``(feature, cut, low side, high side)`` with probabilities as leaves."""
    p = float(y.mean())
    if depth == 0 or len(y) < 2 * least or p in (0.0, 1.0):
        return p
    best = None
    for f in rng.choice(x.shape[1], size=max(1, int(np.sqrt(x.shape[1]))), replace=False):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0.05, 0.95, 12))):
            low = x[:, f] <= cut
            n = int(low.sum())
            if min(n, len(y) - n) < least:
                continue
            a, b = y[low].mean(), y[~low].mean()
            impurity = n * a * (1 - a) + (len(y) - n) * b * (1 - b)
            if best is None or impurity < best[0]:
                best = (impurity, f, cut, low)
    if best is None:
        return p
    _, f, cut, low = best
    return int(f), float(cut), grow(x[low], y[low], rng, depth - 1, least), grow(x[~low], y[~low], rng, depth - 1, least)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, seed: int = 0) -> list:
    """A random forest: bootstrap samples drawn evenly from both labels."""
    rng = np.random.default_rng(seed)
    sides = [np.flatnonzero(y == v) for v in (0, 1)]
    if not all(map(len, sides)):
        return [float(y.mean())] if len(y) else [0.0]
    out = []
    for _ in range(trees):
        at = np.concatenate([rng.choice(s, size=min(len(y), 2000)) for s in sides])
        out.append(grow(x[at], y[at], rng))
    return out


def probability(forest: list, x: np.ndarray) -> np.ndarray:
    def walk(tree, rows, out):
        if isinstance(tree, float):
            out[rows] += tree
        elif len(rows):
            low = x[rows, tree[0]] <= tree[1]
            walk(tree[2], rows[low], out)
            walk(tree[3], rows[~low], out)

    total = np.zeros(len(x))
    for t in forest:
        walk(t, np.arange(len(x)), total)
    return total / len(forest)


def _fit_task(words: frozenset[bytes], kinds: tuple[str, ...]):
    """Task: a forest of the sampled findings and the planted ones."""

    def run(batches):
        rows = sorted((r for b in batches for r in zip(b.column("features").to_pylist(), b.column("label").to_pylist()) if r[1] is not None), key=repr)
        rng = np.random.default_rng(1)
        x = np.array([r[0] for r in rows]).reshape(-1, len(FEATURES))
        y = np.array([r[1] for r in rows], np.int64)
        beside = x[:, _NEIGHBOURS] if len(x) else np.zeros((1, _NEIGHBOURS.stop - _NEIGHBOURS.start))
        drawn = planted(words, PLANTED, rng, kinds)
        added = np.array([describe(v, 0, len(v), words) for v, _ in drawn])
        added[:, _NEIGHBOURS] = beside[rng.integers(len(beside), size=len(added))]
        x = blank(x, y)
        forest = fit(np.concatenate([x, added]), np.concatenate([y > 0, [label > 0 for _, label in drawn]]).astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(forest)], pa.binary())], names=["model"])

    return run


def blank(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Features without the assignment where it is the cause of the label."""
    x = x.copy()
    x[y == 2, _ASSIGNED] = 0.0
    return x


def _learned() -> Column:
    return F.pmod(F.xxhash64("value", F.lit("held out")), F.lit(HELD_OUT)) != 0


def train(findings: DataFrame, per_label: int = 3000, words: frozenset[bytes] = frozenset(), kinds: tuple[str, ...] = ("hex", "base62", "base64")) -> list:
    """A forest from a bounded sample of the distinct labelled findings (features, value, label 0, 1 or 2) and planted ones."""
    known = findings.where("label in (0, 1, 2)").where(_learned()).select("value", "features", "label").distinct()
    known = known.withColumn("draw", F.pmod(F.xxhash64("value", "features", F.lit("secret")), F.lit(1_000_000)))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    limit = F.lit(0.0)
    for label, n in sorted(counts.items()):
        limit = F.when(F.col("label") == label, F.lit(min(1.0, per_label / n) * 1e6)).otherwise(limit)
    picked = known.where(F.col("draw") < limit)
    # One row without a label: the task runs even where no finding is labelled.
    mark = findings.sparkSession.range(1).select(F.lit(None).cast("array<double>").alias("features"), F.lit(None).cast("int").alias("label"))
    made = picked.select("features", "label").union(mark).repartition(1).mapInArrow(_fit_task(words, kinds), "model binary").first()
    return pickle.loads(made["model"])


def held_out_counts(findings: DataFrame, forest: list) -> DataFrame:
    """``(label, is_secret, n)`` over the distinct labelled findings that no forest learns, their cause blank as in training."""

    def judge(batches):
        for b in batches:
            y = b.column("label").to_numpy()
            x = b.column("features").flatten().to_numpy().reshape(b.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(probability(forest, blank(x, y)) >= 0.5)], names=["label", "is_secret"])

    known = findings.where("label in (0, 1, 2)").where(~_learned()).select("value", "features", "label").distinct()
    return known.select("features", "label").mapInArrow(judge, "label int, is_secret boolean").groupBy("label", "is_secret").agg(F.count(F.lit(1)).alias("n"))


def _words(batches):
    """Task: lower-case words of 3 to 12 letters with counts."""
    for b in batches:
        met: Counter[bytes] = Counter()
        for _, _, data, _ in chunks(b.column(0)):
            met.update(m for m in _LETTERS.findall(data.tobytes().lower()) if 3 <= len(m) <= 12)
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in met], pa.string()), pa.array(list(met.values()), pa.int64())], names=["word", "n"])


def dictionary(docs: DataFrame, common: int = COMMON) -> dict[bytes, int]:
    """Words that are at least one in ``common`` of all words of 3 to 12 letters, with counts: ``common`` entries at most."""
    met = stage(docs.select("text").mapInArrow(_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "secret-words")
    total = met.agg(F.sum("n")).first()[0] or 0
    found = {r["word"].encode(): r["n"] for r in met.where(F.col("n").cast("decimal(38,0)") * common >= total).collect()}
    release(met)
    return found


def _judge(forest: list):
    def run(batches):
        for b in batches:
            flat = b.column("features").flatten().to_numpy()
            p = probability(forest, flat.reshape(b.num_rows, len(FEATURES)))
            names = ["id", "start", "length", "value"]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(p)], names=[*names, "score"])

    return run


def find(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, frozenset[bytes]]:
    """``(findings (id, start, length, value, label, features), dictionary)``, the findings as a work table."""
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = dictionary(docs)
    words = frozenset(counts)
    found = docs.mapInArrow(_find(words, pair_odds(counts)), "id long, start long, length long, value string, label int, features array<double>")
    return stage(found, "secret-findings"), words


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every candidate: id, byte ``start``, ``length``, ``value``, ``score``, ``is_secret`` (score of 0.5 or more)."""
    found, words = find(documents, id_col, text_col)
    out = found.drop("label").mapInArrow(_judge(train(found, words=words)), "id long, start long, length long, value string, score double")
    return out.select(F.col("id").alias(id_col), "start", "length", "value", "score", (F.col("score") >= 0.5).alias("is_secret"))
