"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated word triples of every
whole text.  Documents that pass them become a vector of transformed statistics:
log mean word length, log symbols per 100 words, share of repeated lines, share of
words in repeated triples.  For each language and source the minimum covariance
determinant estimate is found by concentration steps: mean and covariance of the
``SHARE`` nearest documents, distances anew, again, from two starts
(coordinatewise medians and MADs, with the nearest half and the nearest
``SHARE``); the start with the smaller determinant wins.  A document goes when its
squared Mahalanobis distance is over ``CUTOFF``.  The covariance is factored by
Cholesky expressions; a floor on the variances keeps constant statistics usable.

Groups of fewer than ``MIN_GROUP`` documents use the estimate of their language, or of all
documents.  Means, covariances and quantiles are partial aggregates, so a hot
source costs no more than its rows.

Cases.  Null or empty text: no words, base failed.  Null language or source counts
as the empty string.  Repeated rows count as often as they occur.  Empty table:
empty result.  Only the named columns are read, further ones never clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.llm.graph import stage

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SHARE = 0.75
STEPS = 4
MIN_GROUP = 100
#: Floors of the standard deviations of the four statistics.
FLOORS = (0.08, 0.35, 0.1, 0.1)
CUTOFF = 40.0
_P = len(FLOORS)
#: Makes the covariance of the nearest SHARE of a 4-variate normal that of all: SHARE / P(chi2_6 <= q), q the SHARE quantile of chi2_4.
_Q = 5.385269057779394
SCALE = SHARE / (1 - math.exp(-_Q / 2) * (1 + _Q / 2 + _Q * _Q / 8))


def base_counts(documents: DataFrame, id_col: str, text_col: str, keep: list[Column]) -> DataFrame:
    """Base statistics of each row; ``keep`` columns pass through."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = documents.select(F.col(id_col).alias("doc_id"), *keep, text.alias("t"))
    docs = docs.select(
        "*",
        F.filter(F.split("t", "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "").alias("w"),
        F.filter(F.split("t", "\n", -1), lambda x: F.translate(x, WHITE, "") != "").alias("lines"),
    )
    names = [c for c in docs.columns if c not in ("t", "w", "lines")]
    n = F.size("w")
    pair = F.zip_with("w", F.slice("w", F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    docs = docs.select(
        *names,
        "w",
        n.cast("long").alias("n_words"),
        F.length(F.translate("t", WHITE, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.slice(pair, F.lit(1), F.greatest(n - 2, F.lit(0))).alias("p2"),
    )
    names += ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    triple = F.zip_with("p2", F.slice("w", F.lit(3), F.greatest(F.size("w") - 2, F.lit(0))), lambda p, c: F.xxhash64(p, c))
    docs = docs.select(*names, F.array_sort(F.transform(triple, lambda h, i: F.struct(h.alias("h"), i.alias("i")))).alias("r"))
    # Equal triples are neighbours now; the positions of those with an equal neighbour, in order.
    after = F.slice("r", F.lit(2), F.greatest(F.size("r") - 1, F.lit(0)))
    twice = F.filter(F.zip_with("r", after, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))), lambda x: x.isNotNull())
    docs = docs.select(*names, F.array_sort(F.array_distinct(F.flatten(twice))).alias("at"))
    # A triple covers three words; least() skips the null beside the last position.
    gaps = F.zip_with("at", F.slice("at", F.lit(2), F.greatest(F.size("at") - 1, F.lit(0))), lambda a, b: F.least(b - a, F.lit(3)))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g)
    docs = docs.select(*names, covered.alias("n_repeat_words"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return docs.withColumn("base_failed", failed)


def _vector() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words).alias("x0"),
        F.log1p(100.0 * F.col("n_symbols") / words).alias("x1"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double")).alias("x2"),
        (F.col("n_repeat_words") / words).alias("x3"),
    ]


def _estimates(rows: DataFrame, near: Column) -> DataFrame:
    """Mean, Cholesky factor and log determinant for each group ``g``, from the rows where ``near`` holds."""
    x = [F.when(near, F.col(f"x{i}")) for i in range(_P)]
    aggs = [F.avg(x[i]).alias(f"m{i}") for i in range(_P)]
    aggs += [F.covar_pop(x[i], x[j]).alias(f"c{i}{j}") for i in range(_P) for j in range(i + 1)]
    est = rows.groupBy("g").agg(*aggs)
    for i in range(_P):  # one column after the other: each uses those before it
        for j in range(i + 1):
            v = F.coalesce(F.col(f"c{i}{j}"), F.lit(0.0)) * SCALE
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            v = F.sqrt(F.greatest(v, F.lit(0.0)) + F.lit(FLOORS[i] ** 2)) if i == j else v / F.col(f"l{j}{j}")
            est = est.withColumn(f"l{i}{j}", v)
    det = sum((F.log(f"l{i}{i}") for i in range(_P)), F.lit(0.0))
    return est.select("g", *[f"m{i}" for i in range(_P)], *[f"l{i}{j}" for i in range(_P) for j in range(i + 1)], det.alias("det"))


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution; columns m*, l* stand beside x*."""
    z: list[Column] = []
    for i in range(_P):
        v = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            v = v - F.col(f"l{i}{k}") * z[k]
        z.append(v / F.col(f"l{i}{i}"))
    return sum((v * v for v in z), F.lit(0.0))


def _groups(rows: DataFrame) -> DataFrame:
    """``(lang, source, g)``: the group whose estimate a language and source use."""
    n = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    in_lang = F.sum("n").over(Window.partitionBy("lang"))
    own = F.to_json(F.struct("lang", "source"))
    g = F.when(F.col("n") >= MIN_GROUP, own).when(in_lang >= MIN_GROUP, F.to_json(F.struct("lang"))).otherwise(F.lit("{}"))
    return n.select("lang", "source", own.alias("own"), F.to_json(F.struct("lang")).alias("of_lang"), g.alias("g"))


def robust_estimates(rows: DataFrame) -> DataFrame:
    """MCD estimate for each group of ``rows`` (lang, source, x0..x3)."""
    rows = rows.join(_groups(rows), ["lang", "source"])
    x = [f"x{i}" for i in range(_P)]
    # A row counts for its own group, its language and all, as far as some group uses them.
    levels = F.array(F.col("own"), F.col("of_lang"), F.lit("{}"))
    used = rows.select(F.col("g").alias("u")).distinct()
    rows = stage(rows.select(F.explode(levels).alias("g"), *x).join(used, F.col("g") == F.col("u"), "left_semi"), "rules-rows")
    middle = rows.groupBy("g").agg(*[F.percentile_approx(c, 0.5, 2000).alias(f"med{c}") for c in x])
    off = rows.join(middle, "g").select("g", *x, *[F.abs(F.col(c) - F.col(f"med{c}")).alias(f"a{c}") for c in x])
    spread = off.groupBy("g").agg(*[F.percentile_approx(f"a{c}", 0.5, 2000).alias(f"mad{c}") for c in x])
    scaled = sum((F.pow(F.col(f"a{c}") / F.greatest(1.4826 * F.col(f"mad{c}"), F.lit(f)), F.lit(2.0)) for c, f in zip(x, FLOORS)), F.lit(0.0))
    start = off.join(spread, "g").select("g", *x, scaled.alias("d"))
    found = None
    for share in (0.5, SHARE):
        dist, part = start, share
        for _ in range(STEPS):
            edge = dist.groupBy("g").agg(F.percentile_approx("d", part, 2000).alias("edge"))
            est = stage(_estimates(dist.join(edge, "g"), F.col("d") <= F.col("edge")), "rules-estimate")
            dist, part = rows.join(est, "g").select("g", *x, _distance().alias("d")), SHARE
        found = est if found is None else found.union(est)
    best = found.groupBy("g").agg(F.min_by(F.struct(*found.columns), "det").alias("e"))
    return stage(best.select("e.*"), "rules-best")


def quality_rules(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """Per document: id, base counts, ``base_failed``, ``distance`` (squared Mahalanobis; null when base failed), ``kept``."""
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]
    counts = stage(base_counts(documents, id_col, text_col, keys), "rules-counts")
    passed = counts.where(~F.col("base_failed"))
    est = robust_estimates(passed.select("lang", "source", *_vector()))
    groups = stage(_groups(passed), "rules-groups").select("lang", "source", "g")
    model = groups.join(est.drop("det"), "g")
    joined = counts.select("*", *_vector()).join(model, ["lang", "source"], "left")
    out = joined.withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return out.select(F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", kept.alias("kept"))
