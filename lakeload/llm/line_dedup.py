"""Line dedup by a segment-partition edit join.

Method.  A line of at least ``min_chars`` characters is split into ``tau + 1``
segments; a line within edit distance ``tau`` must hold one of them unchanged, at a
place that the length difference and the segment's number bound.  Every distinct
line is indexed by its segments (length, number, content) and probes, for each
length from ``len - tau`` to ``len``, the substrings at those places.  Lines that
share a key are candidates; a banded bit-parallel edit distance confirms them.
Classes are the connected components of the confirmed links plus equal lines;
shorter lines are only matched exactly.

Equal lines are one node from the start, so copies never pair up.  The search runs
in two rounds and loses no link: round one checks each line against the smallest
line of most of its keys (linear in the rows); round two compares the lines of every key,
also of two lines, that are still in different classes, block by block where a key is frequent.

A line is the text between newlines without white space at its ends; lines without
a word are never removed.  The first occurrence of a class, by document id and line
number, stays; the others go.

Cases.  Null or empty text stays as it is.  Very long lines are handled whole.
Ties: the smallest (id, line number) stays.  Rows with one id are one document: a
repeated row keeps and loses the same lines.  Null ids come first.  Empty table:
empty result.  Columns other than id and text pass through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.functions.sizing import is_small
from lakeload.llm.graph import components, fresh, scratch, settle, stage
from lakeload.llm.text import U64, WHITE, byte_set, chunks, i64, lean, mix, span_hash, value_hash, words

#: Rows of a key that are compared at once.
KEY_ROWS = 512
_NEWLINE = byte_set((0x0A, 0x0A))


def _lines(data: np.ndarray, offsets: np.ndarray):
    """``(start, end, doc, number)`` of the lines with a word, white space at the ends left out."""
    start, end, doc = words(data, offsets, _NEWLINE)  # runs without newline, cut at document ends
    if not len(start):
        return start, end, doc, start
    ink = np.flatnonzero(~WHITE[data])
    lo = np.searchsorted(ink, start)
    hi = np.searchsorted(ink, end)
    some = hi > lo
    breaks = np.concatenate([[0], np.cumsum(data == 0x0A)])
    number = breaks[start] - breaks[offsets[doc]]
    start, end = ink[lo[some]], ink[hi[some] - 1] + 1
    return start, end, doc[some], number[some]


def _occurrences(batches):
    """Task: (id, pos, h) of every line."""
    for b in batches:
        for i, j, data, off in chunks(b.column(1)):
            start, end, doc, number = _lines(data, off)
            h = i64(span_hash(data, start, end))
            ids = b.column(0).slice(i, j - i).take(pa.array(doc))
            yield pa.RecordBatch.from_arrays([ids, pa.array(number.astype(np.int64)), pa.array(h)], names=["id", "pos", "h"])


def line_keys(points: np.ndarray, start: np.ndarray, end: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """``(line, key)`` of all index segments and probe substrings of lines given as code-point spans."""
    size = end - start
    spans_a, spans_b, line, tag = [], [], [], []
    at = np.arange(len(start))
    for gap in range(tau + 1):  # the indexed line is `gap` shorter
        length = size - gap
        small = length // (tau + 1)
        for seg in range(tau + 1):
            longer = (tau + 1) - length % (tau + 1)  # the last segments take the rest
            first = seg * small + np.maximum(0, seg - longer)
            width = small + (seg >= longer)
            lo = np.maximum(np.maximum(0, first - seg), first + gap - (tau - seg))
            hi = np.minimum(np.minimum(size - width, first + seg), first + gap + (tau - seg))
            for shift in range(int((hi - lo).max(initial=-1)) + 1):
                p = lo + shift
                ok = (p <= hi) & (length > tau)
                spans_a.append((start + p)[ok])
                spans_b.append((start + p + width)[ok])
                line.append(at[ok])
                tag.append((length[ok].astype(U64) << U64(8)) + U64(seg))
    a, b, line, tag = (np.concatenate(x) for x in (spans_a, spans_b, line, tag))
    with np.errstate(over="ignore"):
        key = mix(value_hash(mix(points.astype(U64) + U64(1)), a, b) + mix(tag))
    return line, i64(key)


def _keys(tau: int, min_chars: int):
    """Task: (key, h) of the lines long enough to differ by edits; most repeats are left out."""

    def run(batches):
        for b in batches:
            for _, _, data, off in chunks(b.column(0)):
                start, end, _, _ = _lines(data, off)
                h = i64(span_hash(data, start, end))
                h, one = np.unique(h, return_index=True)
                start, end = start[one], end[one]
                points, chars = code_points(data)
                s, e = chars[start], chars[end]
                long = e - s >= min_chars
                if long.any():
                    line, key = line_keys(points, s[long], e[long], tau)
                    by = np.argsort(key)
                    key, own = key[by], h[long][line][by]
                    new = np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])]) if len(key) else by.astype(bool)
                    yield pa.RecordBatch.from_arrays([pa.array(key[new]), pa.array(own[new])], names=["key", "h"])

    return run


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the number of code points before each byte."""
    lead = (data & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(lead)])
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, chars


def _line_rows(batches):
    """Task: (h, line) of every line of some documents."""
    for b in batches:
        for _, _, data, off in chunks(b.column(0)):
            start, end, _, _ = _lines(data, off)
            h, one = np.unique(i64(span_hash(data, start, end)), return_index=True)
            raw = data.tobytes()
            text = pa.array([raw[x:y].decode("utf-8") for x, y in zip(start[one], end[one])], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(h), text], names=["h", "line"])


def within(x: list[np.ndarray], y: list[np.ndarray], tau: int) -> np.ndarray:
    """Whether the edit distance of each pair of code-point arrays is at most ``tau``.

    One machine word for each pair holds a band of ``2 tau + 1`` cells of the current
    column (bit k: row ``column - tau + k``), as vertical differences; all pairs
    advance column by column.  The distance is followed down the lowest diagonal of
    the band and then along the last row.
    """
    width, n = 2 * tau + 1, len(x)
    full, one = U64((1 << width) - 1), U64(1)
    rows = np.array([len(p) for p in x])
    cols = np.array([len(p) for p in y])
    out = np.zeros(n, bool)
    short = (rows <= tau) | (np.abs(rows - cols) > tau)
    for i in np.flatnonzero(short & (np.abs(rows - cols) <= tau)):
        out[i] = _plain(x[i], y[i]) <= tau
    live = np.flatnonzero(~short)
    if not len(live):
        return out
    height, length = int(rows[live].max()), int(cols[live].max())
    p = np.full((len(live), height + 2 * width), 0xFFFFFFFF, np.uint32)  # shifted by the band's width
    t = np.full((len(live), length), 0xFFFFFFFE, np.uint32)
    for k, i in enumerate(live):
        p[k, width : width + rows[i]] = x[i]
        t[k, : cols[i]] = y[i]
    m, c = rows[live], cols[live]
    vp = np.full(len(live), ((1 << (tau + 1)) - 1) << tau, U64)
    vn = np.zeros(len(live), U64)
    dist = np.full(len(live), tau, np.int64)
    for j in range(length):
        eq = np.zeros(len(live), U64)
        for k in range(width):
            row = j - tau + k
            if 0 <= row < height:
                eq |= (p[:, width + row] == t[:, j]).astype(U64) << U64(k)
        d0 = ((((eq & vp) + vp) ^ vp) | eq | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        bottom = j + tau < m
        last = np.clip(m - 1 - j + tau, 0, width - 1).astype(U64)
        along = ((hp >> last) & one).astype(np.int64) - ((hn >> last) & one).astype(np.int64)
        down = 1 - ((d0 >> U64(2 * tau)) & one).astype(np.int64)
        dist += np.where(j < c, np.where(bottom, down, along), 0)
        d1 = d0 >> one
        vp, vn = (hn | ~(d1 | hp)) & full, d1 & hp
    out[live] = dist <= tau
    return out


def _plain(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, cb in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (ca != cb))
    return row[-1]


def _check(tau: int):
    """Task: pairs (a, b, x, y) of lines within ``tau`` edits."""

    def points(s: str) -> np.ndarray:
        return np.frombuffer(s.encode("utf-32-le"), np.uint32)

    def run(batches):
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            order = sorted(range(len(x)), key=lambda i: len(x[i]))
            ok = np.zeros(len(x), bool)
            i = 0
            while i < len(order):  # pairs of like length, about 4 million cells at once
                j = i + 1
                while j < len(order) and (j + 1 - i) * (len(x[order[j]]) + 64) < 1_000_000:
                    j += 1
                own = order[i:j]
                ok[own] = within([points(x[k]) for k in own], [points(y[k]) for k in own], tau)
                i = j
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return run


def line_classes(docs: DataFrame, tau: int, min_chars: int) -> tuple[DataFrame, DataFrame]:
    """``(occurrences (id, pos, h), classes (h, keep_id, keep_pos))`` of the lines of (id, text) rows."""
    spark = docs.sparkSession
    seen = stage(docs.mapInArrow(lean(_occurrences), "id long, pos long, h long"), "lines-seen")
    first = stage(seen.groupBy("h").agg(F.min(F.struct("id", "pos")).alias("f")), "lines-first")

    by_key = Window.partitionBy("key")
    met = docs.select("text").mapInArrow(lean(_keys(tau, min_chars)), "key long, h long")
    met = met.withColumns({"lo": F.min("h").over(by_key), "hi": F.max("h").over(by_key)})
    # Few keys have two lines: repeats go after this filter.
    met = stage(met.where("lo < hi").select("key", "h", F.col("lo").alias("hub")).dropDuplicates(["key", "h"]), "lines-met")

    wanted = stage(first.join(met.select("h").distinct(), "h", "left_semi").select(F.col("f.id").alias("want")).distinct(), "lines-docs")
    ids = F.broadcast(wanted) if is_small(wanted) else wanted
    texts = docs.join(ids, docs["id"].eqNullSafe(ids["want"]), "left_semi").select("text").mapInArrow(lean(_line_rows), "h long, line string")
    texts = stage(texts.join(met.select("h").distinct(), "h", "left_semi").dropDuplicates(["h"]), "lines-text")

    def checked(pairs: DataFrame) -> DataFrame:
        x, y = texts.toDF("a", "x"), texts.toDF("b", "y")
        both = pairs.join(y, "b").join(x, "a").where(F.abs(F.length("x") - F.length("y")) <= tau)
        return both.select("a", "b", "x", "y").mapInArrow(lean(_check(tau)), "a long, b long")

    # One hub for each line: the smallest line of most of its keys.
    best = met.where("h <> hub").groupBy("h", "hub").agg(F.count(F.lit(1)).alias("n")).groupBy("h").agg(F.max(F.struct("n", "hub")).alias("m"))
    stars = stage(best.select(F.col("m.hub").alias("a"), F.col("h").alias("b")), "lines-stars")
    links = stage(checked(stars), "lines-links")
    label = met.join(components(spark, links).toDF("h", "root"), "h", "left").select("key", "h", F.coalesce("root", "h").alias("cls"))
    label = label.withColumns({"lo": F.min("cls").over(by_key), "hi": F.max("cls").over(by_key), "n": F.count(F.lit(1)).over(by_key)}).where("lo < hi")
    label = label.withColumn("blocks", F.ceil(F.col("n") / KEY_ROWS).cast("int")).withColumn("blk", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int"))
    label = label.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    label = label.select("key", F.least("blk", "other").cast("int").alias("bi"), F.greatest("blk", "other").cast("int").alias("bj"), "blk", "h", "cls")
    keys = ["key", "bi", "bj"]
    traits = texts.mapInArrow(lean(_traits), "h long, size int, tally binary")
    sized = label.join(traits, "h")
    pairs = sized.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lean(_pairs(tau)), "a long, b long").distinct()
    pairs = stage(pairs.join(stars, ["a", "b"], "left_anti"), "lines-pairs")
    links = settle(spark, links, pairs, checked)
    roots = components(spark, links).toDF("h", "root")
    named = first.join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
    least = named.groupBy("root").agg(F.min("f").alias("keep"))
    classes = named.join(least, "root").select("h", F.col("keep.id").alias("keep_id"), F.col("keep.pos").alias("keep_pos"))
    return seen, stage(classes, "lines-classes")


def _traits(batches):
    """Task: (h, size, tally): length in characters and counts of characters by their code modulo 32."""
    for b in batches:
        sizes, tallies = [], []
        for line in b.column("line").to_pylist():
            points = np.frombuffer(line.encode("utf-32-le"), np.uint32)
            sizes.append(len(points))
            tallies.append(np.bincount(points & np.uint32(31), minlength=32).astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([b.column("h"), pa.array(sizes, pa.int32()), pa.array(tallies, pa.binary())], names=["h", "size", "tally"])


def _pairs(tau: int):
    """Task over rows sorted by (key, bi, bj): pairs in different classes that lengths and tallies allow.

    One edit changes a tally by two at most, so lines within ``tau`` edits differ by
    at most twice ``tau``.
    """

    def run(batches):
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            found, rest = cut(t, False)
            yield from found
        if rest is not None and rest.num_rows:
            yield from cut(rest, True)[0]

    def cut(t: pa.Table, last: bool):
        col = {c: t.column(c).to_numpy() for c in ("key", "bi", "bj", "blk", "h", "cls", "size")}
        edge = np.flatnonzero((col["key"][1:] != col["key"][:-1]) | (col["bi"][1:] != col["bi"][:-1]) | (col["bj"][1:] != col["bj"][:-1])) + 1
        edge = np.concatenate([[0], edge, [t.num_rows]])
        stop = len(edge) - 1 if last else len(edge) - 2
        out = []
        for k in range(stop):
            a, z = edge[k], edge[k + 1]
            if z - a < 2:
                continue
            h, cls, size, blk = (col[c][a:z] for c in ("h", "cls", "size", "blk"))
            tally = np.stack([np.frombuffer(x, "<u4") for x in t.column("tally").slice(a, z - a).to_pylist()]).astype(np.int64)
            left, right = np.flatnonzero(blk == col["bi"][a]), np.flatnonzero(blk == col["bj"][a])
            for i in left:
                js = right[right > i] if col["bi"][a] == col["bj"][a] else right
                js = js[(cls[js] != cls[i]) & (np.abs(size[js] - size[i]) <= tau)]
                if len(js):
                    js = js[np.abs(tally[js] - tally[i]).sum(axis=1) <= 2 * tau]
                    out.append(np.stack([np.minimum(h[js], h[i]), np.maximum(h[js], h[i])], 1))
        rows = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
        made = [pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, 0])), pa.array(np.ascontiguousarray(rows[:, 1]))], names=["a", "b"])] if out else []
        return made, None if last else t.slice(edge[stop])

    return run


def _without_repeats(documents: DataFrame, tau: int, min_chars: int, id_col: str, text_col: str) -> tuple[DataFrame, Column, Column, Column]:
    """``(documents with the lines to cut, text without them, lines with a word, lines cut)``."""
    if min_chars <= 2 * tau:
        raise ValueError("min_chars must be over twice tau")
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    own, lines = fresh(documents, "cut_id"), fresh(documents, "cut_lines")
    with scratch(documents.sparkSession) as keep:
        seen, classes = line_classes(docs, tau, min_chars)
        gone = seen.join(classes, "h").where(~(F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("pos") == F.col("keep_pos"))))
        cut = stage(gone.groupBy(F.col("id").alias(own)).agg(F.collect_set("pos").alias(lines)), "lines-cut")  # the lines of one document
        keep(cut)
    small = F.broadcast(cut) if is_small(cut) else cut
    # A column of its own: inside the lambda below the split would run once for each line.
    split = fresh(documents, "cut_parts")
    parts = F.col(split)
    wide = documents.join(small, F.col(id_col).cast("long").eqNullSafe(F.col(own)), "left")
    wide = wide.withColumn(split, F.split(F.col(text_col), "\n", -1))
    inked = F.size(F.filter(parts, lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    numbers = F.array_except(F.sequence(F.lit(0).cast("long"), F.size(parts).cast("long") - 1), F.col(lines))
    kept = F.array_join(F.transform(numbers, lambda i: F.get(parts, i.cast("int"))), "\n")
    text = F.when(F.col(lines).isNull(), F.col(text_col)).otherwise(kept).alias(text_col)
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(inked).cast("long")
    return wide, text, n_lines, F.when(F.col(lines).isNull(), 0).otherwise(F.size(lines)).cast("long")


def dedup_lines(documents: DataFrame, *, tau: int = 2, min_chars: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` with repeated lines cut from the text, plus ``n_lines`` and ``n_removed`` (lines with a word).

    Columns of these two names in ``documents`` are replaced.
    """
    wide, text, n_lines, n_removed = _without_repeats(documents, tau, min_chars, id_col, text_col)
    own = [text if c == text_col else F.col(f"`{c}`") for c in documents.columns if c.lower() not in ("n_lines", "n_removed")]
    return wide.select(*own, n_lines.alias("n_lines"), n_removed.alias("n_removed"))


def drop_repeated_lines(documents: DataFrame, *, tau: int = 2, min_chars: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` with repeated lines cut; a document goes when it had lines and lost them all."""
    wide, text, n_lines, n_removed = _without_repeats(documents, tau, min_chars, id_col, text_col)
    return wide.where((n_removed == 0) | (n_removed < n_lines)).select(*[text if c == text_col else F.col(f"`{c}`") for c in documents.columns])
