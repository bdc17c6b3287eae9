"""N-gram Jaccard join: documents whose word-shingle sets have a Jaccard similarity of at least ``num/den``.

Method.  Every document becomes a sorted set of shingle hashes.  Equal sets are one
node, so copies never pair up.  A pair can only link when both sets share one of
their first ``n - ceil(t n) + 1`` shingles in a common order (prefix filter).  The order
puts shingles of one set first, then those met again, then those met often; only
shingles that may have been met again are looked up at all, so boilerplate and
chance repeats gather no unlike documents.  Which shingles are met again is found
exactly, by hash range, and kept as a bitmap of ``MAX_MET_BITS`` bits at most; a
full bitmap would cost speed, never a link.  Nodes that share such a shingle meet in size-banded tiles:
a tile holds the sets of one size band and the next smaller one.  In a tile, hashed
bitmap signatures bound the overlap from above: a bit set in one signature only is
an element the other set lacks, so ``overlap <= min(|x| - |X & ~Y|, |y| - |Y & ~X|)``.
Pairs that stay are confirmed by exact intersection of the sorted arrays.

Skew.  The search runs in rounds and keeps all links.  ``STAR_ROUNDS`` rounds check
for every node one hub, the smallest node of most of its shingles, and join the
confirmed links to components (linear in the rows).  The tile rounds compare, tile
by tile, only nodes that are still in different components: ``TILE_ROUNDS`` of them keep
the most promising pair of each component in a tile (linear too), the last one keeps
every pair that is left.  A tile of more than ``TILE_ROWS`` rows is cut
into blocks and the blocks meet pairwise, so no task holds an unbounded group.

Cases.  Null or empty text, or text without words: no shingles, linked with
nothing.  Fewer words than the shingle size: the whole sequence is one shingle.
Ties and repeated rows: equal texts are one node, every row is returned with its
class.  An empty table gives an empty result.  Only the id and text columns are
read, so further columns never clash.  A null id is kept as a row; its class is
the smallest non-null id of the component, null when there is none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeload.functions.sizing import input_bytes, is_small
from lakeload.llm.graph import components, fresh, scratch, settle, stage
from lakeload.llm.text import U64, chunks, i64, lean, set_print, shingles

#: Rows of a tile that are compared at once.
TILE_ROWS = 2048
#: Shingles counted as common are sorted last; how many are known only changes the
#: speed, any list gives the same links.
COMMON_LOCAL, COMMON_TOTAL, COMMON_LIST = 3, 8, 200_000
#: Bitmap of shingles met again: bits at most; input bytes of a hash range.
MAX_MET_BITS, RANGE_BYTES = 1 << 29, 8 << 20
STAR_ROUNDS = 2
#: Tile rounds that keep one pair of each component in a tile, before the round that keeps all.
TILE_ROUNDS = 1
#: Shingles that are counted together before the counts leave a task.
COUNT_ROWS = 3_000_000
#: Bits of a signature: four to eight for each element; past ``MAX_BITS`` the bound is only weaker.
BITS_EACH, MIN_BITS, MAX_BITS = 4, 256, 131072


def need(nx, ny, num: int, den: int):
    """Least overlap of two sets of these sizes that link: ``den * i >= num * (nx + ny - i)``."""
    return -(-num * (nx + ny) // (num + den))


def signature(s: np.ndarray) -> bytes:
    """Bitmap of ``s``, a power of two of bits, at least ``BITS_EACH`` for each element."""
    bits = min(MAX_BITS, max(MIN_BITS, 1 << int(BITS_EACH * len(s) - 1).bit_length()))
    flags = np.zeros(bits, np.uint8)
    flags[(s >> U64(17)) & U64(bits - 1)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def fold(sig: np.ndarray, width: int) -> np.ndarray:
    """A bitmap (rows of bytes) folded to ``width`` bytes; the bounds stay valid."""
    return sig if sig.shape[-1] == width else np.bitwise_or.reduce(sig.reshape(*sig.shape[:-1], -1, width), axis=-2)


def overlap_bound(nx, x: np.ndarray, ny, y: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap from the bitmaps (last axis: 8-byte words)."""
    only_x = np.bitwise_count(x & ~y).sum(axis=-1, dtype=np.int64)
    only_y = np.bitwise_count(y & ~x).sum(axis=-1, dtype=np.int64)
    return np.minimum(nx - only_x, ny - only_y)


def _sets(batches: Iterator[pa.RecordBatch], size: int):
    """``(ids, sets)`` for each chunk of documents."""
    for b in batches:
        ids = b.column(0)
        for i, j, data, off in chunks(b.column(1)):
            yield ids.slice(i, j - i), shingles(data, off, size)


SIGNED = "id long, n long, fp long, sig binary, token long, seen long, range int, tokens binary"


def _rows(count: int, **cols) -> pa.RecordBatch:
    """A batch of ``SIGNED`` rows with the given columns, null elsewhere."""
    kinds = {"id": pa.int64(), "n": pa.int64(), "fp": pa.int64(), "sig": pa.binary(), "token": pa.int64(), "seen": pa.int64(), "range": pa.int32(), "tokens": pa.binary()}
    return pa.RecordBatch.from_arrays([cols[c] if c in cols else pa.nulls(count, t) for c, t in kinds.items()], names=list(kinds))


def _sign(size: int, range_bits: int):
    """Task: rows of documents (id, n, fp, sig), of shingles met often (token, seen), and of
    the shingles of one hash range (range, the next 32 bits of each)."""

    def run(batches):
        held, rows, prints = [], 0, set()

        def count():
            every = np.sort(np.concatenate(held))
            start = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
            times = np.diff(np.r_[start, len(every)])
            often = times >= COMMON_LOCAL
            v, c = every[start[often]], times[often]
            yield _rows(len(v), token=pa.array(i64(v)), seen=pa.array(c.astype(np.int64)))
            edge = np.searchsorted(every, np.arange(1 << range_bits, dtype=U64) << U64(64 - range_bits))
            short = (every >> U64(32 - range_bits)).astype(np.uint32)
            parts = np.split(short, edge[1:])
            yield _rows(len(parts), range=pa.array(range(len(parts)), pa.int32()), tokens=pa.array([p.tobytes() for p in parts], pa.binary()))

        for ids, sets in _sets(batches, size):
            k = len(sets)
            fps = [set_print(s) if len(s) else None for s in sets]
            yield _rows(
                k,
                id=ids,
                n=pa.array([len(s) for s in sets], pa.int64()),
                fp=pa.array(fps, pa.int64()),
                sig=pa.array([signature(s) if len(s) else None for s in sets], pa.binary()),
            )
            for s, p in zip(sets, fps):
                if p is not None and p not in prints:  # copies count once
                    prints.add(p)
                    held.append(s)
                    rows += len(s)
            if rows >= COUNT_ROWS:
                yield from count()
                held, rows, prints = [], 0, set()
        if held:
            yield from count()

    return run


def _met_again(cell_bits: int):
    """Task: the bitmap of each hash range; a bit stands for the next ``cell_bits`` bits of a shingle met twice."""

    def run(batches):
        held: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for r, t in zip(b.column("range").to_pylist(), b.column("tokens")):
                held.setdefault(r, []).append(np.frombuffer(t.as_buffer().to_pybytes(), np.uint32))
        for r, parts in held.items():
            every = np.sort(np.concatenate(parts))
            twice = every[1:][every[1:] == every[:-1]]
            flags = np.zeros(max(8, 1 << cell_bits), np.uint8)
            flags[twice >> np.uint32(32 - cell_bits)] = 1
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([np.packbits(flags[: 1 << cell_bits], bitorder="little").tobytes()], pa.binary())], names=["range", "bits"])

    return run


def _prefixes(size: int, num: int, den: int, common: np.ndarray, rank: np.ndarray, met: np.ndarray, met_bits: int):
    """Task: distinct (token, fp) of the prefix of each set, without shingles of one set only."""

    def run(batches):
        for _, sets in _sets(batches, size):
            tokens, prints = [], []
            for s in sets:
                n = len(s)
                if not n:
                    continue
                p = n - -(-num * n // den) + 1
                cell = s >> U64(64 - met_bits)
                again = (met[(cell >> U64(3)).astype(np.int64)] >> (cell & U64(7)).astype(np.uint8)) & 1 == 1
                room = p - int((~again).sum())
                if room <= 0:
                    continue  # the prefix holds nothing that another set has
                head = s[again]
                if len(common):
                    at = np.minimum(np.searchsorted(common, head), len(common) - 1)
                    often = np.where(common[at] == head, rank[at], 0)
                    head = head[np.argsort(often, kind="stable")]
                head = head[:room]
                tokens.append(head)
                prints.append(np.full(len(head), set_print(s), np.int64))
            if tokens:
                rows = np.unique(np.stack([i64(np.concatenate(tokens)), np.concatenate(prints)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, c])) for c in (0, 1)], names=["token", "fp"])

    return run


def _set_rows(size: int):
    """Task: (fp, items) with the sorted set as bytes."""

    def run(batches):
        for _, sets in _sets(batches, size):
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_print(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["fp", "items"]
            )

    return run


def _bitmap_filter(num: int, den: int):
    """Task: pairs (a, b, na, nb, siga, sigb) whose bitmaps allow enough overlap."""

    def run(batches):
        for b in batches:
            na, nb = b.column("na").to_numpy(), b.column("nb").to_numpy()
            sa, sb = b.column("siga").to_pylist(), b.column("sigb").to_pylist()
            ok = np.zeros(len(na), bool)
            for i, (x, y) in enumerate(zip(sa, sb)):
                w = min(len(x), len(y))
                x, y = (fold(np.frombuffer(z, np.uint8), w).view(U64) for z in (x, y))
                ok[i] = overlap_bound(int(na[i]), x, int(nb[i]), y) >= need(int(na[i]), int(nb[i]), num, den)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(ok)), b.column("b").filter(pa.array(ok))], names=["a", "b"])

    return run


def _intersect(num: int, den: int):
    """Task: pairs (a, b, x, y) whose sorted arrays overlap enough."""

    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column("x"), b.column("y")):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                ok.append(both >= need(len(x), len(y), num, den))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])

    return run


def _best_of_class(pairs: np.ndarray) -> np.ndarray:
    """Rows (a, b, class of a, class of b, margin): the row of the largest margin for each class."""
    ends = np.concatenate([pairs, pairs])
    of = np.concatenate([pairs[:, 2], pairs[:, 3]])
    by = np.lexsort((ends[:, 1], ends[:, 0], -ends[:, 4], of))
    first = np.r_[True, of[by][1:] != of[by][:-1]]
    return ends[by[first]]


def _tile_pairs(num: int, den: int, whole: bool):
    """Task over rows sorted by (token, tile, bi, bj): pairs of one tile, in different classes, that
    sizes and bitmaps allow; all of them, or the best one for each class."""
    keys = ("token", "tile", "bi", "bj")

    def cut(t: pa.Table, last: bool):
        t = t.combine_chunks()
        col = {c: t.column(c).to_numpy() for c in (*keys, "blk", "fp", "cls", "n")}
        home = t.column("home").to_numpy(zero_copy_only=False)
        edge = np.flatnonzero(np.any([col[c][1:] != col[c][:-1] for c in keys], axis=0)) + 1
        edge = np.concatenate([[0], edge, [t.num_rows]])
        stop = len(edge) - 1 if last else len(edge) - 2
        out = []
        for k in range(stop):
            own = slice(edge[k], edge[k + 1])
            fp, cls, n, blk = (col[c][own] for c in ("fp", "cls", "n", "blk"))
            if len(fp) < 2:
                continue
            raw = t.column("sig").slice(edge[k], len(fp)).to_pylist()
            width = min(map(len, raw))
            sig = np.stack([fold(np.frombuffer(x, np.uint8), width) for x in raw]).view(U64)
            bi, bj = col["bi"][edge[k]], col["bj"][edge[k]]
            left, right = np.flatnonzero(blk == bi), np.flatnonzero(blk == bj)
            held = []
            for i in left:
                js = right[right > i] if bi == bj else right
                js = js[(cls[js] != cls[i]) & (home[own][i] | home[own][js])]
                js = js[den * np.minimum(n[js], n[i]) >= num * np.maximum(n[js], n[i])]
                if len(js):
                    margin = overlap_bound(n[i], sig[i], n[js], sig[js]) - need(n[i], n[js], num, den)
                    js, margin = js[margin >= 0], margin[margin >= 0]
                    pair = np.stack([np.minimum(fp[js], fp[i]), np.maximum(fp[js], fp[i])], 1)
                    if whole:
                        out.append(pair)
                    elif len(js):
                        held.append(_best_of_class(np.column_stack([pair, np.full(len(js), cls[i]), cls[js], margin])))
            if held:
                out.append(_best_of_class(np.concatenate(held))[:, :2])
        rows = np.unique(np.concatenate(out), axis=0) if out else None
        made = [] if rows is None else [pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, c])) for c in (0, 1)], names=["a", "b"])]
        return made, None if last else t.slice(edge[stop])

    def run(batches):
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            made, rest = cut(t if rest is None else pa.concat_tables([rest, t]), False)
            yield from made
        if rest is not None and rest.num_rows:
            yield from cut(rest, True)[0]

    return run


def _verified(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) confirmed by exact intersection; sets are made again for their documents only."""
    wanted = pairs.select(F.col("a").alias("fp")).union(pairs.select(F.col("b").alias("fp"))).distinct()
    reps = stage(nodes.join(wanted, "fp", "left_semi").select("rep"), "jaccard-reps")
    ids = F.broadcast(reps) if is_small(reps) else reps
    texts = docs.join(ids, docs["id"].eqNullSafe(ids["rep"]), "left_semi")
    sets = texts.mapInArrow(lean(_set_rows(size)), "fp long, items binary")
    sets = stage(sets.dropDuplicates(["fp"]), "jaccard-sets")
    x, y = sets.toDF("a", "x"), sets.toDF("b", "y")
    return pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y").mapInArrow(lean(_intersect(num, den)), "a long, b long")


def jaccard_classes(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, num: int = 3, den: int = 4
) -> DataFrame:
    """Per document: id, ``n_shingles``, ``component_id`` (smallest id reachable by links)."""
    with scratch(documents.sparkSession) as keep:
        rows, classes = _classes(documents, id_col, text_col, size, num, den)
        keep(rows, classes)
    rows = rows.where("token is null and range is null").select("id", "n", "fp")
    return rows.join(classes, "fp", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("fp").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _classes(documents: DataFrame, id_col: str, text_col: str, size: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """The written signatures (one row a document among others) and ``(fp, component_id)``."""
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    bytes_in = input_bytes(documents) or 0
    range_bits = min(20, max(4, int(bytes_in // RANGE_BYTES).bit_length()))
    met_bits = max(range_bits + 3, min(MAX_MET_BITS.bit_length() - 1, max(16, int(bytes_in // 4).bit_length())))
    signed = stage(docs.mapInArrow(lean(_sign(size, range_bits)), SIGNED), "jaccard-signed")
    rows = signed.where("token is null and range is null").select("id", "n", "fp", "sig")
    ranges = signed.where("range is not null").select("range", "tokens").repartition(1 << range_bits, "range")
    bits = np.zeros((1 << range_bits, 1 << (met_bits - range_bits - 3)), np.uint8)
    for r in ranges.mapInArrow(lean(_met_again(met_bits - range_bits)), "range int, bits binary").collect():  # MAX_MET_BITS in all
        bits[r["range"]] = np.frombuffer(r["bits"], np.uint8)
    again = bits.ravel()
    met = signed.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= COMMON_TOTAL)
    top = met.orderBy(F.desc("seen"), "token").limit(COMMON_LIST).toArrow()  # at most COMMON_LIST numbers
    common = np.ascontiguousarray(top["token"].to_numpy()).view(U64)
    by = np.argsort(common)
    common, rank = common[by], top["seen"].to_numpy()[by]

    signs = rows.where("fp is not null").groupBy("fp").agg(F.min("id").alias("rep"), F.min("n").alias("n"), F.first("sig").alias("sig"))
    signs = stage(signs, "jaccard-signs")
    nodes = signs.select("fp", "rep", "n")

    prefix = docs.mapInArrow(lean(_prefixes(size, num, den, common, rank, again, met_bits)), "token long, fp long")
    by_token = Window.partitionBy("token")
    prefix = prefix.repartition("token").dropDuplicates(["token", "fp"])
    prefix = prefix.withColumns({"hub": F.min("fp").over(by_token), "last": F.max("fp").over(by_token)})
    met = stage(prefix.where("hub < last").select("token", "fp", "hub"), "jaccard-met")

    def bounded(pairs: DataFrame) -> DataFrame:
        x, y = signs.select("fp", "n", "sig").toDF("a", "na", "siga"), signs.select("fp", "n", "sig").toDF("b", "nb", "sigb")
        both = pairs.join(y, "b").join(x, "a").where(den * F.least("na", "nb") >= num * F.greatest("na", "nb"))
        return both.select("a", "b", "na", "nb", "siga", "sigb").mapInArrow(lean(_bitmap_filter(num, den)), "a long, b long")

    # Each node and the smallest node that most of its shingles meet, as long as their components differ.
    links, tried = None, None
    for _ in range(STAR_ROUNDS):
        if links is None:
            shared = met.where("fp <> hub")
        else:
            roots = components(spark, links).toDF("fp", "root")
            cls = nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("cls"))
            shared = met.where("fp <> hub").join(cls, "fp").join(cls.toDF("hub", "hub_cls"), "hub").where("cls <> hub_cls")
            shared = shared.join(tried.select(F.col("a").alias("hub"), F.col("b").alias("fp")), ["hub", "fp"], "left_anti")
        best = shared.groupBy("fp", "hub").agg(F.count(F.lit(1)).alias("n")).groupBy("fp").agg(F.max(F.struct("n", "hub")).alias("m"))
        asked = stage(best.select(F.col("m.hub").alias("a"), F.col("fp").alias("b")), "jaccard-asked")
        found = stage(_verified(docs, stage(bounded(asked), "jaccard-stars"), nodes, size, num, den), "jaccard-links")
        links = found if links is None else links.union(found)
        tried = asked if tried is None else tried.union(asked)
    # The rest: nodes of one tile in different components.
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(den / num)) + 1e-9).cast("int")
    places = F.array(F.struct(F.col("band").alias("tile"), F.lit(True).alias("home")), F.struct((F.col("band") + 1).alias("tile"), F.lit(False).alias("home")))
    in_tile = Window.partitionBy("token", "tile")
    keys = ["token", "tile", "bi", "bj"]

    def candidates(whole: bool) -> DataFrame:
        roots = components(spark, links).toDF("fp", "root")
        known = nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("cls"), F.col("n").cast("int").alias("n"), band.alias("band"))
        label = met.select("token", "fp").join(known, "fp")
        label = label.withColumns({"lo": F.min("cls").over(by_token), "hi": F.max("cls").over(by_token)}).where("lo < hi")
        tiles = label.select("token", "fp", "cls", "n", F.explode(places).alias("t")).select("token", "fp", "cls", "n", "t.tile", "t.home")
        tiles = tiles.withColumns(
            {"rows": F.count(F.lit(1)).over(in_tile), "homes": F.max("home").over(in_tile), "lo": F.min("cls").over(in_tile), "hi": F.max("cls").over(in_tile)}
        ).where("rows > 1 and homes and lo < hi")
        tiles = tiles.withColumn("blocks", F.ceil(F.col("rows") / TILE_ROWS).cast("int"))
        tiles = tiles.withColumn("blk", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        tiles = tiles.select(
            "token", "tile", F.least("blk", "other").cast("int").alias("bi"), F.greatest("blk", "other").cast("int").alias("bj"), "blk", "fp", "cls", "n", "home"
        )
        tiles = tiles.join(signs.select("fp", "sig"), "fp")
        pairs = tiles.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lean(_tile_pairs(num, den, whole)), "a long, b long")
        return stage(pairs.distinct().join(tried.select("a", "b"), ["a", "b"], "left_anti"), "jaccard-pairs")

    for _ in range(TILE_ROUNDS):
        asked = candidates(False)
        links = links.union(stage(_verified(docs, asked, nodes, size, num, den), "jaccard-links"))
        tried = tried.union(asked)
    links = settle(spark, links, candidates(True), lambda p: _verified(docs, p, nodes, size, num, den))
    roots = components(spark, links).toDF("fp", "root")
    named = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    return signed, stage(named.join(least, "root").select("fp", "component_id"), "jaccard-classes")


def drop_near_copies(documents: DataFrame, **options) -> DataFrame:
    """``documents`` with one row of each class: the row of the smallest id.

    Rows with equal id and text are repeats of one document and all but one go;
    documents without words are in no class and stay.
    """
    id_col, kept_id = options.get("id_col", "doc_id"), fresh(documents, "kept_id")
    with scratch(documents.sparkSession) as keep:
        classes = jaccard_classes(documents, **options)
        kept = classes.where(F.col("component_id").eqNullSafe(F.col(id_col))).groupBy(F.col(id_col).alias(kept_id)).agg(F.count(F.lit(1)).alias("times"))
        kept = stage(kept, "jaccard-kept")
        keep(kept)
    out = documents.join(kept.select(kept_id), F.col(id_col).eqNullSafe(F.col(kept_id)), "left_semi")
    if kept.where("times > 1").isEmpty():
        return out
    return out.dropDuplicates([id_col, options.get("text_col", "text")])
