"""Best-fit packing of tokenized documents into fixed-length sequences.

Method.  Documents become pieces of at most ``capacity`` tokens (only longer ones
are cut).  Packing depends on the piece lengths alone, so the plan is made on the
histogram of lengths: at most ``capacity`` counts, whatever the corpus.
Martello-Toth dominance reduction fixes sets that no other set with the same
largest piece can beat; best-fit decreasing packs what is left, again by counts.
The plan is a short list of slots ``(length, first rank, copies, first sequence,
offset)``.  Each piece finds its slot by its rank among the pieces of its length;
ranks are counted per written part and length and summed across parts by Spark, so
neither the driver nor one task ever holds the pieces.

Cases.  Null or empty text: only the end id, one piece of one token.  Empty table:
no piece.  Repeated rows and null ids: every row is packed as its own document.
Only the id and text columns are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeload.llm.graph import stage
from lakeload.llm.text import lean
from lakeload.llm.tokens import KEPT, encoded

PIECES = "part int, doc_id long, piece int, start long, length long, place long, ids binary"


def reduce_and_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """``[(lengths of a sequence, copies)]`` for a histogram ``length -> count`` (lengths 1..capacity)."""
    left = {s: c for s, c in counts.items() if c > 0}
    if any(s < 1 or s > capacity for s in left):
        raise ValueError("lengths must be in 1..capacity")
    sizes = sorted(left)
    plan: list[tuple[tuple[int, ...], int]] = []

    def take(s: int, c: int) -> None:
        left[s] -= c
        if not left[s]:
            del left[s]
            sizes.remove(s)

    def fits(room: int, without: int) -> int | None:
        """Largest length that still fits beside one piece of ``without``."""
        at = bisect_left(sizes, room + 1) - 1
        while at >= 0:
            if sizes[at] != without or left[without] > 1:
                return sizes[at]
            at -= 1
        return None

    def smallest(n: int, without: int) -> list[int]:
        """The ``n`` smallest pieces besides one of ``without``."""
        out: list[int] = []
        for s in sizes:
            out += [s] * min(n - len(out), left[s] - (s == without))
            if len(out) >= n:
                break
        return out

    def best_pair(room: int, without: int) -> int:
        """Largest sum of two pieces within ``room``."""
        best = 0
        for a in sizes:
            if 2 * a > room:
                break
            free = left[a] - (a == without)
            if free < 1:
                continue
            at = bisect_left(sizes, room - a + 1) - 1
            while at >= 0 and sizes[at] >= a:
                b = sizes[at]
                if left[b] - (b == without) - (b == a) >= 1:
                    best = max(best, a + b)
                    break
                at -= 1
        return best

    for j in sorted(left, reverse=True):
        while j in left:
            room = capacity - j
            k = fits(room, j)
            if k is None:
                plan.append(((j,), left[j]))
                take(j, left[j])
                continue
            few = smallest(3, j)
            alone = len(few) < 2 or few[0] + few[1] > room
            dominant = j + k == capacity or alone
            if not dominant and (len(few) < 3 or sum(few) > room):
                dominant = best_pair(room, j) <= k
            if not dominant:
                break
            n = left[j] // 2 if j == k else min(left[j], left[k])
            plan.append(((j, k), n))
            take(j, n)
            take(k, n)

    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, fill: tuple[int, ...], n: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((fill, n))

    for s in sorted(left, reverse=True):
        c = left[s]
        while c:
            at = bisect_left(rooms, s)
            if at < len(rooms):
                room = rooms[at]
                fill, n = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
                used = min(n, c)
                put(room - s, fill + (s,), used)
                if n > used:
                    put(room, fill, n - used)
                c -= used
            else:
                each = min(c, capacity // s)
                n = c // each
                put(capacity - each * s, (s,) * each, n)
                c -= n * each
    return plan + [x for room in rooms for x in open_[room]]


def slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Slot arrays sorted by (length, first rank)."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for fill, n in plan:
        offset = 0
        for s in fill:
            rows.append((s, used.get(s, 0), sequence, offset))
            used[s] = used.get(s, 0) + n
            offset += s
        sequence += n
    a = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), np.ascontiguousarray(a.T)))


def _tokenize(path: str, spaced: bool, end_id: int, capacity: int):
    def run(batches):
        met: dict[int, int] = {}
        part = TaskContext.get().partitionId()
        for b in batches:
            docs = b.column(0).to_pylist()
            for first, ids, off in encoded(path, spaced, b.column(1)):
                rows = []
                for d in range(len(off) - 1):
                    own = np.append(ids[off[d] : off[d + 1]], np.uint32(end_id))
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        cut = own[start : start + capacity]
                        n = len(cut)
                        met[n] = met.get(n, -1) + 1
                        rows.append((part, docs[first + d], piece, start, n, met[n], cut.astype("<u4").tobytes()))
                yield _batch(rows)

    return run


def _batch(rows):
    cols = list(zip(*rows))
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["part", "doc_id", "piece", "start", "length", "place", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)


def _place(slot: dict[str, np.ndarray]):
    wide = slot["length"] << np.int64(44)

    def run(batches):
        for b in batches:
            rank = b.column("base").to_numpy() + b.column("place").to_numpy()
            at = np.searchsorted(wide + slot["rank"], (b.column("length").to_numpy() << np.int64(44)) + rank, side="right") - 1
            sequence = slot["sequence"][at] + rank - slot["rank"][at]
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "crc")] + [pa.array(sequence), pa.array(slot["offset"][at])]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "crc", "sequence_id", "offset"])

    return run


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    *,
    capacity: int = 2048,
    end_id: int = 0,
    spaced: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """``(pieces, places)``.

    ``pieces`` is the written table with the token ids of each piece (little-endian
    unsigned 32-bit); ``places`` gives each piece its sequence and offset and the
    crc32 of its ids.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    pieces = stage(docs.mapInArrow(lean(_tokenize(tokenizer_path, spaced, end_id, capacity), keeps=KEPT), PIECES), "pack-pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("long"))
    base = stage(base, "pack-base")
    counts = {r["length"]: r["n"] for r in base.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    plan = slots(reduce_and_fit(counts, capacity))
    small = pieces.select("part", "doc_id", "piece", "start", "length", "place", F.crc32("ids").alias("crc"))
    places = small.join(base.select("length", "part", "base"), ["length", "part"])
    places = places.mapInArrow(lean(_place(plan)), "doc_id long, piece int, start long, length long, crc long, sequence_id long, offset long")
    return pieces, places
