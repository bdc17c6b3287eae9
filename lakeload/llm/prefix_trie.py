"""Prefix trie of conversations: one row for each distinct sequence of first turns, with subtree aggregates.

Method (splitter skeleton).  A conversation is a path: 16 bytes of SHA-256 for each turn
(role and text), end to end, so byte order keeps the members of every node together.  A bounded
sample of paths gives splitters; the rows are dealt to the shards between
them and sorted.  Only a node that is a prefix of a splitter can have members in two shards:
those nodes are the skeleton, made of the broadcast splitters.  Every other node lies in one
shard, where one pass over the sorted rows, holding a single path of open nodes, finishes it.
Shards send partial sums for skeleton nodes; Spark adds them up by node, and one pass over
the skeleton carries them to the root.

Skew.  Splitters are pairs of path and conversation, so even copies of one conversation are
spread over shards (their nodes become skeleton nodes).  The skeleton is bounded: at most
``MAX_SHARDS`` splitters and ``SPLITTER_BYTES`` of splitter paths, whatever the table; a path longer
than ``LONGEST_SPLITTER`` is cut, which only widens a shard.  Ids that end at a skeleton
node are hashed in order from blocks, never held together.  A shard keeps the rows of a node's
children until the node ends, ``HELD_ROWS`` at most; later ones get their parent by a join.
One conversation is one row: its path takes 20 bytes a turn.

Cases.  Null role or text: empty.  Null turn: first; ties of turn: in the order of the turn's
digest.  Repeated turns are turns of their own.  Rows without conversation id: left out.
Long texts: hashed whole.  Empty table: no rows.  Only the four columns are read, so other
columns may have any name.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.graph import stage
from lakeload.llm.text import lean

#: Bytes of a turn in a path.
TURN = 16
MAX_SHARDS = 16_384
#: Longest splitter path and all sampled paths together.
LONGEST_SPLITTER = 4096 * TURN
SPLITTER_BYTES = 64 * 1024 * 1024
#: Sampled paths for each shard.
OVERSAMPLE = 8
#: Children rows that wait for their parent.
HELD_ROWS = 50_000
#: Bytes of a block of ids that end at a skeleton node, and rows of a result batch.
ENDS_BLOCK = 256 * 1024
BATCH = 8192

DONE, LATE, PART, NAME, ENDS = range(5)
_ROWS = "kind int, key binary, parent_key binary, conv_id long, parent_conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, chars long, ends_sha256 string, ends binary"
_COLUMNS = [c.split()[0] for c in _ROWS.split(", ")]
_KINDS = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.string(), pa.binary()]
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, turns)``: the digest (hex) and code points of each turn, in order."""
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    told = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    rows = rows.select("conv_id", F.struct("turn", F.substring(F.sha2(told, 256), 1, 2 * TURN).alias("digest"), F.length("text").alias("chars")).alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def grafted(told: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """``told`` with the first h turns of a conversation replaced by those of its base, ``conv_id - conv_id % every``.

    h is the crc32 of the id as text modulo ``heads``.  An absent base gives no turns.
    """
    base = told.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    both = told.select("conv_id", "turns", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base")).join(base, "base", "left")
    own = F.slice("turns", F.col("h") + 1, F.size("turns"))
    rebuilt = F.when(F.col("head").isNull(), own).otherwise(F.concat(F.slice("head", F.lit(1), F.col("h")), own))
    return both.select("conv_id", rebuilt.alias("turns"))


def _lcp(a: bytes, b: bytes) -> int:
    """Common turns at the start of two paths."""
    lo, hi = 0, min(len(a), len(b)) // TURN
    if a[: hi * TURN] == b[: hi * TURN]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[: mid * TURN] == b[: mid * TURN] else (lo, mid)
    return lo


def node_key(path: bytes, depth: int) -> bytes:
    return hashlib.blake2b(path[: depth * TURN], digest_size=16).digest()


class _Node:
    __slots__ = ("depth", "key", "least", "n", "children", "leaves", "saved", "chars", "ends", "held", "named")

    def __init__(self, depth: int, key: bytes | None, chars: int):
        self.depth, self.key, self.chars = depth, key, chars  # only skeleton nodes have a key from the start
        self.least, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.held, self.named = None, [], False


class _Walk:
    """One pass over sorted rows; ``rows`` gathers result rows."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = [path for path, _ in splitters]
        self.shard, self.path, self.open = None, b"", []
        self.rows: list[tuple] = []

    def _emit(self, kind: int, **values) -> None:
        self.rows.append((kind, *(values.get(c) for c in _COLUMNS[1:])))

    def _flush_ends(self, node: _Node) -> None:
        first, texts, _ = node.ends
        self._emit(ENDS, key=node.key, conv_id=first, ends=",".join(texts).encode())
        node.ends = None

    def _end(self, node: _Node, conv: int) -> None:
        """A conversation whose last node this is; they come in ascending order."""
        node.n += 1
        node.least = conv if node.least is None else min(node.least, conv)
        if node.key is None:
            if node.ends is None:
                node.ends = hashlib.sha256(str(conv).encode())
            else:
                node.ends.update(b",%d" % conv)
            return
        if node.ends is None:
            node.ends = [conv, [], 0]
        node.ends[1].append(str(conv))
        node.ends[2] += len(node.ends[1][-1]) + 1
        if node.ends[2] >= ENDS_BLOCK:
            self._flush_ends(node)

    def _close(self) -> None:
        node = self.open.pop()
        up = self.open[-1] if self.open else None
        if up is not None:
            up.n += node.n
            up.least = node.least if up.least is None else min(up.least, node.least)
        if node.key is not None:
            if node.ends is not None:
                self._flush_ends(node)
            parent = up.key if up is not None else None
            sums = dict(n_convs=node.n, n_children=node.children, n_leaves=node.leaves, saved_tokens=node.saved)
            self._emit(PART, key=node.key, parent_key=parent, conv_id=node.least, depth=node.depth, chars=node.chars, **sums)
            return
        for values in node.held:
            self._emit(DONE, parent_conv_id=node.least, **values)
        if node.named:
            self._emit(NAME, key=self._key(node), conv_id=node.least)
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.n - 1) * node.chars
        up.children += 1
        up.leaves += leaves
        up.saved += saved
        ends = (node.ends or hashlib.sha256()).hexdigest()
        values = dict(conv_id=node.least, depth=node.depth, n_convs=node.n, n_children=node.children, n_leaves=leaves, saved_tokens=saved, ends_sha256=ends)
        if up.key is not None:
            self._emit(LATE, parent_key=up.key, **values)
        elif len(up.held) < HELD_ROWS:
            up.held.append(values)
        else:
            up.named = True
            self._emit(LATE, parent_key=self._key(up), **values)

    def _key(self, node: _Node) -> bytes:
        return node_key(self.path, node.depth)

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth + 1:
            self._close()

    def add(self, shard: int, path: bytes, chars: list[int], conv: int) -> None:
        if shard != self.shard:
            self.finish()
            self.shard = shard
            self.bounds = self.splitters[max(0, shard - 1) : shard + 1]
            self.open = [_Node(0, node_key(b"", 0), 0)]
        else:
            self._close_to(_lcp(path, self.path))
        self.path = path
        shared = max((_lcp(path, s) for s in self.bounds), default=0)
        for d in range(len(self.open), len(path) // TURN + 1):
            self.open.append(_Node(d, node_key(path, d) if d <= shared else None, chars[d - 1]))
        self._end(self.open[-1], conv)

    def finish(self) -> None:
        while self.open:
            self._close()

    def batch(self) -> pa.RecordBatch:
        cols = [pa.array(c, t) for c, t in zip(zip(*self.rows), _KINDS)]
        self.rows = []
        return pa.RecordBatch.from_arrays(cols, names=_COLUMNS)


def _walk(splitters: list[tuple[bytes, int]]):
    def run(batches) -> Iterator[pa.RecordBatch]:
        walk = _Walk(splitters)
        for b in batches:
            chars = b.column("chars")
            for i, (shard, path, conv) in enumerate(zip(*(b.column(c).to_pylist() for c in ("shard", "path", "conv_id")))):
                walk.add(shard, path, chars[i].as_py(), conv)
                if len(walk.rows) >= BATCH:
                    yield walk.batch()
        walk.finish()
        if walk.rows:
            yield walk.batch()

    return run


def _deal(splitters: list[tuple[bytes, int]]):
    def run(batches):
        for b in batches:
            shard = [bisect_right(splitters, x) for x in zip(b.column("path").to_pylist(), b.column("conv_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *b.columns], names=["shard", *b.schema.names])

    return run


def choose_splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` ascending splitters from a bounded sample of ``(path, conv_id)``."""
    size = paths.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("path")).alias("longest")).first()
    if not size["n"]:
        return []
    each = min(LONGEST_SPLITTER, size["longest"]) + 64
    want = min(OVERSAMPLE * shards, SPLITTER_BYTES // each)
    drawn = paths.select(F.expr(f"substring(path, 1, {LONGEST_SPLITTER})").alias("path"), "conv_id")
    rows = drawn.sample(min(1.0, want / size["n"]), 17).limit(2 * want).collect()  # bounded: 2 * SPLITTER_BYTES
    met = sorted({(bytes(r["path"]), r["conv_id"]) for r in rows})
    step = len(met) / shards
    return sorted({met[int(i * step)] for i in range(1, shards)}) if met else []


def _climb(batches) -> Iterator[pa.RecordBatch]:
    """Totals of the skeleton nodes from their own sums: one pass from the deepest to the root."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: -r["depth"])
    at = {r["key"]: r for r in rows}
    for r in rows:
        if not r["n_children"]:
            r["n_leaves"] = 1
        r["saved_tokens"] += (r["n_convs"] - 1) * r["chars"]
        up = at.get(r["parent_key"])
        if up is not None:
            up["n_children"] += 1
            up["n_leaves"] += r["n_leaves"]
            up["saved_tokens"] += r["saved_tokens"]
    for i in range(0, len(rows), BATCH):
        yield pa.RecordBatch.from_pylist(rows[i : i + BATCH], schema=_SKELETON_ARROW)


_SKELETON = "key binary, parent_key binary, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, chars long"
_SKELETON_ARROW = pa.schema([(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in _SKELETON.split(", ")])


def _hash_ends(batches) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the blocks of each key, which come in order."""
    key, state = None, None

    def made():
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    for b in batches:
        for k, block in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            if k != key:
                if state is not None:
                    yield made()
                key, state = k, hashlib.sha256(block)
            else:
                state.update(b"," + block)
    if state is not None:
        yield made()


def prefix_trie(told: DataFrame, shards: int | None = None) -> DataFrame:
    """Trie nodes of ``(conv_id, turns)`` rows (one a conversation): the columns of ``_NODE``.

    A node's conv_id is its smallest member; ``n_leaves`` and ``saved_tokens`` are sums over its
    subtree; ``ends_sha256`` is over the ids of the conversations that end at it.
    """
    spark = told.sparkSession
    path = F.unhex(F.array_join(F.col("turns.digest"), "")).alias("path")
    paths = stage(told.select("conv_id", path, F.col("turns.chars").cast("array<long>").alias("chars")), "trie-paths")
    shards = max(1, min(MAX_SHARDS, shards or int(spark.conf.get("spark.sql.shuffle.partitions"))))
    splitters = choose_splitters(paths, shards)
    dealt = paths.select("conv_id", "path", "chars").mapInArrow(lean(_deal(splitters)), "shard int, conv_id long, path binary, chars array<long>")
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    rows = stage(dealt.mapInArrow(lean(_walk(splitters)), _ROWS), "trie-rows")

    parts = rows.where(F.col("kind") == PART).groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.first("chars").alias("chars"),
    )
    skeleton = stage(parts.repartition(1).mapInArrow(_climb, _SKELETON), "trie-skeleton")  # bounded by the splitters
    blocks = rows.where(F.col("kind") == ENDS).select("key", "conv_id", "ends")
    ends = blocks.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_hash_ends, "key binary, ends_sha256 string")
    named = rows.where(F.col("kind") == NAME).select("key", "conv_id").union(skeleton.select("key", "conv_id"))
    names = stage(named, "trie-names").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256().hexdigest()
    trunk = skeleton.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty))).join(names, "parent_key", "left")
    late = rows.where(F.col("kind") == LATE).drop("parent_conv_id").join(names, "parent_key")
    return rows.where(F.col("kind") == DONE).select(_NODE).union(late.select(_NODE)).union(trunk.select(_NODE))
