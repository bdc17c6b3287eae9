"""Numpy views of Arrow text columns: chunks, word spans, word hashes.

All functions work on whole texts.  A chunk is a run of whole documents of about
``CHUNK_BYTES``, so that the 8-byte-per-byte work arrays stay small whatever the
size of an Arrow batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

U64 = np.uint64
_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)
_SEQ = 0xD6E8FEB86659FD93 | 1


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry mask that is True inside the given inclusive byte ranges."""
    mask = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        mask[lo : hi + 1] = True
    return mask


#: Words ``[^\x20\x09-\x0D]+``: bytes that end a word.
WHITE = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
NOT_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: Byte table that lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a text column, null as empty; offsets has n + 1 entries."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    n = len(col)
    if off is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def chunks(col, limit: int = CHUNK_BYTES, rows: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first, last, bytes, offsets)`` for runs of at most ``rows`` whole documents; offsets start at 0."""
    data, offsets = buffers(col)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, n, i + rows)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


@lru_cache(maxsize=1)
def _trim():
    """The C library's call that hands free memory back; nothing where it has none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return int


#: What a worker keeps between tasks: name -> how to drop it.
_KEPT: dict[str, object] = {}


def keep_between_tasks(name: str, drop) -> None:
    _KEPT[name] = drop


def _drop_all_but(keeps: str | None) -> None:
    for name, drop in _KEPT.items():
        if name != keeps:
            drop()


def trim() -> None:
    """Hand freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def lean(task, keeps: str | None = None):
    """``task`` (over Arrow batches) that hands freed memory back to the system when it ends.

    Workers live on between tasks and stages; without it each keeps the peak of all of them.
    What an earlier stage kept in the worker (``keep_between_tasks``) goes at the start, except
    ``keeps``, which this task uses too.
    """

    def run(batches):
        _drop_all_but(keeps)
        yield from task(batches)
        trim()

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: Powers kept by a worker: enough for a chunk; a longer text makes its own for the time of use.
_KEPT_POWERS = CHUNK_BYTES + 1


def _make_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64."""
    up, down = np.full(size, _MULT, U64), np.full(size, _INV, U64)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(up), np.cumprod(down)


@lru_cache(maxsize=1)
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _make_powers(_KEPT_POWERS)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, 257, dtype=U64) * U64(_MULT))


def value_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of 64-bit values; equal spans give equal hashes wherever they stand."""
    up, down = _kept_powers() if len(values) < _KEPT_POWERS else _make_powers(len(values) + 1)
    with np.errstate(over="ignore"):
        acc = np.zeros(len(values) + 1, U64)
        np.cumsum(values * up[: len(values)], out=acc[1:])
        return mix((acc[end] - acc[start]) * down[start] + (end - start).astype(U64))


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``value_hash`` of byte spans."""
    return value_hash(_byte_values()[data], start, end)


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, doc)`` of each maximal run of bytes outside ``breaks``, cut at document ends."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~breaks[data]
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begin[edge] = inside[edge]
    stop[edge - 1] = inside[edge - 1]
    start = np.flatnonzero(begin)
    return start, np.flatnonzero(stop) + 1, np.searchsorted(offsets, start, side="right") - 1


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its ``size``-word shingles.

    A document of fewer words gives one hash of its whole word sequence; a document
    without words gives none.
    """
    data = LOWER[data]
    n = len(offsets) - 1
    start, end, doc = words(data, offsets, WHITE)
    count = np.bincount(doc, minlength=n) if len(doc) else np.zeros(n, np.int64)
    first = np.concatenate([[0], np.cumsum(count)])
    with np.errstate(over="ignore"):
        w = span_hash(data, start, end)
        powers = np.array([pow(_SEQ, k, 1 << 64) for k in range(size)], dtype=U64)
        full = max(0, len(w) - size + 1)
        h = np.zeros(full, U64)
        for k in range(size):
            h += w[k : k + full] * powers[k]
        h = mix(h)
        out = []
        for d in range(n):
            a, b = first[d], first[d + 1]
            if b - a >= size:
                out.append(np.unique(h[a : b - size + 1]))
            elif b > a:
                out.append(mix(np.array([(w[a:b] * powers[: b - a]).sum(dtype=U64) + U64(b - a)], dtype=U64)))
            else:
                out.append(np.zeros(0, U64))
    return out


def set_print(s: np.ndarray) -> int:
    """A signed 64-bit fingerprint of a sorted set of hashes."""
    with np.errstate(over="ignore"):
        v = mix(np.array([mix(s + U64(1)).sum(dtype=U64) + U64(len(s)) * U64(_MULT)], dtype=U64))
    return int(v.view(np.int64)[0])


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per document whether it holds a letter of any script."""
    lower = data | 0x20
    ascii_letter = (lower >= 0x61) & (lower <= 0x7A) & (data < 0x80)
    acc = np.concatenate([[0], np.cumsum(ascii_letter)])
    found = acc[offsets[1:]] > acc[offsets[:-1]]
    for d in np.flatnonzero(~found):
        raw = data[offsets[d] : offsets[d + 1]]
        if (raw >= 0x80).any():
            found[d] = any(ch.isalpha() for ch in raw.tobytes().decode("utf-8", "replace"))
    return found


def i64(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.int64)
