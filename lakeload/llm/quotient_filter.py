"""Counting quotient filters over packed word-id n-grams: lossless counters in sorted, mergeable blobs.

A key is an n-gram of up to three word ids of ``bits`` bits each, packed into two halves of
``half_bits(bits)`` bits.  ``permute`` is a Feistel network over the halves, so it is
invertible and deals any keys out evenly.  The leading bits of a permuted key name its
block, the next bits are the quotient, and everything else is kept as the full remainder:
a filter therefore gives back its keys, and counts are exact.  Entries are sorted;
a blob holds one ``occupied`` bit a quotient, one ``run end`` bit an entry, the
remainders in whole bytes and one-byte counters (larger counts follow in a list of their own).
"""

from __future__ import annotations

import numpy as np

from lakeload.llm.text import U64, mix

#: Round keys of the Feistel network: any odd numbers do.
_ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
#: Widest word id: two halves of 63 bits.
MAX_BITS = 42

Keys = tuple[np.ndarray, np.ndarray]


def half_bits(bits: int) -> int:
    return (3 * bits + 1) // 2


def _ones(n: int) -> np.uint64:
    return U64((1 << n) - 1)


def pack(a: np.ndarray, b: np.ndarray, c: np.ndarray, bits: int) -> Keys:
    """The halves of ``a, b, c`` written side by side in ``bits`` bits each."""
    h = half_bits(bits)
    a, b, c = (x.astype(U64) for x in (a, b, c))
    return a << U64(2 * bits - h) | b >> U64(h - bits), (b & _ones(h - bits)) << U64(bits) | c


def unpack(hi: np.ndarray, lo: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = half_bits(bits)
    b = lo >> U64(bits) | (hi & _ones(2 * bits - h)) << U64(h - bits)
    return tuple(x.astype(np.int64) for x in (hi >> U64(2 * bits - h), b, lo & _ones(bits)))


def _scrambled(x: np.ndarray, key: int, h: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(x + U64(key)) & _ones(h)


def permute(hi: np.ndarray, lo: np.ndarray, h: int) -> Keys:
    for i, key in enumerate(_ROUNDS):
        if i % 2:
            lo = lo ^ _scrambled(hi, key, h)
        else:
            hi = hi ^ _scrambled(lo, key, h)
    return hi, lo


def unpermute(hi: np.ndarray, lo: np.ndarray, h: int) -> Keys:
    for i, key in reversed(list(enumerate(_ROUNDS))):
        if i % 2:
            lo = lo ^ _scrambled(hi, key, h)
        else:
            hi = hi ^ _scrambled(lo, key, h)
    return hi, lo


def tally(hi: np.ndarray, lo: np.ndarray, n: np.ndarray | None, h: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts (1 each without ``n``)."""
    if not len(hi):
        return hi, lo, np.zeros(0, np.int64)
    order = np.argsort(hi << U64(h) | lo, kind="stable") if 2 * h <= 64 else np.lexsort((lo, hi))
    hi, lo = hi[order], lo[order]
    new = np.ones(len(hi), bool)
    new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
    at = np.flatnonzero(new)
    total = np.diff(np.append(at, len(hi))) if n is None else np.add.reduceat(n[order], at)
    return hi[at], lo[at], total.astype(np.int64)


def _low_bytes(x: np.ndarray, bits: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (bits + 7) // 8]).tobytes()


def _from_bytes(raw: memoryview, n: int, bits: int) -> tuple[np.ndarray, memoryview]:
    width = (bits + 7) // 8
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(raw[: n * width], np.uint8).reshape(n, width)
    return wide.view("<u8").reshape(n), raw[n * width :]


def dump(hi: np.ndarray, lo: np.ndarray, n: np.ndarray, h: int, block_bits: int) -> bytes:
    """One block's entries (sorted, distinct, permuted) as a filter blob."""
    q = max(0, min(h - block_bits, int(len(hi)).bit_length() - 1))
    rest = h - block_bits - q
    quotient = (hi >> U64(rest) & _ones(q)).astype(np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    run_end = np.append(quotient[1:] != quotient[:-1], True)
    head = np.array([len(hi), q, int(hi[0] >> U64(h - block_bits))], "<i8")
    parts = [head.tobytes(), np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(), _low_bytes(hi & _ones(rest), rest), _low_bytes(lo, h)]
    return b"".join([*parts, np.minimum(n, 255).astype(np.uint8).tobytes(), n[n >= 255].astype("<i8").tobytes()])


def load(blob: memoryview, h: int, block_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of a blob, as they were before ``dump``."""
    raw = memoryview(blob)
    size, q, block = (int(x) for x in np.frombuffer(raw[:24], "<i8"))
    raw, rest = raw[24:], h - block_bits - q
    slots, ends = ((1 << q) + 7) // 8, (size + 7) // 8
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(raw[:slots], np.uint8), count=1 << q))
    run_end = np.unpackbits(np.frombuffer(raw[slots : slots + ends], np.uint8), count=size)
    quotient = occupied[np.cumsum(run_end) - run_end].astype(U64)
    hi, raw = _from_bytes(raw[slots + ends :], size, rest)
    lo, raw = _from_bytes(raw, size, h)
    n = np.frombuffer(raw[:size], np.uint8).astype(np.int64)
    n[n == 255] = np.frombuffer(raw[size:], "<i8")
    return hi | quotient << U64(rest) | U64(block << (h - block_bits)), lo, n


def split(hi: np.ndarray, lo: np.ndarray, n: np.ndarray, h: int, block_bits: int):
    """Yield ``(block, entries, blob)`` for each block of sorted entries."""
    block = (hi >> U64(h - block_bits)).astype(np.int64)
    at = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, np.int64)
    for i, j in zip(at, np.append(at[1:], len(block))):
        yield int(block[i]), int(j - i), dump(hi[i:j], lo[i:j], n[i:j], h, block_bits)


def merged(blobs, h: int, block_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sum of several filters of one block."""
    hi, lo, n = (np.concatenate(x) for x in zip(*(load(b, h, block_bits) for b in blobs)))
    return tally(hi, lo, n, h)
