"""Token ids of whole texts with a public tokenizer file, each distinct piece of text encoded once.

Both vocabularies split a text into independent pieces at white space, and a full
stop or comma after a letter or digit is a piece of its own, so the ids of a text
are the ids of its pieces in order.  A worker keeps the short pieces it has met
(``CACHE_PIECES`` and ``CACHE_BYTES`` at most; then those met once go, and all where the others
fill over half); new pieces go through the tokenizers library, many in one call, as one text with a mark after each or as
words split beforehand.  Longer pieces (scripts without blanks) and texts with white space
outside ASCII, whose runs the split does not follow, are encoded for the one call
that needs them and not kept.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np

from lakeload.llm.text import keep_between_tasks

#: Pieces a worker keeps (about 150 bytes each).
CACHE_PIECES = 600_000
#: Bytes a worker's pieces, ids and their table entries may take, checked before each run of texts.
CACHE_BYTES = 160 * 1024 * 1024
#: A piece's entry: dictionary slot, bytes object, number and offset; and the most bytes of a kept piece.
PIECE_BYTES = 200
LONGEST_KEPT = 64
#: Pieces that go through the library at once.
ENCODE_PIECES = 1024
#: Stands after each of these where blanks do not count, so that they are one plain text (the library's fastest way).
MARK = "\x01"

#: White space outside ASCII, in UTF-8.
_OTHER_WHITE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_OTHER_BLANK = re.compile(rb"\xe2\x80[\x80-\x8a\xa8\xa9\xaf]")
_UNITS = re.compile(rb"[\x09-\x0d\x20]*[^\x09-\x0d\x20]+|[\x09-\x0d\x20]+")
#: White space other than single blanks and newlines between words.
_ODD = (b"\t", b"\x0b", b"\x0c", b"\r", b"  ", b" \n", b"\n ", b"\n\n")
_TAILS = b".,"
_WORDLIKE = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
#: Room for the tail's number above the piece's number; pieces that are not kept have a number range of their own.
_TAIL_BIT = 40
_PASSING = 1 << 39


class _Pieces(dict):
    """piece -> number in the pool (and of its tail); a miss books the piece for encoding."""

    def __init__(self, miss):
        super().__init__()
        self.miss = miss

    def __missing__(self, piece):
        return self.miss(piece)


class Encoder:
    """Ids of whole texts by one tokenizer file (``add_special_tokens=False``)."""

    def __init__(self, path: str, spaced: bool):
        """``spaced``: white space counts and leads the next piece (byte-level vocabularies)."""
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True
        self.spaced = spaced
        mark = self.lib.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if not spaced and len(mark) == 1 else None
        self.clear()

    def clear(self) -> None:
        self.flat, self.off = array("I"), array("q", [0])
        self.booked: list[bytes] = []
        self.passing: list[bytes] = []
        self.held = 0
        #: How often each piece was met.
        self.hits = np.zeros(0, np.int64)
        self.units = _Pieces(self._unit)
        self.after_space = _Pieces(self._after_space)
        self.tails = np.array([0, *(self._book(bytes([t])) for t in _TAILS)], np.int64)

    def kept_bytes(self) -> int:
        """About what the kept pieces take."""
        return self.held + 4 * len(self.flat) + 16 * len(self.off)

    def _full(self, share: float = 1.0) -> bool:
        return len(self.units) + len(self.after_space) > share * CACHE_PIECES or self.kept_bytes() > share * CACHE_BYTES

    def _renew(self) -> None:
        """Keep the pieces met more than once since the last time, none if they fill over half of the room."""
        often = self.hits > 1
        kept = [[(p, n) for p, n in t.items() if not n >> _TAIL_BIT and often[n]] for t in (self.units, self.after_space)]
        flat, off = np.array(self.flat, np.uint32), np.array(self.off, np.int64)
        tails = len(_TAILS)
        old = np.concatenate([np.arange(tails), *(np.array([n for _, n in k], np.int64) for k in kept)])
        self.clear()
        self.booked = []  # the tails come first and are encoded already
        first, size = self._spans(old, off)
        stop = np.cumsum(size)
        self.flat.frombytes(flat[np.repeat(first - (stop - size), size) + np.arange(int(stop[-1]))].tobytes())
        self.off.frombytes(stop.astype(np.int64).tobytes())
        self.hits = np.ones(len(old), np.int64)
        at = tails
        for table, own in zip((self.units, self.after_space), kept):
            table.update(zip((p for p, _ in own), range(at, at + len(own))))
            at += len(own)
            self.held += sum(len(p) + PIECE_BYTES for p, _ in own)
        if self._full(0.5):
            self.clear()

    def _book(self, piece: bytes) -> int:
        self.booked.append(piece)
        self.held += len(piece) + PIECE_BYTES
        return len(self.off) - 2 + len(self.booked)

    def _pass(self, piece: bytes) -> int:
        """A piece for this call only."""
        self.passing.append(piece)
        return _PASSING + len(self.passing) - 1

    def _tailed(self, table: _Pieces, piece: bytes, tail: int) -> int:
        """A piece with a tail: the number of the piece before it and the tail, kept as the piece is."""
        n = table[piece[:-1]] | tail << _TAIL_BIT
        if not n & _PASSING:
            table[piece] = n
            self.held += len(piece) + PIECE_BYTES
        return n

    def _unit(self, piece: bytes) -> int:
        tail = _TAILS.find(piece[-1:])
        if tail >= 0 and len(piece) > 1 and piece[-2] in _WORDLIKE:
            return self._tailed(self.units, piece, tail + 1)
        if len(piece) > LONGEST_KEPT:
            return self._pass(piece)
        n = self.units[piece] = self._book(piece)
        return n

    def _after_space(self, piece: bytes) -> int:
        """A piece between blanks; one that starts with a newline has no blank before it."""
        tail = _TAILS.find(piece[-1:])
        if tail >= 0 and len(piece) > 1 and piece[-2] in _WORDLIKE:
            return self._tailed(self.after_space, piece, tail + 1)
        spelled = piece if piece[0] == 10 else b" " + piece
        if len(piece) > LONGEST_KEPT:
            return self._pass(spelled)
        n = self.after_space[piece] = self._book(spelled)
        return n

    def _pieces(self, text: bytes) -> list[int]:
        if not text:
            return []
        if not self.spaced:
            return list(map(self.units.__getitem__, text.lower().split()))
        if not text.isascii() and (any(w in text for w in _OTHER_WHITE) or b"\xe2\x80" in text and _OTHER_BLANK.search(text)):
            return [self._pass(text)]
        if text[0] in b" \n" or text[-1] in b" \n" or any(w in text for w in _ODD):
            return list(map(self.units.__getitem__, _UNITS.findall(text)))
        first, *rest = text.replace(b"\n", b" \n").split(b" ")
        return [self.units[first], *map(self.after_space.__getitem__, rest)]

    def encode_many(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of some texts, ids end to end."""
        if self._full():
            self._renew()
        got = [self._pieces(t) for t in texts]
        self._encode(self.booked, self.flat, self.off)
        self.booked = []
        passing_flat, passing_off = array("I"), array("q", [0])
        self._encode(self.passing, passing_flat, passing_off)
        self.passing = []
        n = np.fromiter(chain.from_iterable(got), np.int64, sum(map(len, got)))
        doc = np.repeat(np.arange(len(got)), [len(g) for g in got])
        tail = n >> _TAIL_BIT
        if tail.any():
            both = 1 + (tail > 0)
            place = np.cumsum(both) - 1
            n, doc, last = np.repeat(n & ((1 << _TAIL_BIT) - 1), both), np.repeat(doc, both), tail > 0
            n[place[last]] = self.tails[tail[last]]
        flat, off = np.frombuffer(self.flat, np.uint32), np.frombuffer(self.off, np.int64)
        passing = (n & _PASSING) > 0
        met = np.bincount(n[~passing], minlength=len(off) - 1)
        met[: len(self.hits)] += self.hits
        self.hits = met
        first, size = self._spans(np.where(passing, 0, n), off)
        if passing.any():  # the kept ids stay where they are
            own_first, own_size = self._spans(n[passing] & (_PASSING - 1), np.frombuffer(passing_off, np.int64))
            first[passing], size[passing] = own_first, own_size
        stop = np.cumsum(size)
        at = np.repeat(first - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)
        if passing.any():
            other = np.repeat(passing, size)
            ids = np.empty(len(at), np.uint32)
            ids[~other], ids[other] = flat[at[~other]], np.frombuffer(passing_flat, np.uint32)[at[other]]
        else:
            ids = flat[at]
        ends = np.concatenate([[0], np.cumsum(np.bincount(doc, weights=size, minlength=len(got)))]).astype(np.int64)
        return ids, ends

    @staticmethod
    def _spans(n: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First id and number of ids of each piece."""
        return off[n], off[n + 1] - off[n]

    def _encode(self, pieces: list[bytes], flat: array, off: array) -> None:
        for i in range(0, len(pieces), ENCODE_PIECES):
            run = [p.decode("utf-8", "replace") for p in pieces[i : i + ENCODE_PIECES]]
            ids, size = self._marked(run) or self._listed(run)
            off.frombytes((len(flat) + np.cumsum(size)).astype(np.int64).tobytes())
            flat.frombytes(ids.tobytes())

    def _listed(self, run: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and their number in each piece, of pieces given as words split beforehand."""
        found = self.lib.encode(run, is_pretokenized=True, add_special_tokens=False)
        return np.array(found.ids, np.uint32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(run))

    def _marked(self, run: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same of pieces given as one text; None where it holds further marks or cannot be marked."""
        if self.mark is None:
            return None
        text = f" {MARK} ".join([*run, ""])
        ids = np.array(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        at = np.flatnonzero(ids == self.mark)
        return (np.delete(ids, at), np.diff(at, prepend=-1) - 1) if len(at) == len(run) else None

    def encode(self, text: bytes) -> np.ndarray:
        return self.encode_many([text])[0]


@lru_cache(maxsize=2)
def encoder(path: str, spaced: bool) -> Encoder:
    """One encoder for each file and worker process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path, spaced)


#: Tasks that encode name this as what they keep.
KEPT = "tokens"
keep_between_tasks(KEPT, encoder.cache_clear)


def encoded(path: str, spaced: bool, texts, chunk_bytes: int = 1 << 20):
    """Yield ``(first, ids, offsets)`` for runs of the texts (an Arrow binary array, null as empty)."""
    enc, run, held, first = encoder(path, spaced), [], 0, 0
    for x in texts:
        run.append(x.as_buffer().to_pybytes() if x.is_valid else b"")
        held += len(run[-1])
        if held >= chunk_bytes:
            yield first, *enc.encode_many(run)
            first, run, held = first + len(run), [], 0
    if run:
        yield first, *enc.encode_many(run)
