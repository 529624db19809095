"""Whole Arrow columns of text as numpy arrays: words, hashes, windows and a bounded memo of words.

A word is a maximal run of bytes other than space and 0x09-0x0D, which in UTF-8 is the same as
``[^\\x20\\x09-\\x0D]+`` over characters. All functions work on a block of documents at once; a block
holds a few megabytes of text, or one longer document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2_000_000
_CHUNK_BYTES = 1_000_000
_U = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finalizer)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class _Powers:
    """Powers of an odd number modulo 2**64, extended as needed."""

    def __init__(self, base: int):
        self.base, self.values = _U(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if n > len(self.values):
            more = np.full(max(n, 2 * len(self.values)), self.base, np.uint64)
            more[0] = 1
            self.values = np.multiply.accumulate(more)
        return self.values[:n]


_BYTE_POWERS = _Powers(0x9E3779B97F4A7C15)
_WORD_BASE = 0xD6E8FEB86659FD93
_WORD_POWERS = _Powers(_WORD_BASE)
_WORD_INVERSE = _Powers(pow(_WORD_BASE, -1, 1 << 64))


def _byte_codes(lower: bool, space: np.ndarray = SPACE) -> np.ndarray:
    codes = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
    if lower:
        codes[65:91] = codes[97:123]
    codes[space] = 0
    return codes


_CODES = {lower: _byte_codes(lower) for lower in (False, True)}


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the offset of each text (one more than texts). Null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    found = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return found[at[0] : at[-1]], at - at[0]


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text, or one longer document."""
    if not batch.num_rows:
        return
    _, at = flat(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


@dataclass
class Words:
    """The words of a block: byte range, 64-bit hash and document of each; word range of each document."""

    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # first word of each document, and the number of words at the end

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n)), self.n)


def words(column: pa.Array, lower: bool = False, space: np.ndarray = SPACE, hashes: bool = True, letters: np.ndarray | None = None, others: np.ndarray | None = None) -> Words:
    """Words of all texts. ``lower`` makes A-Z and a-z hash alike.

    With ``letters`` and ``others`` (sets of bytes), a word is also cut between a byte of one and a byte of the other.
    """
    data, at = flat(column)
    solid = np.zeros(len(data) + 1, bool)
    solid[:-1] = ~space[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    starts_doc = at[:-1][at[:-1] < len(data)]
    begins[starts_doc] = solid[starts_doc]
    if letters is not None and len(data) > 1:
        a, b = letters[data], others[data]
        begins[1:-1] |= a[:-1] & b[1:] | b[:-1] & a[1:]
    ends = solid[:-1].copy()
    if len(ends):
        ends[:-1] &= ~solid[1:-1] | begins[1:-1]
    start = np.flatnonzero(begins[:-1])
    end = np.flatnonzero(ends) + 1
    codes = _CODES[lower] if space is SPACE else _byte_codes(lower, space)
    found = _hash_ranges(data, start, end, codes) if hashes else np.zeros(0, np.uint64)
    return Words(data, at, start, end, found, np.searchsorted(start, at))


def _hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hash of each byte range; ``codes`` is 0 for every byte between ranges."""
    out = np.empty(len(start), np.uint64)
    k = 0
    while k < len(start):
        last = max(int(np.searchsorted(start, start[k] + _CHUNK_BYTES)), k + 1)
        lo, hi = start[k], end[last - 1]
        own = start[k:last] - lo
        size = np.diff(np.append(own, hi - lo))
        place = np.arange(hi - lo, dtype=np.int64)
        place -= np.repeat(own, size)
        code = codes[data[lo:hi]]
        code *= _BYTE_POWERS.upto(int(size.max()))[place]
        out[k:last] = np.add.reduceat(code, own)
        k = last
    return mix(out ^ (end - start).astype(np.uint64) * _U(0xA24BAED4963EE407))


def windows(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of ``size`` consecutive words and the word it starts at, for every window within a document."""
    n = len(found.hash)
    if n < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if size <= 8:
        total = found.hash[: n - size + 1].copy()
        for j in range(1, size):
            total = total * _WORD_POWERS.base + found.hash[j : n - size + 1 + j]
    else:
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(found.hash * _WORD_POWERS.upto(n), out=sums[1:])
        total = (sums[size:] - sums[:-size]) * _WORD_INVERSE.upto(n - size + 1)
    within = np.ones(n - size + 1, bool)
    cuts = found.first[1:-1]
    for j in range(1, size):  # windows that would run over the end of a document
        bad = cuts - j
        within[bad[(bad >= 0) & (bad < len(within))]] = False
    at = np.flatnonzero(within)
    # A cut with no words between it and the next leaves no mark twice, so a document shorter than the window has none.
    return mix(total[at]), at


def hash_ranges(found: Words, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words of each range."""
    sums = np.zeros(len(found.hash) + 1, np.uint64)
    np.cumsum(found.hash * _WORD_POWERS.upto(len(found.hash)), out=sums[1:])
    return mix((sums[end] - sums[begin]) * _WORD_INVERSE.upto(len(found.hash) + 1)[begin])


def covered(n: int, start: np.ndarray, size: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``size`` words from one of ``start``."""
    edge = np.zeros(n + size + 1, np.int64)
    np.add.at(edge, start, 1)
    np.subtract.at(edge, start + size, 1)
    return np.cumsum(edge)[:n] > 0


def per_doc(found: Words, value: np.ndarray) -> np.ndarray:
    """Sum of a value of words over each document."""
    sums = np.zeros(len(value) + 1, np.int64)
    np.cumsum(value, out=sums[1:])
    return sums[found.first[1:]] - sums[found.first[:-1]]


class Memo:
    """Values of words by hash, as ranges of a pool; about ``limit`` words are kept.

    ``values`` gives the values of new words one after another, and how many each word has.
    """

    def __init__(self, values: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], dtype, limit: int = 1_500_000, bits: int = 21):
        self.values, self.limit, self.bits, self.dtype = values, limit, bits, dtype
        self._reset()

    def _reset(self) -> None:
        self.hash = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, self.dtype)
        self._index()

    def _index(self) -> None:
        top = (self.hash >> _U(64 - self.bits)).astype(np.int64)
        self.bucket = np.zeros((1 << self.bits) + 1, np.int32)
        np.cumsum(np.bincount(top, minlength=1 << self.bits), out=self.bucket[1:])

    def _find(self, wanted: np.ndarray) -> np.ndarray:
        """Index of each hash, or -1."""
        top = (wanted >> _U(64 - self.bits)).astype(np.int64)
        at, stop = self.bucket[top], self.bucket[top + 1]
        out = np.full(len(wanted), -1, np.int64)
        open_ = np.flatnonzero(at < stop)
        at, stop = at[open_], stop[open_]
        while len(open_):
            hit = self.hash[at] == wanted[open_]
            out[open_[hit]] = at[hit]
            at = at + 1
            go = ~hit & (at < stop)
            open_, at, stop = open_[go], at[go], stop[go]
        return out

    def lookup(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """For each word: where its values begin in the pool, and how many there are."""
        index = self._find(found.hash)
        missing = np.flatnonzero(index < 0)
        if len(missing):
            fresh, one = np.unique(found.hash[missing], return_index=True)
            if len(self.hash) and (len(self.hash) + len(fresh) > self.limit or len(self.pool) > 32 * self.limit):
                self._reset()
                missing = np.arange(len(found.hash))
                fresh, one = np.unique(found.hash, return_index=True)
            raw, of = found.data.tobytes(), missing[one]
            new, size = self.values([raw[a:b] for a, b in zip(found.start[of].tolist(), found.end[of].tolist())])
            at = len(self.pool) + np.cumsum(size) - size
            self.pool = np.concatenate([self.pool, new.astype(self.dtype, copy=False)])
            order = np.searchsorted(self.hash, fresh)
            self.hash = np.insert(self.hash, order, fresh)
            self.at = np.insert(self.at, order, at)
            self.size = np.insert(self.size, order, size)
            self._index()
            index = self._find(found.hash)
        return self.at[index], self.size[index]

    def expand(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The values of a sequence of words, one after another."""
        total = np.cumsum(size)
        n = int(total[-1]) if len(total) else 0
        return self.pool[np.repeat(at - (total - size), size) + np.arange(n)]
