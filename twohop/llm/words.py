"""Words and their 64-bit keys, straight from Arrow text buffers.

A word is a maximal run of bytes of one class. Words, windows and shingles are held as NumPy arrays over
a *piece*: some consecutive rows of a batch, a few MB of text (one row alone if it is longer).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
STEP_WORDS = 1 << 16
_M = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C13  # odd, 3 modulo 8
_RADIX = 0xD6E8FEB86659FD93


def _splitmix(x: int) -> int:
    x = (x + 0x9E3779B97F4A7C15) & _M
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _M
    return x ^ (x >> 31)


_CODES = np.array([_splitmix(i + 1) for i in range(256)], dtype=np.uint64)
_FOLD = np.arange(256)
_FOLD[65:91] += 32

#: The byte classes of the word patterns.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def _class_of(keep: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(keep)] = True
    return table


#: Everything but blanks.
NOT_SPACE = _class_of(set(range(256)) - set(SPACE_BYTES))
#: Digits, letters and all bytes of characters beyond ASCII.
ALNUM = _class_of([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_grown: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _grown.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1024) * 5 // 4, base, np.uint64)
        steps[0] = 1
        have = _grown[base] = np.multiply.accumulate(steps)
    return have[:n]


@cache
def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 bounds of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n, first = len(column), column.offset
    bounds = np.frombuffer(column.buffers()[1], np.int64, n + 1, first * 8) if n else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``size`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at, before = 0, 0
        while at < batch.num_rows:
            to = max(int(np.searchsorted(ends, before + size, "right")), at + 1)
            yield batch.slice(at, to - at)
            at, before = to, int(ends[to - 1])


class Words:
    """The words of some texts in order: ``keys``, the row of each, where each row's words begin."""

    def __init__(self, column: pa.Array, kept: np.ndarray, fold: bool):
        data, bounds = text_buffer(column)
        self.data, self.bounds, self.n_rows = data, bounds, len(bounds) - 1
        if len(data):
            inside = kept[data]
            before = np.empty_like(inside)
            before[0] = False
            before[1:] = inside[:-1]
            firsts = bounds[:-1]
            before[firsts[firsts < len(data)]] = False
            after = np.empty_like(inside)
            after[-1] = False
            after[:-1] = inside[1:]
            lasts = bounds[1:] - 1
            after[lasts[lasts >= 0]] = False
            self.starts = np.flatnonzero(inside & ~before)
            self.ends = np.flatnonzero(inside & ~after) + 1
        else:
            self.starts = self.ends = np.zeros(0, np.int64)
        self.first = np.searchsorted(self.starts, bounds)  # of each row, and the total
        self.counts = np.diff(self.first)
        self.rows = np.repeat(np.arange(self.n_rows), self.counts)
        self.keys = self._keys(kept, fold)

    def _keys(self, kept: np.ndarray, fold: bool) -> np.ndarray:
        codes = np.where(kept, _CODES[_FOLD] if fold else _CODES, np.uint64(0))
        keys = np.empty(len(self.starts), np.uint64)
        for lo in range(0, len(keys), STEP_WORDS):  # so that no array over bytes is large
            starts, ends = self.starts[lo : lo + STEP_WORDS], self.ends[lo : lo + STEP_WORDS]
            lengths, longest = ends - starts, int((ends - starts).max())
            spread = codes[self.data[starts[0] : ends[-1]]]
            starts = (starts - starts[0]).astype(np.int32 if len(spread) < 1 << 31 else np.int64)
            place = np.arange(len(spread), dtype=starts.dtype)
            place -= np.repeat(starts, np.diff(np.append(starts, len(spread)).astype(starts.dtype)))
            # Blanks have the code 0, so their place does not matter; a word of n bytes needs n powers.
            np.minimum(place, longest - 1, out=place)
            spread *= _powers(_BASE, longest)[place]
            keys[lo : lo + STEP_WORDS] = mix(np.add.reduceat(spread, starts) + lengths.astype(np.uint64))
        return keys

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and Rabin-Karp key of every run of ``n`` words within a row."""
        total = len(self.keys)
        if total < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        sums = np.zeros(total + 1, np.uint64)
        np.cumsum(self.keys * _powers(_RADIX, total), out=sums[1:])
        keys = (sums[n:] - sums[:-n]) * _powers(_inverse(_RADIX), total - n + 1)
        at = np.flatnonzero(self.rows[: total - n + 1] == self.rows[n - 1 :])
        return at, mix(keys[at])

    def whole(self) -> np.ndarray:
        """A key of each row's whole sequence of words."""
        total = len(self.keys)
        sums = np.zeros(total + 1, np.uint64)
        np.cumsum(self.keys * _powers(_RADIX, max(total, 1))[:total], out=sums[1:])
        back = _powers(_inverse(_RADIX), total + 1)[self.first[:-1]]
        return mix((sums[self.first[1:]] - sums[self.first[:-1]]) * back + self.counts.astype(np.uint64))


def key_of(words: list[bytes], fold: bool) -> np.ndarray:
    """The keys of words given one by one."""
    if not words:
        return np.zeros(0, np.uint64)
    return Words(pa.array([w.decode("utf-8", "surrogateescape") for w in words]), np.ones(256, bool), fold).keys
