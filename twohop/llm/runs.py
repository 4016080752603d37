"""Periodic run detection: stretches of words that repeat with a period, and the texts without the repeats.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of at least ``max(least, 2 q)`` words that no
neighbouring word extends. Method, seed and extend on diagonals: on the diagonal of lag q, where word i meets word i + q, a run
of period q is a stretch of at least ``m = max(least - q, q)`` equal places.

* Lags are taken in classes. In the first, up to ``least - 1``, every run overlaps itself by at least ``least / 2`` words; in each
  next one, ``[m, 2 m)``, by m words. So the class indexes k-grams of half that overlap, k = m / 2, by Rabin-Karp keys of all places, and takes as
  seeds the k-grams at every k-th place: any m equal places hold a whole one of them.
* Occurrence pairs of a seed, in the same text and with a lag of the class, name a place on a diagonal. A seed has at most as many
  partners as its class has lags, 2 k, so all classes together make ``O(n log n)`` pairs of n words, also where one word is repeated throughout.
* Seeds on one diagonal that follow each other without a gap lie in one stretch. The table of the furthest place covered per lag skips all but
  the first of them; that one is extended both ways, by doubling steps over the keys, to its maximal stretch.
* Stretches that begin and end together are one run; its period is the smallest of their lags.

Each text is read by itself, in pieces of a few MB or one text; nothing is shuffled. The pairs of a class are
made in bounded steps. Words and k-grams stand by keys of 64 bits.

Defined results: null or blank text has no words and no run; rows are not compared with each other, so ties, repeated rows and rows without
``doc_id`` are each judged by themselves; of several longest runs the one that starts first, then that of the smaller period, is named.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from twohop.llm.tables import texts_of
from twohop.llm.words import NOT_SPACE, Words, mix, pieces

#: Occurrence pairs that a step makes at a time.
STEP_PAIRS = 1 << 18

_RADIX = np.uint64(0xD6E8FEB86659FD93)
_RESULT = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, kept string"


class Repeats:
    """The words of some rows, and keys of stretches of them: equal keys stand for equal words."""

    def __init__(self, keys: np.ndarray, first: np.ndarray, rows: np.ndarray):
        self.n, self.rows = len(keys), rows
        self.begin, self.last = first[:-1][rows], first[1:][rows]  # of each word's row
        self.levels = [keys]

    def level(self, j: int) -> np.ndarray:
        """A key of the 2^j words from every place; a stretch must end in its row."""
        while len(self.levels) <= j:
            under = self.levels[-1]
            self.levels.append(self._joined(under, 1 << (len(self.levels) - 1)))
        return self.levels[j]

    def grams(self, k: int) -> np.ndarray:
        """A key of the k words from every place: two stretches of 2^j words that may overlap."""
        j = k.bit_length() - 1
        return self._joined(self.level(j), k - (1 << j)) if k > 1 << j else self.level(j)

    def _joined(self, keys: np.ndarray, shift: int) -> np.ndarray:
        after = np.zeros_like(keys)
        after[: max(self.n - shift, 0)] = keys[shift:]
        return mix(keys * _RADIX + after)


def _seeds(words: Repeats, k: int, lags: tuple[int, int], long_enough: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place, lag) of the k-grams at every k-th place of a row and their later occurrences within ``lags``, in steps."""
    own = np.flatnonzero(long_enough)  # words of rows that can hold such a run
    own = own[own + k <= words.last[own]]
    if not len(own):
        return
    grams = mix(words.grams(k)[own] + words.rows[own].astype(np.uint64))  # equal only within a row
    is_seed = (own - words.begin[own]) % k == 0
    kinds = np.sort(grams[is_seed])
    kinds = kinds[np.concatenate([[True], kinds[1:] != kinds[:-1]])]
    kind = np.searchsorted(kinds, grams)
    kind[kind == len(kinds)] = 0
    met = kinds[kind] == grams
    own, kind, is_seed = own[met], kind[met], is_seed[met]
    many = np.bincount(kind, minlength=len(kinds))[kind] > 1
    own, kind, is_seed = own[many], kind[many], is_seed[many]
    if not len(own):
        return
    order = np.argsort(kind, kind="stable")  # by gram, then place
    at, of = own[order], kind[order]
    ranked = of * words.n + at
    for_seed = np.flatnonzero(is_seed[order])
    for_seed = for_seed[np.argsort(at[for_seed])]  # by place, which the table of covered places needs
    lo = np.searchsorted(ranked, ranked[for_seed] + lags[0])
    hi = np.searchsorted(ranked, np.minimum(ranked[for_seed] + lags[1], (of[for_seed] + 1) * words.n))
    some = hi > lo
    for_seed, lo, counts = for_seed[some], lo[some], (hi - lo)[some]
    ends = np.cumsum(counts)
    done = 0
    while done < len(for_seed):
        base = ends[done - 1] if done else 0
        to = max(int(np.searchsorted(ends, base + STEP_PAIRS, "right")), done + 1)
        n = counts[done:to]
        places = np.repeat(at[for_seed[done:to]], n)
        partner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[done:to], n)
        yield places, at[partner] - places
        done = to


def _first_of_stretches(places: np.ndarray, lags: np.ndarray, k: int, rows: np.ndarray, covered: dict) -> tuple[np.ndarray, np.ndarray]:
    """Without the seeds that follow another one on the same diagonal of the same row with no gap between them: those lie in its
    stretch. ``covered`` carries the furthest place of each diagonal from step to step."""
    order = np.lexsort((places, lags, rows[places]))
    places, lags, row = places[order], lags[order], rows[places[order]]
    fresh = np.ones(len(places), bool)
    same = (lags[1:] == lags[:-1]) & (row[1:] == row[:-1])
    fresh[1:] = ~(same & (places[1:] <= places[:-1] + k))
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    tails = np.append(heads[1:], len(places)) - 1
    for head, tail in zip(heads.tolist(), tails.tolist(), strict=True):
        diagonal = (int(row[head]), int(lags[head]))
        if fresh[head] and places[head] <= covered.get(diagonal, -1):
            fresh[head] = False
        covered[diagonal] = int(places[tail]) + k
    return places[fresh], lags[fresh]


class _Extend:
    """How far two places go on being equal, by doubling steps over the keys of 2^j words."""

    def __init__(self, words: Repeats):
        self.words = words

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of equal words from ``a`` and from ``b`` on, ``a < b`` in one row."""
        room, done = self.words.last[b] - b, np.zeros(len(a), np.int64)
        return self._walk(a, b, room, done, 1)

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of equal words before ``a`` and before ``b``."""
        room, done = a - self.words.begin[a], np.zeros(len(a), np.int64)
        return self._walk(a, b, room, done, -1)

    def _walk(self, a: np.ndarray, b: np.ndarray, room: np.ndarray, done: np.ndarray, way: int) -> np.ndarray:
        going, j = np.arange(len(a)), 0
        tops = np.zeros(len(a), np.int64)
        while len(going):  # longer and longer steps while they are equal
            going = going[self._equal(a, b, room, done, going, j, way)]
            done[going] += 1 << j
            tops[going] = j + 1
            j += 1
        for j in range(int(tops.max(initial=0)), -1, -1):  # then the rest by shorter and shorter ones
            left = np.flatnonzero(tops >= j)
            left = left[self._equal(a, b, room, done, left, j, way)]
            done[left] += 1 << j
        return done

    def _equal(self, a, b, room, done, which, j: int, way: int) -> np.ndarray:
        fits = done[which] + (1 << j) <= room[which]
        out = np.zeros(len(which), bool)
        own = which[fits]
        if len(own):
            keys, shift = self.words.level(j), done[own] if way > 0 else -done[own] - (1 << j)
            out[fits] = keys[a[own] + shift] == keys[b[own] + shift]
        return out


def find_runs(words: Words, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of some rows as (first word among all words, length, period), by first word, then period."""
    repeats = Repeats(words.keys, words.first, words.rows)
    extend = _Extend(repeats)
    size = repeats.last - repeats.begin  # words of the row, for each word
    longest = int(words.counts.max(initial=0))
    found, lags, overlap = [], (1, least), max(least // 2, 2)
    while max(2 * lags[0], least) <= longest:
        k, covered = max(overlap // 2, 1), {}
        for places, lag in _seeds(repeats, k, lags, size >= max(2 * lags[0], least)):
            places, lag = _first_of_stretches(places, lag, k, repeats.rows, covered)
            before = extend.backward(places, places + lag)
            start = places - before
            length = before + extend.forward(places, places + lag) + lag
            good = (length >= 2 * lag) & (length >= least)
            if good.any():
                found.append(np.stack([start[good], length[good], lag[good]]))
        lags, overlap = (lags[1], 2 * lags[1]), lags[1]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, lag = np.concatenate(found, axis=1)
    order = np.lexsort((lag, length, start))
    start, length, lag = start[order], length[order], lag[order]
    new = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])])  # the smallest lag of each stretch
    start, length, lag = start[new], length[new], lag[new]
    order = np.lexsort((lag, start))
    return start[order], length[order], lag[order]


def _detect(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for piece in pieces(batches):
        words = Words(piece.column("text"), NOT_SPACE, fold=False)
        start, length, period = find_runs(words, least)
        total = len(words.keys)
        change = np.bincount(start + period, minlength=total + 1) - np.bincount(start + length, minlength=total + 1)
        gone = np.cumsum(change)[:total] > 0
        cuts = np.searchsorted(start, words.first)
        data = words.data.tobytes()
        runs, kept = [], []
        for row in range(words.n_rows):
            own = data[words.bounds[row] : words.bounds[row + 1]].split()
            lo, hi = cuts[row], cuts[row + 1]
            if hi > lo:
                a = int(words.first[row])
                own = compress(own, (~gone[a : words.first[row + 1]]).tolist())
                each = zip((start[lo:hi] - a).tolist(), length[lo:hi].tolist(), period[lo:hi].tolist(), strict=True)
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in each])
            else:
                runs.append([])
            kept.append(b" ".join(own))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": piece.column("doc_id"),
                "n_words": pa.array(words.counts.astype(np.int64)),
                "runs": pa.array(runs, kind),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )


def collapse_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """``doc_id, n_words, runs, kept`` of every document: its runs of at least ``least`` words by start, then period, and its words
    without those that a run has after its first period, joined by blanks."""
    if least < 2:
        raise ValueError(f"a run has at least 2 words, got {least}")
    return texts_of(docs).mapInArrow(partial(_detect, least), _RESULT)
