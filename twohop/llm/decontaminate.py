"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` writes the postings of every token of the corpus: one row per segment (some consecutive
documents of a partition, a few MB of text) with its documents, its distinct terms and, term by term, the
positions. A phrase lies within a document, so each segment can be searched alone; a search shuffles
nothing. For every phrase the segment takes the list of the rarest term, moved by the term's place in the
phrase, and intersects it with the moved lists of the other terms, rarest first. A phrase with a term that
the segment lacks ends there.

Test sets are searched in blocks of at most ``BLOCK_TERMS`` phrase terms: a block is what a task holds
besides its segment. Terms are 64-bit keys of words; a phrase matches if all its keys do.

Defined results: null or blank texts have no words; each row of ``docs`` is a row of the index, rows with
equal or null ids too; null or blank items never match; items with the same text all match.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twohop.llm.blocks import pack, unpack
from twohop.llm.tables import parts, texts_of
from twohop.llm.words import ALNUM, Words, pieces
from twohop.store import write_out

BLOCK_TERMS = 1_000_000

_INDEX = "segment string, docs binary, ids binary, lengths binary, terms binary, counts binary, positions binary"
_HITS = "segment string, row int, doc_id bigint, n_words bigint, item_id bigint, item_start int, start bigint, length bigint"
_HIT_KIND = pa.schema(
    [
        ("segment", pa.string()),
        ("row", pa.int32()),
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("item_id", pa.int64()),
        ("item_start", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
    ]
)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        words = Words(piece.column("text"), ALNUM, fold=True)
        order = np.argsort(words.keys, kind="stable")
        terms, counts = np.unique(words.keys[order], return_counts=True)
        ids = piece.column("doc_id")
        row = {
            "segment": uuid.uuid4().hex,
            "docs": pack(np.asarray(ids.is_valid()).astype(np.uint8)),
            "ids": pack(ids.fill_null(0).to_numpy()),
            "lengths": pack(words.counts.astype(np.int64)),
            "terms": pack(np.diff(terms, prepend=np.uint64(0))),
            "counts": pack(counts.astype(np.int64)),
            "positions": pack(order.astype(np.int32 if len(order) < 1 << 31 else np.int64)),
        }
        kinds = [pa.string(), *[pa.binary()] * 6]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))


def build_index(docs: DataFrame) -> DataFrame:
    """Write the positional index of ``docs(doc_id, text)`` to the shared folder and return it."""
    return write_out(texts_of(docs).mapInArrow(_segments, _INDEX), "postings")


class Segment:
    """The postings of a segment; ``places`` holds term and position of every posting as one number."""

    def __init__(self, row: dict):
        self.valid = unpack(row["docs"], np.uint8).astype(bool)
        self.ids = unpack(row["ids"], np.int64)
        self.lengths = unpack(row["lengths"], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.lengths)])
        self.terms = np.cumsum(unpack(row["terms"], np.uint64))
        self.counts = unpack(row["counts"], np.int64)
        self.heads = np.cumsum(self.counts) - self.counts
        wide = len(row["positions"]) == 8 * int(self.counts.sum()) and len(self.counts) > 0
        self.positions = unpack(row["positions"], np.int64 if wide else np.int32).astype(np.int64)
        self.places = (np.repeat(np.arange(len(self.terms)), self.counts) << 32) | self.positions

    def term(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the terms, -1 for those that the segment lacks."""
        if not len(self.terms):
            return np.full(keys.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, keys), len(self.terms) - 1)
        return np.where(self.terms[at] == keys, at, -1)

    def listed(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All postings of the terms: which of them, and the position."""
        n = self.counts[terms]
        which = np.repeat(np.arange(len(terms)), n)
        within = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return which, self.positions[self.heads[terms][which] + within]

    def has(self, terms: np.ndarray, positions: np.ndarray) -> np.ndarray:
        probe = (terms << 32) | positions
        at = np.minimum(np.searchsorted(self.places, probe), len(self.places) - 1)
        return (positions >= 0) & (self.places[at] == probe)

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, positions, "right") - 1

    def phrases(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the phrases (rows of term keys, all of one length) starts at which position."""
        n = grams.shape[1]
        terms = self.term(grams)
        there = np.flatnonzero((terms >= 0).all(axis=1))
        if not len(there):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        terms = terms[there]
        rarest = np.argsort(self.counts[terms], axis=1, kind="stable")
        line = np.arange(len(terms))
        which, at = self.listed(terms[line, rarest[:, 0]])
        at = at - rarest[which, 0]
        fits = (at >= 0) & (at + n <= self.first[-1])
        which, at = which[fits], at[fits]
        for k in range(1, n):
            place = rarest[which, k]
            fits = self.has(terms[which, place], at + place)
            which, at = which[fits], at[fits]
        fits = self.row_of(at) == self.row_of(at + n - 1)
        return there[which[fits]], at[fits]

    def near(self, grams: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the phrases has all its terms, in any order, within ``reach`` words of its rarest one at which position."""
        terms = self.term(grams)
        there = np.flatnonzero((terms >= 0).all(axis=1))
        if not len(there):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        terms = terms[there]
        rarest = np.argsort(self.counts[terms], axis=1, kind="stable")
        which, at = self.listed(terms[np.arange(len(terms)), rarest[:, 0]])
        for k in range(1, grams.shape[1]):
            term = terms[which, rarest[which, k]]
            row = self.row_of(at)
            low, high = np.maximum(at - reach, self.first[row]), np.minimum(at + reach, self.first[row + 1] - 1)
            next_one = np.searchsorted(self.places, (term << 32) | low)
            found = self.places[np.minimum(next_one, len(self.places) - 1)]
            fits = (next_one < len(self.places)) & (found >> 32 == term) & (found & 0xFFFFFFFF <= high)
            which, at = which[fits], at[fits]
        return there[which], at


class _Grams:
    """The distinct phrases of a block by length, and the places in the items that have them."""

    def __init__(self, items: list[tuple[int, str]], size: int):
        words = Words(pa.array([x[1] for x in items], pa.string()), ALNUM, fold=True)
        ids = np.array([x[0] for x in items], np.int64)
        wanted: dict[int, list[np.ndarray]] = {}
        places: dict[int, list[tuple[int, int]]] = {}
        for row in range(len(items)):
            own = words.keys[words.first[row] : words.first[row + 1]]
            n = min(size, len(own))
            for start in range(len(own) - n + 1 if n else 0):
                wanted.setdefault(n, []).append(own[start : start + n])
                places.setdefault(n, []).append((int(ids[row]), start))
        self.by_length = {}
        for n, grams in wanted.items():
            distinct, back = np.unique(np.stack(grams), axis=0, return_inverse=True)
            order = np.argsort(back.ravel(), kind="stable")
            heads = np.searchsorted(back.ravel()[order], np.arange(len(distinct) + 1))
            self.by_length[n] = (distinct, np.array(places[n], np.int64)[order], heads)


def _hits(segment: Segment, name: str, grams: _Grams, reach: int | None) -> Iterator[pa.RecordBatch]:
    for n, (distinct, places, heads) in grams.by_length.items():
        which, at = segment.phrases(distinct) if reach is None else segment.near(distinct, reach)
        if not len(which):
            continue
        copies = np.diff(heads)[which]
        hit = np.repeat(np.arange(len(which)), copies)
        nth = np.arange(len(hit)) - np.repeat(np.cumsum(copies) - copies, copies)
        item, place = places[heads[which[hit]] + nth].T
        at = at[hit]
        row = segment.row_of(at)
        # Windows that follow one another in the item and in the document are one match.
        order = np.lexsort((at, at - place, item, row))
        row, item, place, at = row[order], item[order], place[order], at[order]
        joins = np.zeros(len(at), bool)
        joins[1:] = (row[1:] == row[:-1]) & (item[1:] == item[:-1]) & (at[1:] - at[:-1] == 1) & (place[1:] - place[:-1] == 1)
        head = np.flatnonzero(~joins)
        length = np.diff(np.append(head, len(at))) - 1 + n
        row, item, place, at = row[head], item[head], place[head], at[head]
        yield _rows(segment, name, row, item, place, at - segment.first[row], length)


def _rows(segment: Segment, name: str, row: np.ndarray, item=None, place=None, at=None, length=None) -> pa.RecordBatch:
    nothing = lambda kind: pa.nulls(len(row), kind)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * len(row), pa.string()),
            pa.array(row.astype(np.int32)),
            pa.array(segment.ids[row], mask=~segment.valid[row]),
            pa.array(segment.lengths[row]),
            nothing(pa.int64()) if item is None else pa.array(item),
            nothing(pa.int32()) if place is None else pa.array(place.astype(np.int32)),
            nothing(pa.int64()) if at is None else pa.array(at.astype(np.int64)),
            nothing(pa.int64()) if length is None else pa.array(length.astype(np.int64)),
        ],
        schema=_HIT_KIND,
    )


def _search(block: list[tuple[int, str]], size: int, reach: int | None, list_rows: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _Grams(block, size)
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row)
                if list_rows:
                    yield _rows(segment, row["segment"], np.arange(len(segment.ids)))
                yield from _hits(segment, row["segment"], grams, reach)

    return run


def matches(index: DataFrame, items: DataFrame, size: int = 10, reach: int | None = None) -> DataFrame:
    """Where the items' runs of ``size`` words occur in the indexed documents.

    A row without item per document, then a row per match: ``item_id, item_start, start, length`` in words.
    With ``reach`` the words of a run need only lie, in any order, within that distance of its rarest one;
    ``start`` is then the place of the rarest one.
    """
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("item_id is not null and text is not null")
    terms = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # no more words than bytes, of up to ``size`` terms each
    blocks = parts(terms * size // 2, BLOCK_TERMS)
    found = None
    for b in range(blocks):
        block = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()]
        hits = index.mapInArrow(_search(block, size, reach, b == 0), _HITS)
        found = hits if found is None else found.unionByName(hits)
    return found


def _covered(spans: Column) -> Column:
    """Positions covered by spans (start, length) that are sorted by start."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))

    def step(seen: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        more = F.greatest(end - F.greatest(seen["to"], span["start"]), F.lit(0).cast("bigint"))
        return F.struct((seen["n"] + more).alias("n"), F.greatest(seen["to"], end).alias("to"))

    return F.aggregate(spans, start, step, lambda seen: seen["n"])


def contamination(found: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, item_ids`` of every document from what ``matches`` found."""
    spans = F.array_sort(F.collect_list(F.when(F.col("item_id").isNotNull(), F.struct("start", "length"))))
    return (
        found.groupBy("segment", "row", "doc_id", "n_words")
        .agg(spans.alias("spans"), F.collect_set(F.col("item_id").cast("string")).alias("items"))
        .select("doc_id", "n_words", _covered(F.col("spans")).alias("n_hit"), F.array_sort("items").alias("item_ids"))
    )


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    return contamination(matches(build_index(docs), items, size))
