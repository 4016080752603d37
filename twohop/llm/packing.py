"""Best-fit packing by exact complements.

Texts become token ids with an end id and are cut into pieces of at most ``size`` ids. What matters of a piece is its
length, so the packing is planned on the histogram of lengths, at most ``size`` numbers, and carried out by
Spark: from the longest length down, the gap that is left is looked up among the sums of one, two and three available
lengths; a combination that fills it exactly is taken as often as the counts allow. A gap without such a
combination gets the longest length that fits (best fit), and what is then left of it is looked up again.

A step of the plan uses up at least one length, so the plan has a few thousand rows whatever the number of
documents; it goes to all tasks. The n-th piece of a length takes the n-th place planned for the
length: pieces are numbered within (length, salt) and shifted by the counts of the smaller salts, so a length
that a third of all pieces has is spread over many tasks.

Defined results: null or empty text is one piece with the end id alone; rows without or with the same ``doc_id``
are packed as documents of their own.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twohop.llm.tables import parts, texts_of
from twohop.llm.tokens import encode, with_end
from twohop.llm.words import pieces as slices
from twohop.store import write_out

SALT_ROWS = 1_000_000

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _cut(path: str, end_id: int, size: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=1 << 20):
            ids, counts = with_end(*encode(path, batch.column("text").to_pylist()), end_id)
            ids = np.ascontiguousarray(ids, dtype="<u4")
            number = -(-counts // size)
            row = np.repeat(np.arange(len(counts)), number)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            first = counts - size * (number - 1)
            start = np.where(piece == 0, 0, first[row] + size * (piece - 1))
            length = np.where(piece == 0, first[row], size)
            at = (np.cumsum(counts) - counts)[row] + start
            cells = [ids[a : a + n] for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            found = {
                "doc_id": batch.column("doc_id").take(pa.array(row)),
                "piece": pa.array(piece.astype(np.int32)),
                "start": pa.array(start.astype(np.int64)),
                "length": pa.array(length.astype(np.int64)),
                "ids_crc32": pa.array([zlib.crc32(x) for x in cells], pa.int64()),
            }
            if with_ids:
                found["ids"] = pa.array([x.tobytes() for x in cells], pa.binary())
            yield pa.RecordBatch.from_pydict(found)

    return run


def token_pieces(docs: DataFrame, path: str, end_id: int, size: int = 1024, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``, little-endian 32-bit) of all documents' pieces."""
    schema = _PIECES + (", ids binary" if with_ids else "")
    return texts_of(docs).mapInArrow(_cut(path, end_id, size, with_ids), schema)


def _complements(left: np.ndarray, gap: int, most: int) -> Iterator[tuple[int, ...]]:
    """Available lengths that sum up to ``gap``: one, then two, then three of them, larger ones first."""
    if gap <= most and left[gap]:
        yield (gap,)
    for a in _halves(left, gap, most):
        if left[a] and left[gap - a]:
            yield (a, gap - a)
    for a in np.flatnonzero(left[: min(gap, most + 1)])[::-1].tolist():
        if 3 * a < gap:
            break
        for b in _halves(left, gap - a, a):
            if left[a] and left[b] and left[gap - a - b]:
                yield (a, b, gap - a - b)


def _halves(left: np.ndarray, total: int, most: int) -> list[int]:
    """The larger of every two available lengths that sum up to ``total``, none above ``most``."""
    larger = np.arange(min(total - 1, most), (total - 1) // 2, -1)
    return larger[(left[larger] > 0) & (left[total - larger] > 0)].tolist()


def plan(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of lengths, and how many sequences each fills."""
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    made: list[tuple[tuple[int, ...], int]] = []
    for long in range(size, 0, -1):
        while left[long]:
            lengths = _fill(left, long, size - long)
            times = min(left[x] // n for x, n in Counter(lengths).items())
            made.append((tuple(lengths), int(times)))
            for x in lengths:
                left[x] -= times
    return made


def _fill(left: np.ndarray, long: int, gap: int) -> list[int]:
    """A sequence that begins with ``long``: exact complements of the gap if there are any, else the longest length that
    fits and complements of what is then left. ``left`` is as before afterwards."""
    lengths = [long]
    left[long] -= 1
    most = long
    while gap:
        most = min(most, gap)
        while most and not left[most]:
            most -= 1
        if not most:
            break
        rest: tuple[int, ...] | None = None
        if gap <= 3 * most:
            found = (x for x in _complements(left, gap, most) if all(left[y] >= x.count(y) for y in x))
            rest = next(found, None)
        if rest is None:
            rest = (most,) * max(min(gap // most, int(left[most])) - 3, 1)
        lengths += rest
        for x in rest:
            left[x] -= 1
        gap -= sum(rest)
    for x in lengths:
        left[x] += 1
    return lengths


def _places(made: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length: first number, first sequence and offset of each run of planned places."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for lengths, times in made:
        offset = 0
        for length in lengths:
            rows.setdefault(length, []).append((taken.get(length, 0), sequence, offset))
            taken[length] = taken.get(length, 0) + times
            offset += length
        sequence += times
    return {length: np.array(x, np.int64) for length, x in rows.items()}


def _place(places: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            nth = batch.column("nth").to_numpy()
            sequence, offset = np.empty(len(nth), np.int64), np.empty(len(nth), np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                first, base, at = places[int(n)].T
                run_no = np.searchsorted(first, nth[own], "right") - 1
                sequence[own] = base[run_no] + nth[own] - first[run_no]
                offset[own] = at[run_no]
            names = [x for x in batch.schema.names if x != "nth"]
            columns = [batch.column(x) for x in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return run


def pack(found: DataFrame, size: int = 1024) -> DataFrame:
    """``found(doc_id, piece, length, ...)`` with ``sequence_id, offset``. The pieces are written out first: their
    numbers and the plan must come from the same rows."""
    found = write_out(found, "pieces")
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    made = plan(counts, size)
    salts = parts(sum(counts.values()), SALT_ROWS)
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        salted.groupBy("length", "salt")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    )
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    numbered = salted.withColumn("own", F.row_number().over(own)).join(shifts, ["length", "salt"])
    numbered = numbered.withColumn("nth", (F.col("own") - 1 + F.col("shift")).cast("bigint"))
    columns = [*found.columns, "nth"]
    schema = found.limit(0).withColumn("sequence_id", F.lit(0).cast("bigint")).withColumn("offset", F.lit(0).cast("bigint")).schema
    return numbered.select(*columns).mapInArrow(_place(_places(made)), schema)


def pack_documents(docs: DataFrame, path: str, end_id: int, size: int = 1024, with_ids: bool = False) -> DataFrame:
    return pack(token_pieces(docs, path, end_id, size, with_ids), size)
