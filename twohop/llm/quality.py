"""Quality classifier: ridge regression on random Fourier features, calibrated by isotonic regression.

Every text becomes a row of statistics. Random Fourier features (fixed seed) approximate a Gaussian kernel over the
standardised statistics. Each partition adds up its share of the normal equations, per fold; the sums, whose size depends
only on the number of features, are solved on the driver. Scores of labelled rows by models that did not see their
fold are counted in bins, and the pool-adjacent-violators rule turns the bins into probabilities.

All labelled rows are used. The statistics are written out once, so the texts are read once and never shuffled.

Defined results: null and empty texts have statistics of zero and are scored; without labels every score is 0.5; labels that
are null are not used, of several labels of a document the largest is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twohop.llm.statistics import NAMES, statistics
from twohop.llm.tables import texts_of
from twohop.llm.words import pieces
from twohop.store import write_out

FEATURES = 256
FOLDS = 4
BINS = 1000
RIDGE = 1e-3
SEED = 7
_SLABS = 8


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        found = statistics(piece.column("text"))
        cells = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(NAMES)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_pydict({"doc_id": piece.column("doc_id"), "stats": cells})


def document_statistics(docs: DataFrame) -> DataFrame:
    return write_out(texts_of(docs).mapInArrow(_measure, "doc_id bigint, stats array<double>"), "statistics")


class Fourier:
    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int = FEATURES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.weights = rng.normal(size=(len(mean), features)) / np.sqrt(len(mean))
        self.shift = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.spread, -8, 8)
        found = np.sqrt(2 / len(self.shift)) * np.cos(scaled @ self.weights + self.shift)
        return np.hstack([found, np.ones((len(stats), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(NAMES))


def _normal_sums(fourier: Fourier):
    """Per partition, fold and slab of rows: the sums of x x' and x y, side by side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x, y, fold = fourier(_matrix(part.column("stats"))), part.column("y").to_numpy(), part.column("fold").to_numpy()
                for f in np.unique(fold).tolist():
                    own = x[fold == f]
                    sums[f] = sums.get(f, 0) + own.T @ np.hstack([own, y[fold == f][:, None]])
        for f, total in sums.items():
            slabs = np.array_split(total, _SLABS)
            yield pa.RecordBatch.from_pydict(
                {
                    "fold": pa.array([f] * _SLABS, pa.int32()),
                    "slab": pa.array(range(_SLABS), pa.int32()),
                    "sums": pa.array([x.tobytes() for x in slabs], pa.binary()),
                }
            )

    return run


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), np.float64) for x in table["sums"])
    return pa.table({"fold": table["fold"][:1], "slab": table["slab"][:1], "sums": pa.array([total.tobytes()], pa.binary())})


def _solve(sums: np.ndarray) -> np.ndarray:
    a = sums[:, :-1]
    return np.linalg.solve(a + RIDGE * max(a[-1, -1], 1) * np.eye(len(a)), sums[:, -1])


_LOW, _HIGH = -0.5, 1.5


def _bins(fourier: Fourier, by_fold: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x, fold = fourier(_matrix(part.column("stats"))), part.column("fold").to_numpy()
                raw = np.einsum("ij,ij->i", x, np.stack([by_fold[f] for f in fold.tolist()]))
                bin_no = np.clip((raw - _LOW) / (_HIGH - _LOW) * BINS, 0, BINS - 1).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"bin": pa.array(bin_no), "y": part.column("y")})

    return run


def isotonic(total: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins: knots and the rising share of positives at them."""
    pools: list[list[float]] = []  # weight, positives, weighted sum of places
    for place in np.flatnonzero(total):
        pools.append([float(total[place]), float(positive[place]), float(total[place] * place)])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    base = positive.sum() / max(total.sum(), 1)
    knots = np.array([p[2] / p[0] for p in pools])
    return knots, np.array([(p[1] + base) / (p[0] + 1) for p in pools])


def _score(fourier: Fourier, weights: np.ndarray, knots: np.ndarray, shares: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                raw = fourier(_matrix(part.column("stats"))) @ weights
                place = np.clip((raw - _LOW) / (_HIGH - _LOW), 0, 1) * BINS
                # A small share of the raw score keeps the order within a pool.
                score = 0.999 * np.interp(place, knots, shares) + 0.001 * place / BINS
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "score": pa.array(np.clip(score, 0, 1))})

    return run


def score_quality(docs: DataFrame, labels: DataFrame, learn_from: Column, fold: Column) -> DataFrame:
    """``doc_id, score`` of all ``docs``; ``labels(doc_id, quality)`` where ``learn_from`` holds are learnt; ``fold``: 0 to ``FOLDS`` - 1."""
    stats = document_statistics(docs)
    known = (
        labels.where(learn_from & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max("quality").cast("double").alias("y"))
        .withColumn("fold", fold.cast("int"))
    )
    train = write_out(stats.join(known, "doc_id").select("stats", "y", "fold"), "labelled")
    values = [F.col("stats")[i] for i in range(len(NAMES))]
    row = train.agg(F.count(F.lit(1)), *[F.avg(v) for v in values], *[F.stddev_pop(v) for v in values]).first()
    if not row[0]:
        return stats.select("doc_id", F.lit(0.5).alias("score"))
    fourier = Fourier(np.array(row[1 : 1 + len(NAMES)]), np.array(row[1 + len(NAMES) :]))
    parts = train.mapInArrow(_normal_sums(fourier), "fold int, slab int, sums binary")
    sums: dict[int, list[np.ndarray]] = {}
    for r in parts.groupBy("fold", "slab").applyInArrow(_add, "fold int, slab int, sums binary").sort("fold", "slab").collect():
        sums.setdefault(r["fold"], []).append(np.frombuffer(r["sums"], np.float64).reshape(-1, FEATURES + 2))
    folds = {f: np.vstack(x) for f, x in sums.items()}
    total = sum(folds.values())
    by_fold = {f: _solve(total - x if len(folds) > 1 else total) for f, x in folds.items()}
    counted = train.mapInArrow(_bins(fourier, by_fold), "bin int, y double").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"))
    n, y = np.zeros(BINS), np.zeros(BINS)
    for r in counted.collect():
        n[r["bin"]], y[r["bin"]] = r["n"], r["y"]
    knots, shares = isotonic(n, y)
    return stats.mapInArrow(_score(fourier, _solve(total), knots, shares), "doc_id bigint, score double")
