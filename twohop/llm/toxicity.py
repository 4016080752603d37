"""Toxicity by a chain of classifiers.

The categories are predicted one after the other, each by a logistic model on the words of the text and the
probabilities of the categories before. What a later model is trained on are predictions for rows that the earlier
models did not see (out of fold); what it gets later are predictions of the models fitted on all rows.

The features are whole words and their first four to six bytes (inflected words share them), those that tell best
between the labelled rows of a category. Fitting takes a bounded sample of labelled rows: ``SAMPLE_TOXIC`` toxic and ``SAMPLE_CLEAN`` others,
in the order of a hash of their ids. Gradients and curvatures of Newton's steps are summed by partition in Spark, for the model of every
fold and the one of all rows in one pass; the driver holds sums and weights, never rows. Counting and prediction run over whole texts,
which are never shuffled.

Categories: ``low_quality`` (label), ``toxic`` (label), ``toxic_low_quality`` (both labels of one document). The labels know no finer ones.

Defined results: null and empty text has no words; labels that are null are not used, of several labels of a document the
largest toxicity and smallest quality count; of several rows of one ``doc_id`` the text that sorts last is learnt from, each row is
scored; without toxic labels every probability is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twohop.llm.tables import texts_of
from twohop.llm.words import _CODES, _FOLD, ALNUM, Words, mix, pieces
from twohop.store import write_out

CATEGORIES = ("low_quality", "toxic", "toxic_low_quality")
SAMPLE_TOXIC = 6_000
SAMPLE_CLEAN = 12_000
TERMS = 400
FOLDS = 4
RIDGE = 1.0
ROUNDS = 12
#: Tasks that read the bounded sample. Each returns ``FOLDS`` + 1 upper triangles of at most 127,000 numbers, 5 MB, to the driver.
_TASKS = 3

_LABELS = "doc_id bigint, toxic int, low_quality int"
_SUMS = "model int, sums binary"
PREFIXES = (4, 5, 6)

_STEPS = np.array([pow(0x9E3779B97F4A7C13, j, 1 << 64) for j in range(max(PREFIXES))], np.uint64)


def terms_of(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and key of all words, then of all prefixes of each length."""
    yield words.rows, words.keys
    codes = _CODES[_FOLD]
    length = words.ends - words.starts
    for n in PREFIXES:
        own = np.flatnonzero(length >= n)
        key = np.zeros(len(own), np.uint64)
        for j in range(n):
            key += codes[words.data[words.starts[own] + j]] * _STEPS[j]
        yield words.rows[own], mix(key + np.uint64(1 << 32 | n))


def _row_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each row."""
    for piece in pieces(batches):
        words = Words(piece.column("text"), ALNUM, fold=True)
        found = list(terms_of(words))
        rows, keys = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
        order = np.lexsort((keys, rows))
        rows, keys = rows[order], keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
        rows = rows[new]
        names = [x for x in piece.schema.names if x != "text"]
        columns = [piece.column(x).take(pa.array(rows)) for x in names]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(keys[new].view(np.int64))], names=[*names, "term"])


def counts_of(words: Words, terms: np.ndarray) -> np.ndarray:
    """How often each row has each of the (sorted) terms."""
    found = np.zeros((words.n_rows, len(terms)))
    if len(terms):
        for rows, keys in terms_of(words):
            at = np.minimum(np.searchsorted(terms, keys), len(terms) - 1)
            hit = np.flatnonzero(terms[at] == keys)
            np.add.at(found, (rows[hit], at[hit]), 1)
    return found


def _features(words: Words, terms: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Presence of each term, how strongly the average word tells for toxicity, and a constant."""
    counts = counts_of(words, terms)
    heat = np.log1p(10 * (counts @ odds) / np.maximum(words.counts, 1))
    return np.hstack([counts > 0, heat[:, None], np.ones((words.n_rows, 1))]).astype(np.float64)


def _sample_features(terms: np.ndarray, odds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = _features(Words(piece.column("text"), ALNUM, fold=True), terms, odds).astype(np.float32)
            cells = pa.array([x.tobytes() for x in found], pa.binary())
            names = [x for x in piece.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays([*[piece.column(x) for x in names], cells], names=[*names, "x"])

    return run


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _extended(x: np.ndarray, weights: list[np.ndarray]) -> np.ndarray:
    """The features and the probabilities of the categories before; ``weights``: a row for each vector, or one for all."""
    for w in weights:
        x = np.hstack([x, _sigmoid(np.einsum("ij,ij->i", x, np.broadcast_to(w, x.shape)))[:, None]])
    return x


def _newton_sums(before: list[np.ndarray], now: np.ndarray, category: int):
    """Slope and curvature of every model, over the rows that it learns: row f of ``now`` is the model without fold f, the last one learns all.

    The categories before are predicted by the models that did not see the row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = now.shape[1]
        bend, slope = np.zeros((len(now), width, width)), np.zeros((len(now), width))
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                fold = part.column("fold").to_numpy()
                x = np.stack([np.frombuffer(v.as_buffer(), np.float32) for v in part.column("x")]).astype(np.float64)
                x = _extended(x, [w[fold] for w in before])
                y = part.column(CATEGORIES[category]).to_numpy()
                for model, weights in enumerate(now):
                    own = fold != model
                    mine = x[own]
                    p = _sigmoid(mine @ weights)
                    slope[model] += (p - y[own]) @ mine
                    bend[model] += (mine * (p * (1 - p))[:, None]).T @ mine
        for model in range(len(now)):
            sums = np.concatenate([bend[model][np.triu_indices(width)], slope[model]]).tobytes()
            yield pa.RecordBatch.from_pydict({"model": pa.array([model], pa.int32()), "sums": pa.array([sums], pa.binary())})

    return run


class Chain:
    """Fitted models, in order; ``weights[j]`` takes the features and the probabilities of categories 0 to j - 1."""

    def __init__(self, rows: DataFrame, width: int):
        """``rows(fold, x, <categories>)``: ``width`` features as 32-bit bytes, labels 0 and 1, ``fold`` from 0 to ``FOLDS`` - 1."""
        self.by_fold: list[np.ndarray] = []
        for category in range(len(CATEGORIES)):
            self.by_fold.append(self._fit(rows, width + category, category))
        self.weights = [w[-1] for w in self.by_fold]

    def _fit(self, rows: DataFrame, width: int, category: int) -> np.ndarray:
        """Ridge logistic regression by Newton's steps; the last row is the model of all rows."""
        now = np.zeros((FOLDS + 1, width))
        for _ in range(ROUNDS):
            upper = np.triu_indices(width)
            totals = np.zeros((FOLDS + 1, len(upper[0]) + width))
            # One row per task and model, in the order of tasks, so that the last digits do not depend on which ends first.
            for r in rows.mapInArrow(_newton_sums(self.by_fold, now, category), _SUMS).collect():
                totals[r["model"]] += np.frombuffer(r["sums"], np.float64)
            largest = 0.0
            for model, sums in enumerate(totals):
                bend = np.zeros((width, width))
                bend[upper] = sums[:-width]
                bend += np.triu(bend, 1).T
                step = np.linalg.solve(bend + RIDGE * np.eye(width), sums[-width:] + RIDGE * now[model])
                now[model] -= step
                largest = max(largest, np.abs(step).max())
            if largest < 1e-4:  # the next step would be of the order of its square
                break
        return now

    def predict(self, x: np.ndarray) -> np.ndarray:
        return _extended(x, self.weights)[:, -len(self.weights) :]


def _predict(chain: Chain, terms: np.ndarray, odds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = chain.predict(_features(Words(piece.column("text"), ALNUM, fold=True), terms, odds))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *[pa.array(p) for p in found.T]], names=["doc_id", *CATEGORIES])

    return run


def _telling(counted: DataFrame, positive: str, n_positive: int, n: int, most: int) -> list[tuple[int, float]]:
    """The terms with the largest chi-square of presence against the category that tell for it, with their log odds.

    Among m terms without any meaning, at most one is expected to reach a chi-square of 2 ln m; weaker ones are noise and left out.
    """
    chance = 2 * math.log(max(counted.count(), 1))
    a, b = F.col(positive).cast("double"), (F.col("n") - F.col(positive)).cast("double")
    c, d = n_positive - a, (n - n_positive) - b
    square = n * (a * d - b * c) * (a * d - b * c) / ((a + b) * (c + d) * max(n_positive, 1) * max(n - n_positive, 1))
    odds = F.log(((a + 0.5) / (n_positive + 1)) / ((b + 0.5) / (n - n_positive + 1)))
    best = counted.select("term", square.alias("s"), odds.alias("odds")).where(F.col("s") >= chance)
    rows = best.where("odds > 0").orderBy(F.desc("s"), "term").limit(most).collect()
    return [(r["term"], r["odds"]) for r in rows]


def score_toxicity(docs: DataFrame, labels: DataFrame, learn_from: Column) -> DataFrame:
    """``doc_id`` and a probability per category of all ``docs``; ``labels(doc_id, quality, toxic)`` where ``learn_from`` holds are learnt."""
    known = (
        labels.where(learn_from & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"), F.coalesce((F.min("quality") == 0).cast("int"), F.lit(0)).alias("low_quality"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = [known.where(F.col("toxic") == t).orderBy(*order).limit(n) for t, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    rows = [tuple(r) for part in some for r in part.select("doc_id", "toxic", "low_quality").collect()]
    texts = texts_of(docs)
    spark = docs.sparkSession
    # At most SAMPLE_TOXIC + SAMPLE_CLEAN rows, so broadcasting them is safe at any size of the tables.
    sample = F.broadcast(spark.createDataFrame(rows, _LABELS))
    alike = ["doc_id", "toxic", "low_quality"]
    chosen = write_out(texts.join(sample, "doc_id").groupBy(*alike).agg(F.max("text").alias("text")), "labelled")
    n = chosen.agg(F.count(F.lit(1)), F.sum("toxic"), F.sum("low_quality")).first()
    if not n[0] or not n[1]:
        return texts.select("doc_id", *[F.lit(0.0).alias(c) for c in CATEGORIES])
    counted = (
        chosen.mapInArrow(_row_terms, _LABELS + ", term bigint")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"), F.sum("low_quality").alias("low_quality"))
    )
    counted = write_out(counted.where((F.col("n") >= 4) & (F.col("n") < n[0])), "terms")
    toxic = _telling(counted, "toxic", n[1], n[0], TERMS)
    low = _telling(counted, "low_quality", n[2], n[0], TERMS // 4)
    terms = np.unique(np.array([t for t, _ in toxic + low], np.int64).view(np.uint64))
    by_term = dict(toxic)
    odds = np.array([by_term.get(t, 0.0) for t in terms.view(np.int64).tolist()])
    seen = chosen.mapInArrow(_sample_features(terms, odds), _LABELS + ", x binary").select(
        "x", "low_quality", "toxic", (F.col("toxic") * F.col("low_quality")).alias("toxic_low_quality"),
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold"), F.col("doc_id").alias("id"),
    )
    placed = write_out(seen.repartitionByRange(_TASKS, "id").sortWithinPartitions("id").drop("id"), "features")
    chain = Chain(placed.coalesce(_TASKS), len(terms) + 2)
    return texts.mapInArrow(_predict(chain, terms, odds), "doc_id bigint, " + ", ".join(f"{c} double" for c in CATEGORIES))
