"""Embedding near-dedup with an inverted multi-index.

Vectors are brought to length 1 and cut into halves. Each half has a codebook of its own, fitted on a bounded sample; a pair of codewords is
a cell of the product grid, and every vector is stored in its cell. A query visits cells by the sum of its halves' distances to the codewords,
nearest first (multi-sequence order), until as many are visited as the target recall needs. That number is measured
on the sample, for neighbours put exactly at the threshold, the hardest to find. What is found is verified by cosine in double precision.

Equal vectors of a label are one class, found by 128 bits of hash and counted before anything is compared; the class is indexed once,
under its smallest id, and stands for all its copies in every count of links.

A pair is found if either vector visits the other's cell. Pairs are counted in matrix blocks and never listed: a cell with many
vectors is cut into chunks of ``MEMBERS`` stored and ``QUERIES`` visiting vectors, and a block returns per vector its number
of links and the smallest id it reaches in the block. Cells are looked up in narrow rows; a vector travels once to each block, in the
precision it was given in, and the cells it visits only with its stored row.

The codebooks have the square root of (classes of the largest label / ``CELL_ROWS``) words each, so that a cell holds about ``CELL_ROWS``
classes at any size. They are fitted on ``PER_WORD`` sampled vectors a word, at least ``SAMPLE`` and at most ``MOST_SAMPLE``: beyond
``CELL_ROWS * (MOST_SAMPLE / PER_WORD) ** 2`` classes of one label (268 million) cells grow; nothing is left out then either.

Defined results: vectors that are null or zero, hold null or non-finite components, or have no label or id link with nothing; vectors of
different lengths do not link; of rows with the same ``vec_id`` the first by label and vector is compared, and its result is
returned for each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from twohop.llm.components import components
from twohop.store import write_out

SAMPLE = 4_096
MOST_SAMPLE = 65_536
PER_WORD = 16
CELL_ROWS = 16
RECALL = 0.99
MEMBERS = 2_048
QUERIES = 4_096
_SEED = 11

_INDEX = "vec_id bigint, label string, copies bigint, size int, home int, probes array<int>, vector binary"
_FOUND = "vec_id bigint, n bigint, root bigint"


def unit_vectors(rows: list[np.ndarray] | list[list[float]], width: int) -> np.ndarray:
    """Rows of length 1, shorter ones filled up with zeros, which leaves cosines as they are."""
    found = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        found[i, : len(row)] = row
    return _to_length_one(found)


def _to_length_one(found: np.ndarray) -> np.ndarray:
    found /= np.maximum(np.abs(found).max(axis=1, keepdims=True), np.finfo(float).tiny)
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def _distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ words.T + (words * words).sum(axis=1)


def _nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    strips = [_distances(x[at : at + 2048], words).argmin(axis=1) for at in range(0, len(x), 2048)]
    return np.concatenate(strips)


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    words = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = _nearest(x, words)
        counts = np.bincount(own, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, own, x)
        words = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], words)
    return words


class MultiIndex:
    def __init__(self, sample: np.ndarray, k: int, threshold: float, recall: float = RECALL):
        rng = np.random.default_rng(_SEED)
        self.half = (sample.shape[1] + 1) // 2
        self.first = _codebook(sample[:, : self.half], k, rng)
        self.second = _codebook(sample[:, self.half :], k, rng)
        self.cells = len(self.first) * len(self.second)
        self.visits = self._visits(sample[:SAMPLE], threshold, recall, rng)

    def _visits(self, sample: np.ndarray, threshold: float, recall: float, rng: np.random.Generator) -> int:
        """Cells to visit so that this share of vectors at the threshold is found from either side."""
        away = rng.normal(size=sample.shape)
        away -= (away * sample).sum(axis=1, keepdims=True) * sample
        away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
        near = threshold * sample + np.sqrt(max(1 - threshold**2, 0)) * away
        need = []
        for at in range(0, len(sample), 512):
            x, y = sample[at : at + 512], near[at : at + 512]
            need.append(np.minimum(self._rank(x, y), self._rank(y, x)))
        return min(int(np.quantile(np.concatenate(need), recall, method="higher")) + 1, self.cells)

    def _rank(self, query: np.ndarray, stored: np.ndarray) -> np.ndarray:
        """How many cells the query visits before the one of the stored vector."""
        a, b = self._halves(query)
        c, d = self._halves(stored)
        own = np.arange(len(query))
        limit = a[own, c.argmin(axis=1)] + b[own, d.argmin(axis=1)]
        b = np.sort(b, axis=1)
        return np.array([np.searchsorted(b[row], limit[row] - a[row]).sum() for row in own])

    def _halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(x[:, : self.half], self.first), _distances(x[:, self.half :], self.second)

    def probes(self, x: np.ndarray) -> np.ndarray:
        """The cells that each vector visits, nearest first; the first is where it is stored."""
        a, b = self._halves(x)
        order_a, order_b = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
        a, b = np.take_along_axis(a, order_a, 1), np.take_along_axis(b, order_b, 1)
        # The n nearest cells lie under the staircase i * j <= n of the sorted halves.
        n = self.visits
        stairs = [(i, j) for i in range(min(n, a.shape[1])) for j in range(min(n // (i + 1), b.shape[1]))]
        i, j = np.array(stairs).T
        sums = a[:, i] + b[:, j]
        best = np.argsort(sums, axis=1, kind="stable")[:, :n]
        own = np.arange(len(x))[:, None]
        return order_a[own, i[best]] * len(self.second) + order_b[own, j[best]]


def _assign(index: MultiIndex, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                column = batch.column("embedding")
                ends = np.cumsum(column.value_lengths().to_numpy())
                rows = np.split(column.flatten().to_numpy(zero_copy_only=False), ends[:-1])
                probes = index.probes(unit_vectors(rows, width)).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": batch.column("vec_id"),
                        "label": batch.column("label"),
                        "copies": batch.column("copies"),
                        "size": column.value_lengths().cast(pa.int32()),
                        "home": pa.array(probes[:, 0]),
                        "probes": pa.array(list(probes), pa.list_(pa.int32())),
                        "vector": pa.array([x.tobytes() for x in rows], pa.binary()),
                    }
                )

    return run


def _block(threshold: float, kind: type):
    """Links between the visiting and the stored vectors of one chunk of a cell; a vector counts as often as it has copies."""

    def run(table: pa.Table) -> pa.Table:
        ids, home, copies = (table[x].to_numpy() for x in ("vec_id", "home", "copies"))
        units = _to_length_one(np.stack([np.frombuffer(x.as_buffer(), kind) for x in table["vector"]]).astype(np.float64))
        stored = np.flatnonzero(table["stored"].to_numpy(zero_copy_only=False))
        visiting = np.flatnonzero(table["visiting"].to_numpy(zero_copy_only=False))
        # Only stored rows carry the cells that they visit.
        probes = table["probes"].combine_chunks().flatten().to_numpy().reshape(len(stored), -1) if len(stored) else None
        linked = np.zeros((len(visiting), len(stored)), bool)
        for at in range(0, len(visiting), 512):
            linked[at : at + 512] = units[visiting[at : at + 512]] @ units[stored].T >= threshold
        linked &= ids[visiting][:, None] != ids[stored][None, :]
        # A stored vector that visits the other's cell counts the pair there.
        n_visiting, n_stored = np.where(linked, copies[stored], 0).sum(axis=1), np.zeros(len(stored), np.int64)
        for j in np.flatnonzero(linked.any(axis=0)):
            others = visiting[linked[:, j]]
            n_stored[j] = copies[others[~np.isin(home[others], probes[j])]].sum()
        top = np.iinfo(np.int64).max
        root_v, root_s = ids[visiting].copy(), ids[stored].copy()
        while len(visiting) and len(stored):
            before = root_v.sum() + root_s.sum()
            # A vector may be on both sides of the block.
            by_id: dict[int, int] = {}
            root_v = np.minimum(root_v, np.where(linked, root_s[None, :], top).min(axis=1))
            root_s = np.minimum(root_s, np.where(linked, root_v[:, None], top).min(axis=0))
            for own, root in ((ids[visiting], root_v), (ids[stored], root_s)):
                for i, r in zip(own.tolist(), root.tolist(), strict=True):
                    by_id[i] = min(by_id.get(i, top), r)
            root_v = np.array([by_id[i] for i in ids[visiting].tolist()])
            root_s = np.array([by_id[i] for i in ids[stored].tolist()])
            if root_v.sum() + root_s.sum() == before:
                break
        own = np.concatenate([ids[visiting], ids[stored]])
        n, root = np.concatenate([n_visiting, n_stored]), np.concatenate([root_v, root_s])
        keep = (n > 0) | (root != own)
        return pa.table({"vec_id": own[keep], "n": n[keep].astype(np.int64), "root": root[keep].astype(np.int64)})

    return run


def _classes(valid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Equal vectors of a label: the table ``vec_id, class_id, n_copies`` of members, and the vectors of the classes.

    Hashes are counted, not vectors, so a group of copies is combined before the shuffle. Both sides of the join are read from files,
    which lets adaptive execution split a class with a large share of the rows.
    """
    alike = ["label", "k1", "k2"]
    keys = valid.select("vec_id", "label", F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(1), F.reverse("embedding")).alias("k2"))
    keys = write_out(keys, "vector-keys")
    classes = write_out(keys.groupBy(*alike).agg(F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("n_copies")), "vector-classes")
    members = keys.join(classes, alike).select("vec_id", "class_id", "n_copies")
    heads = classes.select(F.col("class_id").alias("vec_id"), F.col("n_copies").alias("copies"))
    return members, valid.join(heads, "vec_id")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding, label)``."""
    single = vectors.schema["embedding"].dataType == ArrayType(FloatType(), vectors.schema["embedding"].dataType.containsNull)
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"),
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    good = F.expr("vec_id is not null and label is not null and size(embedding) > 0") & finite & F.exists("embedding", lambda x: x != 0)
    first = Window.partitionBy("vec_id").orderBy("label", "embedding")
    valid = rows.where(F.coalesce(good, F.lit(False))).withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")
    members, heads = _classes(valid)
    heads = write_out(heads, "vector-heads")
    by_label = heads.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("width"))
    most, width = by_label.agg(F.max("n"), F.max("width")).first()
    if most is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    k = max(math.ceil(math.sqrt(most / CELL_ROWS)), 2)
    n_sample = min(max(SAMPLE, PER_WORD * k), MOST_SAMPLE)
    sample = [r["embedding"] for r in heads.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_sample).select("embedding").collect()]
    index = MultiIndex(unit_vectors(sample, width), min(k, MOST_SAMPLE // PER_WORD), threshold)
    stored = write_out(heads.select("vec_id", "label", "copies", "embedding").mapInArrow(_assign(index, width), _INDEX), "multi-index")
    visits = stored.select("label", "size", F.explode("probes").alias("cell"), "home", "vec_id")
    chunks = visits.groupBy("label", "size", "cell").agg(
        F.ceil(F.sum((F.col("home") == F.col("cell")).cast("int")) / MEMBERS).cast("int").alias("of_stored"),
        F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("of_visiting"),
    )
    # Written, so that a crowded cell can be split in the join; cells without vectors are not visited.
    chunks = write_out(chunks.where("of_stored > 0"), "cells")
    cells = visits.join(chunks, ["label", "size", "cell"]).groupBy("vec_id").agg(F.collect_list(F.struct("cell", "of_stored", "of_visiting")).alias("cells"))
    probing = stored.join(cells, "vec_id").withColumn("at", F.explode("cells"))
    mine_stored = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("at.of_stored")).cast("int")
    mine_visiting = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.col("at.of_visiting")).cast("int")
    # A visiting vector meets every chunk of stored ones, a stored one every chunk of visiting ones.
    as_visiting = F.transform(
        F.sequence(F.lit(0), F.col("at.of_stored") - 1), lambda c: F.struct(c.alias("s"), mine_visiting.alias("v"), F.lit(True).alias("visiting"))
    )
    as_stored = F.transform(
        F.sequence(F.lit(0), F.col("at.of_visiting") - 1), lambda c: F.struct(mine_stored.alias("s"), c.alias("v"), F.lit(False).alias("visiting"))
    )
    roles = F.when(F.col("home") == F.col("at.cell"), F.concat(as_visiting, as_stored)).otherwise(as_visiting)
    dealt = probing.withColumn("role", F.explode(roles)).select(
        "label", "size", F.col("at.cell").alias("cell"), "vec_id", "copies", "home", "vector", F.col("role.s").alias("s"), F.col("role.v").alias("v"),
        F.when(~F.col("role.visiting"), F.col("probes")).alias("probes"),
        F.col("role.visiting").alias("visiting"), (~F.col("role.visiting")).alias("stored"),
    )
    kind = np.float32 if single else np.float64
    found = write_out(dealt.groupBy("label", "size", "cell", "s", "v").applyInArrow(_block(threshold, kind), _FOUND), "vector-links")
    counted = found.groupBy("vec_id").agg(F.sum("n").alias("n_others")).withColumnRenamed("vec_id", "class_id")
    joined = components(found, "vec_id", "root").withColumnRenamed("node", "class_id")
    # Few classes link with others; written, so that the members of a large class can be split.
    linked = write_out(counted.join(joined, "class_id", "outer"), "class-links")
    of_members = members.join(linked, "class_id", "left").select(
        "vec_id",
        (F.col("n_copies") - 1 + F.coalesce("n_others", F.lit(0))).cast("bigint").alias("n_links"),
        F.coalesce("component", "class_id").alias("component_id"),
    )
    result = rows.select("vec_id").join(of_members, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
