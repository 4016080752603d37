from __future__ import annotations

import numpy as np
import pytest

from twohop.llm import embeddings
from twohop.llm.components import components
from twohop.llm.embeddings import MultiIndex, near_duplicates, unit_vectors

SCHEMA = "vec_id bigint, embedding array<double>, label int, cell string, home string"


def _vectors(n=600, d=17, seed=3):
    rng = np.random.default_rng(seed)
    found = rng.normal(size=(n, d))
    for i in range(0, n, 6):  # near copies, some far from others of their group
        k = min(3, n - i - 1)
        found[i + 1 : i + 1 + k] = found[i] + rng.normal(size=(k, d)) * 0.22
    found[n // 2 :: 3] = found[7] + rng.normal(size=(len(found[n // 2 :: 3]), d)) * 0.02
    return found


def _brute(rows, threshold):
    n = len(rows)
    linked = np.zeros((n, n), bool)
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows):
            ok = i != j and la is not None and la == lb and a and b and len(a) == len(b) and None not in a and None not in b
            if ok and np.isfinite(a).all() and np.isfinite(b).all() and any(a) and any(b):
                u, v = np.array(a) / np.abs(a).max(), np.array(b) / np.abs(b).max()
                linked[i, j] = u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= threshold
    comp = np.array([r[0] for r in rows])
    while True:
        new = np.array([min([comp[i], *comp[linked[i]]]) for i in range(n)])
        if (new == comp).all():
            return linked.sum(axis=1), comp
        comp = new


@pytest.mark.parametrize("chunk", [2048, 13])
def test_against_brute_force(spark, monkeypatch, chunk):
    """All cells are visited by a recall of 1, so nothing is missed; small chunks cut hot cells."""
    monkeypatch.setattr(embeddings, "MEMBERS", chunk)
    monkeypatch.setattr(embeddings, "QUERIES", chunk)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(_vectors())]
    first = rows[0][1]
    odd = [None, [], [0.0] * 17, [None, *first[1:]], [float("nan"), *first[1:]], [float("inf"), *first[1:]], first[:9], [x * 1e200 for x in first]]
    rows += [(1000 + i, v, 0) for i, v in enumerate(odd)] + [(2000, first, None)]
    frame = spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA)
    found = {r["vec_id"]: r for r in near_duplicates(frame).collect()}
    n, comp = _brute(rows, 0.93)
    assert len(found) == len(rows)
    pairs = sum(r["n_links"] for r in found.values())
    assert 0.97 * n.sum() <= pairs <= n.sum()
    same = [found[r[0]]["component_id"] == c for r, c in zip(rows, comp, strict=True)]
    assert np.mean(same) >= 0.97
    assert all(r["kept"] == (r["component_id"] == r["vec_id"]) for r in found.values())
    assert found[1007]["n_links"] > 0 and all(found[1000 + i]["n_links"] == 0 for i in range(6))


def test_copies_are_compared_once(spark, monkeypatch):
    """50,000 equal vectors of one label: each links with all others, and no block sees more than the classes."""
    seen = spark.sparkContext.accumulator(0)
    block = embeddings._block

    def counting(*args):
        run = block(*args)

        def wrapped(table):
            seen.add(table.num_rows)
            return run(table)

        return wrapped

    monkeypatch.setattr(embeddings, "_block", counting)
    far, near = [1.0, 0.0, 0.0], [1.0, 0.3, 0.0]
    many = spark.range(50_000).selectExpr("id + 10 as vec_id", "array(cast(0.5 as float), cast(-2 as float), cast(1 as float)) as embedding", "1 as label")
    few = spark.createDataFrame([(1, far, 1), (2, near, 1), (3, near, 1), (4, near, 2)], "vec_id bigint, embedding array<float>, label int")
    found = near_duplicates(many.union(few))
    total = found.groupBy("n_links", "component_id").count().collect()
    assert sorted(tuple(r) for r in total) == [(0, 4, 1), (2, 1, 3), (49_999, 10, 50_000)]
    assert 0 < seen.value < 100


@pytest.mark.parametrize("precision", ["float", "double"])
def test_recall_of_planted_neighbours(spark, precision):
    """Neighbours just above the threshold among 3,000 vectors, with an index that visits a part of its cells."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=(1_000, 32))
    away -= (away * x[:1_000]).sum(axis=1, keepdims=True) * x[:1_000]
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosine = rng.uniform(0.931, 0.98, size=(1_000, 1))
    every = np.concatenate([x, cosine * x[:1_000] + np.sqrt(1 - cosine**2) * away])
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(every)], f"vec_id bigint, embedding array<{precision}>, label int")
    found = {r["vec_id"]: r for r in near_duplicates(frame).collect()}
    hits = [found[3_000 + i]["component_id"] == found[i]["component_id"] for i in range(1_000)]
    assert np.mean(hits) >= 0.95
    given = every.astype(np.float32).astype(float) if precision == "float" else every
    given /= np.linalg.norm(given, axis=1, keepdims=True)
    n = (given @ given.T >= 0.93).sum(axis=1) - 1
    assert all(found[i]["n_links"] <= n[i] for i in found) and sum(r["n_links"] for r in found.values()) >= 0.95 * n.sum()


def test_codebooks_grow_with_the_table():
    """No limit of 256 words: the index of a large label is fitted and probed in strips."""
    units = unit_vectors(np.random.default_rng(1).normal(size=(9_000, 8)), 8)
    index = MultiIndex(units, 600, 0.93)
    assert len(index.first) == len(index.second) == 600 and index.visits < index.cells
    assert len(np.unique(index.probes(units[:50])[0])) == index.visits


def test_rows_with_one_id_and_without(spark):
    v = [1.0, 2.0]
    rows = [(1, v, 0, "", ""), (1, v, 0, "", ""), (2, v, 0, "", ""), (None, v, 0, "", ""), (3, [1.0], 0, "", ""), (4, [2.0], 0, "", "")]
    found = sorted([tuple(r) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()], key=str)
    assert found == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False), (None, 0, None, True)]


def test_nothing(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [tuple(r) for r in near_duplicates(spark.createDataFrame([(1, None, 1, "", "")], SCHEMA)).collect()] == [(1, 0, 1, True)]


def test_multi_sequence_order():
    units = unit_vectors([v.tolist() for v in _vectors(200, 8)], 8)
    index = MultiIndex(units, 6, 0.93)
    index.visits = 11
    a, b = index._halves(units)
    every = (a[:, :, None] + b[:, None, :]).reshape(len(units), -1)
    nearest = np.sort(every, axis=1)[:, :11]
    assert np.allclose(np.take_along_axis(every, index.probes(units), 1), nearest)


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    links = [*chain, (100, 101), (101, 100), (7, 7), (None, 3), (200, 210), (205, 210), (205, 220)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 200: 200, 205: 200, 210: 200, 220: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").collect() == []
