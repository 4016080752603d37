from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

import naive
from twohop import Tuning, adamic_adar, common_neighbors, jaccard, link_scores
from twohop.functions import adamic_adar_score
from twohop.operators import simple_graph, symmetrize, top_k

SMALL = [(2, 1), (1, 3), (4, 2), (3, 4), (5, 3), (4, 5), (1, 2), (3, 1), (2, 4), (4, 3), (3, 5), (5, 4)]
INF = math.inf
GRAPHS = {
    "dup": ([(1, 2), (1, 2), (2, 1), (2, 1), (2, 3), (3, 2)], {(1, 3): (2, 2.0, 4.19181)}),
    "loop": ([(1, 1), (1, 2), (2, 1), (2, 3), (3, 2)], {(1, 3): (1, 0.5, 3.32193)}),
    "dirA": ([(1, 2), (1, 3)], {(2, 3): (1, None, 3.32193)}),
    "dirB": ([(1, 2), (1, 3), (2, 4)], {(2, 3): (1, INF, 3.32193)}),
    "dirC": ([(1, 2), (1, 3), (5, 2), (5, 3), (2, 4)], {(2, 3): (2, -2.0, 6.64386)}),
    "revonly": ([(1, 2), (1, 3), (3, 2), (2, 1), (3, 1)], {(2, 3): (1, INF, 3.32193)}),
    "triangle": ([(1, 2), (2, 1), (1, 3), (3, 1), (2, 3), (3, 2)], {}),
    "star": (
        [e for i in range(1, 5) for e in ((0, i), (i, 0))],
        {(i, j): (1, 1.0, 1.66096) for i in range(1, 5) for j in range(i + 1, 5)},
    ),
}
TINY_SLICES = Tuning(slice_rows=2)


def scores_of(df):
    return {(r["u"], r["v"]): r["score"] for r in df.collect()}


def close(left, right):
    assert left.keys() == right.keys()
    for pair, score in left.items():
        assert score == pytest.approx(right[pair], abs=1e-9), pair


def test_small_graph(edges_of):
    edges = edges_of(SMALL)
    assert [tuple(r) for r in common_neighbors(edges, 10).collect()] == [(1, 4, 2), (2, 3, 2), (1, 5, 1), (2, 5, 1)]
    assert [tuple(r) for r in jaccard(edges, 2).collect()] == [(1, 4, 2 / 3), (2, 3, 2 / 3)]
    best = adamic_adar(edges, 1).collect()
    assert (best[0]["u"], best[0]["v"]) == (1, 4) and round(best[0]["score"], 5) == 5.41783


@pytest.mark.parametrize("name", GRAPHS)
@pytest.mark.parametrize("tuning", [Tuning(), TINY_SLICES], ids=["whole", "sliced"])
def test_edge_cases(edges_of, name, tuning):
    rows, expected = GRAPHS[name]
    edges = edges_of(rows)
    assert scores_of(common_neighbors(edges, tuning=tuning)) == {p: e[0] for p, e in expected.items()}
    assert scores_of(jaccard(edges, tuning=tuning)) == {p: e[1] for p, e in expected.items() if e[1] is not None}
    assert {p: round(s, 5) for p, s in scores_of(adamic_adar(edges, tuning=tuning)).items()} == {
        p: e[2] for p, e in expected.items()
    }
    fused = {(r["u"], r["v"]): (r["cn"], r["jc"], round(r["aa"], 5)) for r in link_scores(edges, tuning=tuning).collect()}
    assert fused == expected


@pytest.mark.parametrize("name", ["dup", "loop"])
def test_after_simple_graph(edges_of, name):
    edges = simple_graph(edges_of(GRAPHS[name][0]))
    (row,) = link_scores(edges).collect()
    assert (row["u"], row["v"], row["cn"], row["jc"], round(row["aa"], 5)) == (1, 3, 1, 1.0, 3.32193)


def random_bag(seed, nodes=30, rows=150):
    rng = random.Random(seed)
    # Node 0 and a few repeated edges own a large share of the rows.
    plain = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(rows)]
    hub = [e for i in range(1, nodes, 2) for e in ((0, i), (i, 0))]
    return plain + hub + [(0, 1)] * 12 + [(3, 4)] * 7


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("tuning", [Tuning(), Tuning(slice_rows=3)], ids=["whole", "sliced"])
def test_random_bags_match_the_definitions(edges_of, seed, tuning):
    rows = random_bag(seed)
    edges = edges_of(rows)
    assert scores_of(common_neighbors(edges, tuning=tuning)) == naive.common_neighbors(rows)
    assert scores_of(jaccard(edges, tuning=tuning)) == naive.jaccard(rows)
    close(scores_of(adamic_adar(edges, tuning=tuning)), naive.adamic_adar(rows))


def test_copies_stand_for_equal_rows(spark, edges_of):
    rows = random_bag(9)
    counted = edges_of(rows).groupBy("src", "dst").agg(F.count("*").alias("copies"))
    for measure in (common_neighbors, jaccard, adamic_adar):
        assert scores_of(measure(counted)) == scores_of(measure(edges_of(rows)))


def test_properties_on_an_undirected_graph(edges_of):
    rows = random_bag(5)
    edges = simple_graph(symmetrize(edges_of(rows))).cache()
    known = {tuple(r) for r in edges.collect()}
    fused = link_scores(edges).collect()
    assert fused
    for r in fused:
        assert r["u"] < r["v"] and (r["u"], r["v"]) not in known
        assert r["cn"] >= 1 and 0 < r["jc"] <= 1 and r["aa"] > 0
    assert {(r["u"], r["v"]): r["cn"] for r in fused} == scores_of(common_neighbors(edges))
    assert {(r["u"], r["v"]): r["jc"] for r in fused} == scores_of(jaccard(edges))
    assert {(r["u"], r["v"]): r["aa"] for r in fused} == scores_of(adamic_adar(edges))
    assert scores_of(jaccard(edges, exact_orientation=False)) == scores_of(jaccard(edges))
    assert scores_of(jaccard(edges.repartition(7))) == scores_of(jaccard(edges))
    moved = edges.select((F.col("src") + 1000).alias("src"), (F.col("dst") + 1000).alias("dst"))
    shifted = {(u - 1000, v - 1000): s for (u, v), s in scores_of(adamic_adar(moved)).items()}
    assert shifted == scores_of(adamic_adar(edges))
    edges.unpersist()


def test_top_k_bounds(edges_of):
    edges = edges_of(SMALL)
    assert common_neighbors(edges, 0).collect() == []
    with pytest.raises(ValueError):
        common_neighbors(edges, -1)
    assert top_k(jaccard(edges), 99).count() == 4


def test_weight_sum_in_two_parts(spark):
    parts = [(5, 1_000_001), (6, 1), (10**15, 7), (10**15 - 3, 3_000_007)]
    df = spark.createDataFrame(parts, "high bigint, low bigint")
    found = [r[0] for r in df.select(adamic_adar_score(F.col("high"), F.col("low"))).collect()]
    assert found == [float(high * 10**6 + low) / 1e12 for high, low in parts]
