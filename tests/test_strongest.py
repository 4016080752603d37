"""The top k found in phases equals the top k of all pairs."""

from __future__ import annotations

import os
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import naive
from twohop import Tuning, adamic_adar, common_neighbors, jaccard, link_scores
from twohop.operators.graph import edge_bag
from twohop.operators.pairs import shared_sums
from twohop.plans import measures, strongest
from twohop.store import scratch, shared_folder

MEASURES = {"common_neighbors": common_neighbors, "adamic_adar": adamic_adar, "jaccard": jaccard}


def graph(seed, undirected):
    """Random rows with two hubs, leaves that only know a hub, and twins."""
    rng = random.Random(seed)
    rows = [(rng.randrange(25), rng.randrange(25)) for _ in range(90)]
    rows += [(100, i) for i in range(0, 25, 2)] + [(101, i) for i in range(0, 25, 3)]
    rows += [(100, 200 + i) for i in range(8)] + [(300, 400), (300, 401), (301, 400), (301, 401)]
    if undirected:
        return sorted({e for a, b in rows if a != b for e in ((a, b), (b, a))})
    return rows + [(100, 2)] * 5 + rows[:20]


@pytest.mark.parametrize("undirected", [True, False], ids=["undirected", "bag"])
@pytest.mark.parametrize("name", MEASURES)
@pytest.mark.parametrize("k, light", [(12, 3), (5000, 1)])
def test_same_as_all_pairs(edges_of, name, undirected, k, light):
    rows = graph(k, undirected)
    edges = edges_of(rows)
    tuning = Tuning(slice_rows=3, light_fan_out=light)
    found = [tuple(r) for r in MEASURES[name](edges, k, tuning=tuning).collect()]
    expected = naive.best(getattr(naive, name)(rows), k)
    assert len(found) == len(expected)
    assert [s for *_, s in found] == pytest.approx([s for *_, s in expected])
    if name != "adamic_adar":  # its naive sums differ in the last digits, and with them the order of ties
        assert found == expected


@pytest.mark.parametrize("seed", range(6))
def test_jaccard_on_faulty_graphs(edges_of, seed):
    """Repeats, loops, lone edges, nodes without edges of their own: scores above 1, infinite and negative ones."""
    rng = random.Random(seed)
    rows = graph(seed, seed % 2 == 0)
    for _ in range(rng.randint(1, 6)):
        rows.append(rng.choice([rng.choice(rows), (rng.randrange(25), rng.randrange(25)), (100, 500 + rng.randrange(9)), (7, 7)]))
    for exact in (True, False):
        everything = jaccard(edges_of(rows), exact_orientation=exact)
        want = naive.best({(r["u"], r["v"]): r["score"] for r in everything.collect()}, 15)
        found = jaccard(edges_of(rows), 15, exact_orientation=exact, tuning=Tuning(slice_rows=3, light_fan_out=4))
        assert [tuple(r) for r in found.collect()] == want


@pytest.mark.parametrize("by", MEASURES)
def test_all_scores_of_the_best(edges_of, by):
    rows = graph(2, False)
    every = {(r["u"], r["v"]): r for r in link_scores(edges_of(rows)).collect()}
    best = MEASURES[by](edges_of(rows), 9, tuning=Tuning(slice_rows=3, light_fan_out=4)).collect()
    found = link_scores(edges_of(rows), k=9, by=by, tuning=Tuning(slice_rows=3, light_fan_out=4)).collect()
    assert sorted(found) == sorted(every[r["u"], r["v"]] for r in best)


def test_faults_cost_only_their_own_nodes(spark):
    """A hub with one repeated edge, a loop and a lone edge: all of its pairs would be 40 million."""
    n = 9_000
    star = spark.range(1, n + 1).selectExpr("0L AS a", "id AS b")
    ring = spark.range(6_001, n).selectExpr("id AS a", "id + 1 AS b")
    link = star.union(ring)
    faults = spark.createDataFrame([(0, 5), (0, 0), (0, n + 1)], "src bigint, dst bigint")
    edges = link.selectExpr("a AS src", "b AS dst").union(link.selectExpr("b", "a")).union(faults)
    found = [tuple(r) for r in jaccard(edges, 3).collect()]
    # Beside a leaf node 5 is shared twice, and the last node has no edge of its own: neither leaves a union.
    assert found == [(1, 5, float("inf")), (1, n + 1, float("inf")), (2, 5, float("inf"))]


def test_tables_are_deleted(spark, edges_of):
    before = set(os.listdir(shared_folder(spark)))
    with scratch(spark):
        assert len(common_neighbors(edges_of(graph(1, True)), 3).collect()) == 3
        assert set(os.listdir(shared_folder(spark))) > before
    assert set(os.listdir(shared_folder(spark))) == before


@pytest.mark.parametrize("name", MEASURES)
def test_one_hub_with_a_third_of_all_rows(spark, name):
    n = 30_000  # all pairs of the hub would be 450 million
    star = spark.range(1, n + 1).selectExpr("0L AS a", "id AS b")
    ring = spark.range(1, n + 1).selectExpr("id AS a", f"1 + id % {n} AS b")
    link = star.union(ring) if name != "jaccard" else star.union(ring.where("a > 20000 AND b > 20000"))
    edges = link.selectExpr("a AS src", "b AS dst").union(link.selectExpr("b", "a"))
    found = [tuple(r) for r in MEASURES[name](edges, 3).collect()]
    if name == "jaccard":
        assert found == [(1, v, 1.0) for v in (2, 3, 4)]
    else:
        assert [r[:2] for r in found] == [(1, 3), (1, n - 1), (2, 4)]
        assert len({r[2] for r in found}) == 1


def session(master, named=None, programmed=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: programmed)
    return SimpleNamespace(conf={"spark.checkpoint.dir": named} if named else {}, sparkContext=context)


def test_shared_folder():
    assert shared_folder(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_folder(session("yarn", None, "hdfs:///set")) == "hdfs:///set"
    assert shared_folder(session("local[2]", "/named")) == "/named"
    assert shared_folder(session("local[2]")).split("/")[-1].startswith("twohop-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_arrays_cut_by_the_other_end(edges_of, monkeypatch):
    """Nodes whose arrays are cut into many slices, and pairs that ask many slices of rows: the same pairs."""
    monkeypatch.setattr(strongest, "REACH", 5)
    rows = graph(7, False)
    found = [tuple(r) for r in jaccard(edges_of(rows), 20, exact_orientation=False, tuning=Tuning(slice_rows=2, light_fan_out=9)).collect()]
    everything = jaccard(edges_of(rows), exact_orientation=False).collect()
    assert found == naive.best({(r["u"], r["v"]): r["score"] for r in everything}, 20)


def test_wedges_fall_with_k(spark, monkeypatch):
    """Communities of growing size: the smaller k, the higher the floor, and the fewer elements the lists hand out."""
    made = []
    partners = strongest.light_partners

    def counted(lists, measure, floor, share=1):
        found = partners(lists, measure, floor, share)
        if share == 1 and floor:
            made.append((floor.score, found.selectExpr("sum(size(partners)) AS n").first()["n"]))
        return found

    monkeypatch.setattr(strongest, "light_partners", counted)
    monkeypatch.setattr(strongest, "SHARE", 1)  # the exact floor
    members = spark.range(4, 40).selectExpr("id AS c", "explode(sequence(0L, id - 1)) AS i")
    edges = members.join(members.withColumnRenamed("i", "j"), "c").where("(i + j) % 2 = 1").selectExpr("c * 1000 + i AS src", "c * 1000 + j AS dst")
    for k in (10, 200, 2_000):
        found = common_neighbors(edges, k).collect()
        assert len(found) == k and found[0]["score"] == 20
    floors, sizes = zip(*made, strict=True)
    assert floors[0] > floors[1] > floors[2] and sizes[0] < sizes[1] < sizes[2]


def test_sums_of_given_pairs(spark, edges_of):
    rows = [(k, x) for k in range(40) for x in (1, 2, 3 + k % 5)] + [(0, 1)] * 2
    bag = edge_bag(edges_of(rows))
    asked = spark.createDataFrame([(1, 2, 40, 40), (1, 3, 40, 8), (4, 5, 8, 8)], "u long, v long, n_rows_u long, n_rows_v long")
    for size in (3, 1000):
        found = shared_sums(asked, bag, {"n": F.lit(1), "k": F.col("src")}, Tuning(slice_rows=size))
        assert sorted(tuple(r) for r in found.collect()) == [(1, 2, 42, 780), (1, 3, 10, 140)]


def test_a_written_edge_table_is_not_broadcast_by_its_file_size(spark, edges_of):
    """400,000 edges are some MB in Parquet, below the threshold, and 20 MB as a broadcast that the driver builds."""
    name = "spark.sql.sources.fileCompressionFactor"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "1.0")
        edges = spark.range(400_000).selectExpr("id % 20000 AS src", "id * 7919 % 400009 AS dst")
        bag = strongest.write_out(edge_bag(edges), "bag")
        known = bag.select("src", "dst").where("src < dst")
        pairs = bag.selectExpr("dst AS u", "src AS v")
        strongest.strongest_links(strongest.write_out(edge_bag(edges_of([(0, 1), (0, 2), (1, 0), (2, 0)])), "small"), "jaccard", 1).collect()
        assert "BroadcastExchange" not in strongest.non_edges(pairs, known)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)


def test_runs_leave_their_array_without_it(spark):
    """What is joined to the pairs may be moved below their counting; rows that carried the array of their node filled the memory there."""
    met = spark.createDataFrame([(1, 0, 1, [5, 7, 9]), (1, 0, 2, [5, 9]), (1, 0, 1, [9]), (2, 0, 1, [3])], "u bigint, slice bigint, need int, partners array<bigint>")
    found = strongest._runs(met, 1)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 5, 2), (1, 9, 3), (2, 3, 1)]
    known = spark.createDataFrame([(1, 5)], "src bigint, dst bigint")
    pairs = strongest.non_edges(found, known)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "held" not in plan.split("Generate")[0]
    assert sorted(tuple(r) for r in pairs.collect()) == [(1, 9, 3), (2, 3, 1)]


def test_too_short_runs(spark):
    met = spark.createDataFrame([(1, 0, 3, [5, 7]), (1, 0, 3, [5]), (2, 0, 5, [3])], "u bigint, slice bigint, need int, partners array<bigint>")
    assert strongest._runs(met, 1).collect() == []


@pytest.mark.parametrize("name", MEASURES)
def test_without_hubs_many_wedges_are_all_formed(edges_of, monkeypatch, name):
    """The phases moved each edge some twenty times, and asked for every source of every kept pair."""
    monkeypatch.setattr(measures, "strongest_links", None)
    rows = graph(5, False)
    tuning = Tuning(slice_rows=3, light_fan_out=4, part_wedges=50)
    found = MEASURES[name](edges_of(rows), 12, tuning=tuning).collect()
    every = MEASURES[name](edges_of(rows)).collect()
    assert [tuple(r) for r in found] == naive.best({(r["u"], r["v"]): r["score"] for r in every}, 12)


def test_hubs_and_few_wedges_are_left_to_the_phases():
    known = measures.WedgeTotals(wedges=4e6, rows=100_000, most_targets=500)
    assert measures.form_all(known, Tuning())
    assert not measures.form_all(known, Tuning(part_wedges=4_000_000))
    assert not measures.form_all(known, Tuning(edge_wedges=39))
