from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from twohop import Tuning
from twohop.operators import (
    attach,
    cached,
    candidate_semi,
    contract_report,
    degrees,
    distinct_pairs,
    edge_bag,
    endpoint_degrees,
    folded,
    middle_weights,
    non_edges,
    pair_degree_sum,
    pairs,
    ranked,
    simple_graph,
    symmetrize,
    top_k,
    two_hop_pairs,
    wedges,
    with_label,
    written_bag,
)
from twohop.operators.wedges import hub_sides, linked_pairs, source_rows

SALT = [(i % 7, i % 11) for i in range(200)]


def bag(df, *columns):
    return Counter({tuple(r[c] for c in columns): r["copies"] for r in df.collect()})


@pytest.mark.parametrize("slice_rows", [1, 3, 2000])
@pytest.mark.parametrize("keep", ["lt", "ne", "all"])
def test_wedges_at_any_slice_size(edges_of, keep, slice_rows):
    test = {"lt": lambda x, y: x < y, "ne": lambda x, y: x != y, "all": lambda x, y: True}[keep]
    expected = Counter((k, x, y) for k, x in SALT for j, y in SALT if k == j and test(x, y))
    found = wedges(edges_of(SALT), keep, tuning=Tuning(slice_rows=slice_rows))
    assert bag(found, "k", "u", "v") == expected
    if keep == "lt":
        assert found.agg(F.sum("copies")).first()[0] == 2589


def test_slices_of_a_hub_meet_once(edges_of):
    n, size = 4_000, 250
    rows = source_rows(edge_bag(edges_of([(0, i) for i in range(1, n + 1)])), ["fan_out"])
    left, right = hub_sides(rows, size, [])
    key = ["k", "slice_a", "slice_b"]
    held = left.groupBy(key).agg(F.count("x").alias("a")).join(right.groupBy(key).agg(F.count("x").alias("b")), key)
    groups, compared, largest = held.agg(F.count("a"), F.sum(F.col("a") * F.col("b")), F.max(F.greatest("a", "b"))).first()
    slices = n // size
    assert groups == slices * (slices + 1) // 2 and largest < 2 * size
    # n * (n - 1) / 2 pairs, and within a slice both ways round. With both sides in both roles it was 2 n * n.
    assert compared < 0.6 * n * n
    assert linked_pairs(rows, size, [], []).count() == n * (n - 1) // 2


def test_wedge_columns(edges_of):
    edges = edges_of(SALT)
    degree = Counter(k for k, _ in SALT)
    for r in wedges(edges, degree=True, end_degrees=True, tuning=Tuning(slice_rows=2)).collect():
        assert r["degree"] == degree[r["k"]]
        assert r["degree_u"] == (degree[r["u"]] or None)
        assert r["degree_v"] == (degree[r["v"]] or None)
    for r in wedges(edges, "ne", end_degrees=True).collect():
        assert r["degree_u"] == (degree[r["u"]] or None)
    with pytest.raises(ValueError):
        wedges(edges, "gt")
    with pytest.raises(ValueError):
        wedges(edges, "all", end_degrees=True)


def test_non_edges_keeps_repeated_rows(spark, edges_of):
    pairs = spark.createDataFrame([(1, 2), (1, 2), (1, 3), (1, 3)], "u bigint, v bigint")
    kept = non_edges(pairs, edges_of([(1, 2), (3, 1)]))
    assert [tuple(r) for r in kept.collect()] == [(1, 3), (1, 3)]


def test_degrees_count_rows(edges_of):
    found = {r["node"]: r["degree"] for r in degrees(edges_of([(1, 2), (1, 2), (1, 1), (2, 1)])).collect()}
    assert found == {1: 3, 2: 1}


def test_endpoint_degrees_and_their_sum(edges_of):
    edges = edges_of([(1, 2), (1, 3), (3, 2), (2, 1), (3, 1)])
    assert [tuple(r) for r in endpoint_degrees(edges).collect()] == [(2, 3, 1)]
    assert [tuple(r) for r in pair_degree_sum(endpoint_degrees(edges)).collect()] == [(2, 3, 1)]


def test_shared_degrees_are_a_multiset(edges_of):
    edges = edges_of([(9, 1), (9, 2), (8, 1), (8, 2), (7, 1), (7, 2), (7, 3)])
    rows = {(r["u"], r["v"], r["degree"]): r["shared"] for r in middle_weights(edges).collect()}
    assert rows == {(1, 2, 2): 2, (1, 2, 3): 1, (1, 3, 3): 1, (2, 3, 3): 1}


def test_pair_operators(spark, edges_of):
    edges = edges_of([(9, 1), (9, 2), (8, 1), (8, 2)])
    pairs = distinct_pairs(wedges(edges))
    assert [tuple(r) for r in pairs.collect()] == [(1, 2)]
    assert [tuple(r) for r in two_hop_pairs(edges, "ne").orderBy("u").collect()] == [(1, 2, 2), (2, 1, 2)]
    assert candidate_semi(wedges(edges), pairs).count() == 2
    assert candidate_semi(wedges(edges), pairs.where("u > 1")).count() == 0
    assert [r["label"] for r in with_label(pairs).collect()] == ["1 <-> 2"]


def test_contract_jobs(edges_of):
    rows = [(1, 2), (1, 2), (2, 1), (3, 3), (3, 3), (4, 1)]
    edges = edges_of(rows)
    report = contract_report(edges).first().asDict()
    assert report == {
        "edge_rows": 6,
        "distinct_edges": 4,
        "duplicate_rows": 2,
        "loop_rows": 2,
        "asymmetric_rows": 1,
    }
    assert sorted(map(tuple, symmetrize(edges).collect())) == [(1, 2), (1, 4), (2, 1), (3, 3), (4, 1)]
    assert sorted(map(tuple, simple_graph(edges).collect())) == [(1, 2), (2, 1), (4, 1)]
    clean = contract_report(simple_graph(symmetrize(edges))).first()
    assert (clean["duplicate_rows"], clean["loop_rows"], clean["asymmetric_rows"]) == (0, 0, 0)
    empty = contract_report(edges.where("src > 100")).first().asDict()
    assert set(empty.values()) == {0}


def test_cached_lets_go(edges_of):
    edges = edges_of([(1, 2)])
    with cached(edges) as kept:
        assert kept.storageLevel.useMemory and kept.storageLevel.useDisk
    assert not edges.storageLevel.useMemory


def test_rows_without_an_id_are_no_edges(edges_of):
    edges = edges_of([(1, 2), (1, None), (None, 2), (None, None), (2, 1)])
    assert sorted(tuple(r) for r in degrees(edges).collect()) == [(1, 1), (2, 1)]
    assert sorted(tuple(r) for r in symmetrize(edges).collect()) == [(1, 2), (2, 1)]
    assert edge_bag(edges).count() == 2


def test_a_node_without_id_takes_no_part(spark, edges_of):
    nodes = spark.createDataFrame([(None, 9), (0, 1)], "node bigint, degree bigint")
    found = attach(edges_of([(0, 1), (2, 3)]), "src", nodes, {"degree": "degree"})
    assert sorted(found.collect(), key=str) == sorted([(0, 1, 1), (2, 3, None)], key=str)


def test_ranks_and_large_k(spark, monkeypatch):
    scores = spark.range(0, 500, numPartitions=7).selectExpr("id AS u", "id + 1 AS v", "cast(id % 13 AS double) AS score")
    want = sorted(((r["u"], r["v"], r["score"]) for r in scores.collect()), key=lambda r: (-r[2], r[0], r[1]))
    assert sorted((r["rank"], r["u"]) for r in ranked(scores).collect()) == [(i + 1, w[0]) for i, w in enumerate(want)]
    monkeypatch.setattr(pairs, "ONE_TASK", 10)
    for k in (0, 10, 11, 100, 500, 900):
        assert sorted(tuple(r) for r in top_k(scores, k).collect()) == sorted(want[:k])


@pytest.mark.parametrize("slice_rows", [3, 2000])
@pytest.mark.parametrize("keep", ["lt", "ne"])
def test_wedges_dealt_out_by_u_are_the_same(edges_of, keep, slice_rows):
    """Repeated edges, sources above and below the slice size, a target without edges of its own."""
    edges, tuning = edges_of([*SALT, (0, 100)]), Tuning(slice_rows=slice_rows)
    columns = ["k", "u", "v", "copies", "degree", "degree_u", "degree_v"]

    def rows(**options):
        found = wedges(edges, keep, degree=True, end_degrees=True, tuning=tuning, **options)
        return Counter(tuple(r[c] for c in columns) for r in found.collect())

    assert rows(parts=3) == rows()


def test_sums_by_pair_shuffle_lists_and_not_wedges(edges_of):
    edges = edges_of(SALT)
    plan = two_hop_pairs(edges, parts=3)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Generate posexplode")]
    assert "Exchange" not in above and "hashpartitioning(u" in plan


def test_lists_hold_low_bits_of_ids(edges_of):
    """Ids below zero, near each other and far apart, and repeated edges: the same wedges; and partners travel as ints."""
    ids = [-(2**63), -5, -1, 0, 3, 2**31 - 1, 2**31, 2**40 + 7, 2**63 - 1]
    edges = edges_of([(k, x) for k in (1, 2**50) for x in ids] + [(1, 3), (7, 5), (7, 9), (7, 5)])
    for keep in ("lt", "ne"):
        columns = ["k", "u", "v", "copies", "degree_u", "degree_v"]
        plain, dealt = (wedges(edges, keep, end_degrees=True, parts=parts) for parts in (None, 3))
        assert Counter(map(tuple, dealt.select(columns).collect())) == Counter(map(tuple, plain.select(columns).collect()))
    plan = two_hop_pairs(edges, parts=3)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Generate posexplode\(partners#\d+\).*, _low#\d+\]", plan)  # a bigint would be _low#1L


def test_what_is_left_out_of_a_result_shuffles_nothing_twice(spark, tmp_path):
    """Pairs alone ask for no copies and no degrees: the edges are folded once, and lists and rows come from one shuffle all the same."""
    path = str(tmp_path / "edges")
    spark.createDataFrame([(i % 17, (i * 7) % 23) for i in range(400)], "src bigint, dst bigint").write.parquet(path)
    edges = spark.read.parquet(path)

    def written(plan, by):
        return [x for x in plan.splitlines() if re.search(rf"Exchange hashpartitioning\({by}", x) and "ReusedExchange" not in x]

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for tuning in (Tuning(), Tuning(slice_rows=5)):
            found = distinct_pairs(wedges(edges, end_degrees=True, tuning=tuning, parts=3))
            found.collect()
            final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert len(written(final, r"src#\d+L, dst#\d+L")) <= 1  # none if all read that of a branch left out at run time
        scored = wedges(edges, degree=True, parts=3).groupBy("u", "v").agg(F.sum("degree").alias("degree_sum"))
        kept = candidate_semi(scored, non_edges(scored.where(F.col("degree_sum").isNotNull()), edges))
        kept.collect()
        final = kept._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert len(written(final, r"u#\d+L, 3\), REPARTITION")) <= 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_partners_near_each_other_travel_as_two_bytes(edges_of):
    """Ids on both sides of a change in bits 16 to 31, and in the sign of either half."""
    ids = [0, 1, 2**15 - 1, 2**15, 2**16 - 1, 2**16, 2**31 - 2**15, 2**31 + 5, 2**32 - 1, 2**32, -(2**16), -(2**16) - 1]
    edges = edges_of([(k, x) for k, own in enumerate((ids, ids[:4], ids[3:6], ids[7:])) for x in own])
    plain, dealt = (wedges(edges, parts=parts) for parts in (None, 3))
    assert Counter(map(tuple, dealt.select("k", "u", "v").collect())) == Counter(map(tuple, plain.select("k", "u", "v").collect()))
    assert "as smallint" in wedges(edges, parts=3)._jdf.queryExecution().analyzed().toString()


#: Ids that differ from bit 0, 16, 24 or 32 on, or in their sign.
FAR_IDS = [3, 4, 3 + (1 << 16), 3 + (1 << 17), 3 + (1 << 23), 3 + (1 << 24), 3 + (1 << 31), 3 + (1 << 32), (1 << 62) + 5, -7, -(1 << 40)]


@pytest.mark.parametrize("slice_rows", [4, 2_000], ids=["hubs", "lists"])
@pytest.mark.parametrize("keep", ["lt", "ne"])
def test_lists_give_back_ids_copies_and_degrees(edges_of, keep, slice_rows):
    """Ids that differ in any of their bits, no degree, and degrees of one byte and more."""
    rows = [(10, x) for x in FAR_IDS] + [(11, 3), (11, 4), (11, 3 + (1 << 16)), (12, 3), (12, -7)] * 2 + [(13, 4)]
    rows += [(3, 1000 + i) for i in range(255)] + [(4, 1000 + i) for i in range(256)] + [(-7, 5)] * 70_000
    edges, tuning = edges_of(rows), Tuning(slice_rows=slice_rows)
    of_interest = F.col("k").isin(10, 11, 12, 13)
    columns = ["k", "u", "v", "copies", "degree", "weight", "degree_u", "degree_v"]
    dealt = wedges(edges, keep, degree=True, weight=True, end_degrees=True, tuning=tuning, parts=3).where(of_interest).select(columns)
    plain = wedges(edges, keep, degree=True, weight=True, end_degrees=True, tuning=tuning).where(of_interest).select(columns)
    found = sorted(map(tuple, dealt.collect()), key=repr)
    assert found == sorted(map(tuple, plain.collect()), key=repr)
    ends = {(r[1], r[2]): r[-2:] for r in found}
    assert ends[3, 4] == (255, 256) and ends[-7, 3] == (70_000, 255)


def test_lists_without_hubs_come_from_one_shuffle_of_the_edges(spark, edges_of):
    """They took five: two to fold the edges, two to join the size of their source, one to meet."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bag = written_bag(edges_of(SALT))
        assert written_bag(bag) is bag
        found = wedges(bag, parts=3)
        assert sorted((r["u"], r["v"], r["copies"]) for r in found.collect()) == sorted(
            (r["u"], r["v"], r["copies"]) for r in wedges(edges_of(SALT)).collect()
        )
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning(src") == 1 and plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_repeated_edges_are_folded_unless_they_are_known_to_be(edges_of):
    edges = edges_of([(1, 2), (1, 2), (3, 4), (None, 4), (3, None)])
    assert sorted(map(tuple, edge_bag(edges).collect())) == [(1, 2, 2), (3, 4, 1)]
    assert sorted(map(tuple, written_bag(edges).collect())) == [(1, 2, 2), (3, 4, 1)]
    once = folded(edges_of([(1, 2), (3, 4), (None, 4)]))
    assert sorted(map(tuple, edge_bag(once).collect())) == [(1, 2, 1), (3, 4, 1)]
    assert "Exchange" not in edge_bag(once)._jdf.queryExecution().executedPlan().toString()
