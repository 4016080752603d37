"""Operations on tables of node pairs ``(u, v, ...)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twohop.functions import pair_label
from twohop.operators.wedges import pair_parts, wedges
from twohop.store import write_out
from twohop.tuning import DEFAULT, Tuning

#: Rows that one task sorts for a top k.
ONE_TASK = 1_000_000
# What a marker row says in ``links``, bit by bit: there is an edge u -> v, there is an edge v -> u.
FORWARD, BACKWARD = 1, 2


def distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select("u", "v").dropDuplicates(["u", "v"])


def non_edges(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Pairs that are no edge u -> v; rows that repeat a pair are all kept."""
    known = edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))
    return pairs.join(known, ["u", "v"], "left_anti")


def candidate_semi(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows of ``pairs`` whose pair is among the candidates."""
    return pairs.join(candidates.select("u", "v"), ["u", "v"], "left_semi")


def canonical_pairs(pairs: DataFrame) -> DataFrame:
    """Smaller id first; other columns unchanged."""
    rest = [c for c in pairs.columns if c not in ("u", "v")]
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), *rest)


def edge_markers(edges: DataFrame, reverse: bool, parts: int) -> DataFrame:
    """A row per edge between different nodes: the pair, and which direction it is. Repeated edges need
    no folding first: their rows fall together in the aggregation. They are dealt out by u into ``parts``, like the wedges they join."""
    forward = F.col("src") < F.col("dst")
    kept = edges.where(F.col("src") != F.col("dst")) if reverse else edges.where(forward)
    return kept.select(
        F.least("src", "dst").alias("u"),
        F.greatest("src", "dst").alias("v"),
        F.when(forward, FORWARD).otherwise(BACKWARD).alias("links"),
    ).repartition(parts, "u")


def endpoint_degrees(edges: DataFrame, tuning: Tuning = DEFAULT, by_pair: bool = False) -> DataFrame:
    """Ordered unconnected pairs that share a neighbour, with the degree of the first: ``(u, v, degree)``. ``by_pair``: also ``low`` and
    ``high``, the pair in order of its ids, by which the rows are dealt out."""
    parts = pair_parts(edges, tuning)
    found = wedges(edges, end_degrees=True, tuning=tuning, parts=parts)
    none, zero = F.lit(None).cast("bigint"), F.lit(0)
    found = found.select("u", "v", "degree_u", "degree_v", zero.alias("links"), F.lit(True).alias("met"))
    known = edge_markers(edges, True, parts).select("u", "v", none.alias("degree_u"), none.alias("degree_v"), "links", F.lit(False).alias("met"))
    pairs = found.union(known).groupBy("u", "v").agg(
        F.max("degree_u").alias("degree_u"), F.max("degree_v").alias("degree_v"), F.bit_or("links").alias("links"), F.max("met").alias("met")
    )
    low, high = F.col("u"), F.col("v")
    sides = [
        F.struct(first.alias("u"), second.alias("v"), F.col(degree).alias("degree"), (F.col("links").bitwiseAND(bit) == 0).alias("open"))
        for first, second, degree, bit in ((low, high, "degree_u", FORWARD), (high, low, "degree_v", BACKWARD))
    ]
    ordered = pairs.where("met").select(low.alias("low"), high.alias("high"), F.inline(F.array(*sides)))
    ordered = ordered.where(F.col("open") & F.col("degree").isNotNull())
    return ordered.select("u", "v", "degree", *(["low", "high"] if by_pair else []))


def shared_sums(pairs: DataFrame, rows: DataFrame, shares: dict[str, Column], tuning: Tuning = DEFAULT) -> DataFrame:
    """``(u, v, <sums>)`` of given pairs over all sources that both ends share: ``shares`` are columns of the source's rows
    ``(src, dst, copies, ...)``, each summed once for every wedge. Pairs have ``n_rows_u`` and ``n_rows_v``, the rows of both ends.

    A pair starts from the rows of its end with fewer. Those are cut into slices by a hash of the source, and the pair asks every slice, so
    that no join group holds more of them than a slice.
    """
    fewer = F.col("n_rows_u") <= F.col("n_rows_v")
    near, far = F.when(fewer, F.col("u")).otherwise(F.col("v")), F.when(fewer, F.col("v")).otherwise(F.col("u"))
    slices = F.greatest(F.ceil(F.least("n_rows_u", "n_rows_v") / F.lit(tuning.slice_rows)), F.lit(1))
    asking = pairs.select(near.alias("near"), far.alias("far"), slices.alias("slices"))
    asking = asking.select("near", "far", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"))
    ends = pairs.select(near.alias("near"), slices.alias("slices")).distinct()
    own = rows.select(F.col("src").alias("k"), F.col("dst").alias("near"), F.col("copies").alias("near_copies"), *[s.alias(f"share_{n}") for n, s in shares.items()])
    own = own.join(ends, "near").withColumn("slice", F.pmod(F.xxhash64("k"), F.col("slices"))).drop("slices")
    other = rows.select(F.col("src").alias("k"), F.col("dst").alias("far"), F.col("copies").alias("far_copies"))
    met = asking.join(own, ["near", "slice"]).join(other, ["k", "far"])
    copies = F.col("near_copies") * F.col("far_copies")
    return met.groupBy(F.least("near", "far").alias("u"), F.greatest("near", "far").alias("v")).agg(
        *[F.sum(F.col(f"share_{name}") * copies).alias(name) for name in shares]
    )


def pair_degree_sum(ordered: DataFrame) -> DataFrame:
    """Ordered pairs with the degree of their first node, to ``(u, v, total)``; with ``low`` and ``high`` where they already are."""
    if "low" in ordered.columns:
        sums = ordered.groupBy("low", "high").agg(F.sum("degree").alias("total"))
        return sums.select(F.col("low").alias("u"), F.col("high").alias("v"), "total")
    return canonical_pairs(ordered).groupBy("u", "v").agg(F.sum("degree").alias("total"))


def with_label(pairs: DataFrame) -> DataFrame:
    """Replace the pair columns by a ``label``."""
    rest = [c for c in pairs.columns if c not in ("u", "v")]
    return pairs.select(pair_label().alias("label"), *rest)


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("u"), F.col("v")]


def top_k(scores: DataFrame, k: int) -> DataFrame:
    """The k best scores; equal scores in order of u, v.

    Up to ``ONE_TASK`` rows meet in one task; more are taken from a distributed sort. The rows are the same.
    """
    if k < 0:
        raise ValueError(f"k must not be negative, got {k}")
    if k > ONE_TASK:
        return ranked(scores).where(F.col("rank") <= k).drop("rank")
    return scores.orderBy(*_order()).limit(k)


def ranked(scores: DataFrame) -> DataFrame:
    """All scores with their ``rank`` from 1: sorted by ranges, numbered within each, and shifted by the ranges before."""
    placed = scores.orderBy(*_order()).withColumn("place", F.monotonically_increasing_id())
    placed = write_out(placed, "sorted")
    part, position = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    shifts, before = [], 0
    for row in sorted(sizes, key=lambda r: r["part"]):  # a row per range of the sort
        shifts.append((row["part"], before))
        before += row["n"]
    table = scores.sparkSession.createDataFrame(shifts, "part bigint, shift bigint")
    numbered = placed.withColumn("part", part).join(table, "part")
    return numbered.select(*scores.columns, (F.col("shift") + position + 1).alias("rank"))
