"""The wedge self-join: all pairs of targets that one source links.

A source with n targets yields n(n-1)/2 pairs. One with up to ``slice_rows`` targets is one join group, and both
sides of that join are the same rows under the same key, so one shuffle serves both. The rows of a larger source (a
hub) are cut into slices by a hash of the target, and each two slices (and each slice with itself) form one
group. The groups of a hub are spread over all tasks and none grows with the hub. A row comes into a group as its
left or its right side, so two slices meet once: only within a slice are two rows compared both ways round.

What is added up by pair travels as lists: with ``parts`` given, a target meets the others of its source as one array, the arrays
are dealt out by u, and become rows only there. So a wedge is shuffled as 2 to 4 bytes (and 1 with the degree of v, more where it is above 255) and not as a
row, and what groups by u or by (u, v) next needs no shuffle of its own. Without hubs, and with more than one part, the lists come from one shuffle of the edges by source.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twohop.functions import inverse_log_weight
from twohop.operators.graph import edge_bag, shuffled_bag
from twohop.operators.nodes import attach, source_nodes
from twohop.store import sizes_in_memory
from twohop.tuning import DEFAULT, Tuning


#: Bits of an id that a list holds for each of its targets, and of what it holds besides where its targets differ in them.
LOW_BITS, MID_BITS, TOP_BITS = 16, 8, 8
#: Bits of a degree that a list holds for each of its targets; the rest only where one has more.
END_BITS = 8


def source_rows(bag: DataFrame, names: list[str], nodes: DataFrame | None = None) -> DataFrame:
    """Bag rows with columns of their source: any of ``degree``, ``weight``, ``fan_out``, ``peak``; ``nodes``: them, if at hand."""
    nodes = source_nodes(bag) if nodes is None else nodes
    if "weight" in names:
        nodes = nodes.withColumn("weight", inverse_log_weight(F.col("degree")))
    return attach(bag, "src", nodes, {name: name for name in names})


def linking_rows(rows: DataFrame) -> DataFrame:
    """Without sources that have a single target: they link no two nodes."""
    return rows.where(F.col("fan_out") > 1)


def hub_sides(rows: DataFrame, slice_rows: int, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """The two sides of the join groups of hubs: ``rows`` with ``fan_out``, once per group of their source and side.

    The group of slices i <= j has slice i on its left and slice j on its right, so each two slices have one group.
    """
    zero, slices = F.lit(0).cast("bigint"), F.ceil(F.col("fan_out") / F.lit(slice_rows))
    cut = rows.select("*", slices.alias("_slices")).select("*", F.pmod(F.xxhash64("dst"), F.col("_slices")).alias("slice"))

    def side(own: str, other: str, first: Column, last: Column) -> DataFrame:
        met = cut.select("*", F.explode(F.sequence(first, last)).alias(other))
        return met.select(F.col("src").alias("k"), F.col("slice").alias(own), other, F.col("dst").alias("x"), "copies", *columns)

    left = side("slice_a", "slice_b", F.col("slice"), F.col("_slices") - 1)
    return left, side("slice_b", "slice_a", zero, F.col("slice"))


def _keeping(own: Column, other: Column) -> Column:
    """Always true, of columns of both sides of a join. Where the caller needs no copies or degrees, the optimizer would leave them out on
    one side or in one branch alone, and what both read from one shuffle would be shuffled twice, with the edges below it."""
    return F.coalesce(own, F.lit((1 << 63) - 1)) >= F.coalesce(F.least(own, other), F.lit(0))


def _met(left: DataFrame, right: DataFrame, key: list[str], test: Column, shared: list[str], ends: list[str]) -> DataFrame:
    """Rows of ``left`` (as ``a``) and ``right`` (``b``) with the same key for which ``test`` holds, as ``(k, u, v, copies)`` with u < v."""
    same_key = F.lit(True)
    for name in key:
        same_key = same_key & (F.col(f"a.{name}") == F.col(f"b.{name}"))
    ax, bx = F.col("a.x"), F.col("b.x")
    picked = []
    for name in ends:
        mine, other = F.col(f"a.{name}"), F.col(f"b.{name}")
        picked.append(F.when(ax < bx, mine).otherwise(other).alias(f"{name}_u"))
        picked.append(F.when(ax < bx, other).otherwise(mine).alias(f"{name}_v"))
    return left.alias("a").join(right.alias("b"), same_key & test).select(
        F.col("a.k").alias("k"),
        F.least(ax, bx).alias("u"),
        F.greatest(ax, bx).alias("v"),
        (F.col("a.copies") * F.col("b.copies")).alias("copies"),
        *[F.col(f"a.{name}").alias(name) for name in shared],
        *picked,
    )


def linked_pairs(rows: DataFrame, slice_rows: int, shared: list[str], ends: list[str], groups: int | None = None) -> DataFrame:
    """``(k, u, v, copies)`` with u < v, each pair of targets once per source; ``rows`` have ``fan_out``.

    ``shared`` are columns that depend on the source only; they join the key, which keeps both sides
    of the join the same. ``ends`` are columns of the target, returned as ``<name>_u``, ``<name>_v``. ``groups``: the
    sources that are no hubs are dealt into so many parts, instead of as many as the session has for any shuffle.
    """
    ordered = F.col("a.x") < F.col("b.x")
    # The fan-out is in the key, so that the rows are dealt out anew: adaptive execution may then split the join before.
    key = ["k", *dict.fromkeys(["fan_out", *shared])]
    few = rows.where(F.col("fan_out") <= slice_rows).select(
        F.col("src").alias("k"), F.col("dst").alias("x"), "copies", *key[1:], *ends
    )
    if groups:
        few = few.repartition(groups, *key)
    small = _met(few, few, key, ordered, shared, ends)
    return small.union(sliced_pairs(rows.where(F.col("fan_out") > slice_rows), slice_rows, shared, ends))


def sliced_pairs(rows: DataFrame, slice_rows: int, shared: list[str], ends: list[str]) -> DataFrame:
    """The same of hubs alone."""
    ordered = F.col("a.x") < F.col("b.x")
    left, right = hub_sides(rows, slice_rows, [*shared, *ends])
    test = ~(F.col("a.slice_a") == F.col("b.slice_b")) | ordered
    for name in ("copies", *ends):
        test = test & _keeping(F.col(f"a.{name}"), F.col(f"b.{name}"))
    return _met(left, right, ["k", "slice_a", "slice_b"], test, shared, ends)


@dataclass(frozen=True)
class WedgeTotals:
    """Of a bag: its wedges u < v without copies, its rows, and the different targets of its largest source."""

    wedges: float
    rows: int
    most_targets: int


def wedge_totals(edges: DataFrame) -> WedgeTotals:
    """Counted once for an edge table that is used several times. One row reaches the driver."""
    if getattr(edges, "_totals", None) is None:
        fan_out = F.col("fan_out").cast("double")
        found = source_nodes(edge_bag(edges)).agg(F.sum(fan_out * (fan_out - 1) / 2), F.sum("fan_out"), F.max("fan_out")).first()
        edges._totals = WedgeTotals(found[0] or 0.0, int(found[1] or 0), int(found[2] or 0))
    return edges._totals


def pair_parts(edges: DataFrame, tuning: Tuning = DEFAULT) -> int:
    """Into how many parts the wedges of these edges are dealt by u, so that none grows with the input. One row reaches the driver."""
    return dealt_parts(edges.sparkSession, wedge_totals(edges).wedges, tuning)


def dealt_parts(spark: SparkSession, found: float, tuning: Tuning) -> int:
    return max(ceil(found / tuning.part_wedges), min(spark.sparkContext.defaultParallelism, ceil(found / 100_000)), 1)


def _as_rows(lists: DataFrame, parts: int, names: list[str], ends: list[str]) -> DataFrame:
    """Lists dealt out by u, a row per partner."""
    # A join on (u, v) may then use that u alone decides the part, instead of dealing all pairs out again.
    spark = lists.sparkSession
    sizes_in_memory(spark)
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    met = lists.repartition(parts, "u").select("*", F.posexplode("partners").alias("_at", "_low"))

    def element(name: str) -> Column:
        return F.get(name, F.col("_at"))

    def bits(value: Column, n: int) -> Column:
        return value.cast("bigint").bitwiseAND(F.lit((1 << n) - 1).cast("bigint"))

    v = F.coalesce(element("highs"), F.col("high"))
    v = F.shiftleft(v, TOP_BITS).bitwiseOR(bits(F.coalesce(element("tops"), F.col("top")), TOP_BITS))
    v = F.shiftleft(v, MID_BITS).bitwiseOR(bits(F.coalesce(element("mids"), F.col("mid")), MID_BITS))
    v = F.shiftleft(v, LOW_BITS).bitwiseOR(bits(F.col("_low"), LOW_BITS))
    copies = F.col("copies") * F.coalesce(element("partner_copies"), F.lit(1).cast("bigint"))

    def end_of_partner(name: str) -> Column:
        more = F.coalesce(element(f"more_{name}"), F.lit(0).cast("bigint"))
        return F.shiftleft(more, END_BITS).bitwiseOR(bits(element(f"partner_{name}"), END_BITS))

    return met.select(
        "k", "u", v.alias("v"), copies.alias("copies"), *names,
        *[c for e in ends for c in (F.col(e).alias(f"{e}_u"), end_of_partner(e).alias(f"{e}_v"))],
    ).where(F.col("u") != F.col("v"))


def _signed(bits: Column, n: int) -> Column:
    """The same n bits as a signed number, which every mode of casting takes."""
    return F.shiftright(F.shiftleft(bits, 64 - n), 64 - n)


def _low(node: Column) -> Column:
    return _signed(node, LOW_BITS).cast("smallint")


def _mid(node: Column) -> Column:
    return _signed(F.shiftright(node, LOW_BITS), MID_BITS).cast("tinyint")


def _top(node: Column) -> Column:
    return _signed(F.shiftright(node, LOW_BITS + MID_BITS), TOP_BITS).cast("tinyint")


def _high(node: Column) -> Column:
    return F.shiftright(node, LOW_BITS + MID_BITS + TOP_BITS)


#: What a list says of the ids of its partners, and how it is found.
_OF_ID = {"low": _low, "mid": _mid, "top": _top, "high": _high}


def _end_low(end: Column) -> Column:
    return _signed(end, END_BITS).cast("tinyint")


def _end_more(ends: Column) -> Column:
    """Of the degrees of a list: what is above their low bits, if anything is."""
    return F.when((F.array_max(ends) >= 1 << END_BITS) | (F.array_min(ends) < 0), F.transform(ends, lambda e: F.shiftright(e, END_BITS)))


def _target(x: Column, ends: list[str]) -> Column:
    """A target in its list, which is in order of ids."""
    return F.struct(x.alias("x"), "copies", *ends, *[of(x).alias(name) for name, of in _OF_ID.items()], *[_end_low(F.col(e)).alias(f"low_{e}") for e in ends])


def _packed(ends: list[str]) -> list[Column]:
    """``targets`` of a list as narrow as they allow: ``xs``, ``lows``, and of the other bits of their ids each kind once (``mid``) or, where they
    differ, for each target (``mids``); copies only where one is above 1."""
    fields = {name: F.col("targets").getField(name) for name in ("x", "copies", *_OF_ID, *ends, *[f"low_{e}" for e in ends])}
    packed = [fields["x"].alias("xs"), fields["low"].alias("lows")]
    for name in ("mid", "top", "high"):
        packed.append(F.element_at(fields[name], 1).alias(name))
        packed.append(F.when(F.array_min(fields[name]) < F.array_max(fields[name]), fields[name]).alias(f"{name}s"))
    packed.append(F.when(F.array_max(fields["copies"]) > 1, fields["copies"]).alias("partner_copies"))
    for e in ends:
        packed += [fields[f"low_{e}"].alias(f"partner_{e}"), _end_more(fields[e]).alias(f"more_{e}")]
    return packed


def _of_partners(ends: list[str]) -> list[str]:
    return ["mids", "tops", "highs", "partner_copies", *[f"{kind}_{e}" for e in ends for kind in ("partner", "more")]]


def gathered_lists(bag: DataFrame, shared: list[str], ends: list[str], parts: int, keep: str = "lt") -> DataFrame:
    """:func:`gathered_pairs` of a bag (with ``ends``) without hubs: one shuffle by source makes the lists, from which a source's columns come too."""
    few = bag.repartition(max(ceil(parts / 8), min(parts, bag.sparkSession.sparkContext.defaultParallelism)), "src")
    lists = few.groupBy("src").agg(F.sort_array(F.collect_list(_target(F.col("dst"), ends))).alias("targets"), F.sum("copies").alias("degree"))
    of_source = {"degree": F.col("degree"), "weight": inverse_log_weight(F.col("degree"))}
    lists = lists.where(F.size("targets") > 1).select(
        F.col("src").alias("k"), *[of_source[name].alias(name) for name in shared], *_packed(ends),
        F.col("targets").getField("copies").alias("own_copies"), *[F.col("targets").getField(e).alias(f"own_{e}") for e in ends],
    )
    met = lists.select("*", F.posexplode("xs").alias("at", "u"))
    if keep == "lt":
        met = met.where(F.col("at") < F.size("lows") - 1)

    def of_partners(name: str) -> Column:
        return F.col(name) if keep == "ne" else F.slice(name, F.col("at") + 2, F.size("lows"))

    met = met.select(
        "k", "u", F.get("own_copies", F.col("at")).alias("copies"), *shared, *[F.get(f"own_{e}", F.col("at")).alias(e) for e in ends],
        of_partners("lows").alias("partners"), "mid", "top", "high", *[of_partners(name).alias(name) for name in _of_partners(ends)],
    )
    return _as_rows(met, parts, shared, ends)


def gathered_pairs(rows: DataFrame, tuning: Tuning, shared: list[str], ends: list[str], parts: int, keep: str = "lt") -> DataFrame:
    """:func:`linked_pairs` in ``parts`` parts by u; ``keep="ne"``: in both orders.

    What a list says of its partners is as narrow as the list allows, see :func:`_packed`.
    """
    small, slice_rows = F.col("fan_out") <= tuning.slice_rows, tuning.slice_rows
    key = ["k", *dict.fromkeys(["fan_out", *shared])]
    few = rows.where(small).select(F.col("src").alias("k"), F.col("dst").alias("u"), "copies", *key[1:], *ends)
    few = few.repartition(max(ceil(parts / 8), min(parts, few.sparkSession.sparkContext.defaultParallelism)), *key)  # for both sides
    lists = few.groupBy(*key).agg(F.sort_array(F.collect_list(_target(F.col("u"), ends))).alias("targets"))
    least = {name: F.array_min(F.col("targets").getField(name)).alias(f"least_{name}") for name in ("copies", *ends)}
    lists = lists.select(*key, *_packed(ends), *least.values())
    met, place = few.join(lists, key), F.array_position("xs", F.col("u"))
    for name in least:
        met = met.where(_keeping(F.col(name), F.col(f"least_{name}")))
    if keep == "lt":
        met = met.where(place < F.size("lows"))

    def of_partners(name: str) -> Column:
        return F.col(name) if keep == "ne" else F.slice(name, place.cast("int") + 1, F.size("lows"))

    met = met.select(
        "k", "u", "copies", *shared, *ends,
        of_partners("lows").alias("partners"), "mid", "top", "high", *[of_partners(name).alias(name) for name in _of_partners(ends)],
    )
    # The pairs of a hub are found row by row, each a list of one.
    of_hubs = sliced_pairs(rows.where(~small), slice_rows, shared, ends)
    if keep == "ne":
        flip = {"u": "v", "v": "u"} | {f"{end}_{a}": f"{end}_{b}" for end in ends for a, b in ("uv", "vu")}
        of_hubs = of_hubs.select(F.inline(F.array(F.struct("*"), F.struct(*[F.col(flip.get(c, c)).alias(c) for c in of_hubs.columns]))))
    longs, bytes_ = "array<bigint>", "array<tinyint>"
    of_hubs = of_hubs.select(
        "k", "u", "copies", *shared, *[F.col(f"{end}_u").alias(end) for end in ends],
        F.array(_low(F.col("v"))).alias("partners"), *[_OF_ID[name](F.col("v")).alias(name) for name in ("mid", "top", "high")],
        *[F.lit(None).cast(kind).alias(name) for name, kind in (("mids", bytes_), ("tops", bytes_), ("highs", longs), ("partner_copies", longs))],
        *[c for e in ends for c in (F.array(_end_low(F.col(f"{e}_v"))).alias(f"partner_{e}"), _end_more(F.array(f"{e}_v")).alias(f"more_{e}"))],
    )
    return _as_rows(met.union(of_hubs), parts, shared, ends)


def both_orders(pairs: DataFrame) -> DataFrame:
    """Every row also with u and v exchanged. Add up first: that halves what is shuffled."""
    flip = {"u": "v", "v": "u", "degree_u": "degree_v", "degree_v": "degree_u"}
    as_is, turned = F.struct("*"), F.struct(*[F.col(flip.get(c, c)).alias(c) for c in pairs.columns])
    return pairs.select(F.inline(F.array(as_is, turned)))


def wedges(
    edges: DataFrame,
    keep: str = "lt",
    degree: bool = False,
    weight: bool = False,
    end_degrees: bool = False,
    tuning: Tuning = DEFAULT,
    parts: int | None = None,
    groups: int | None = None,
) -> DataFrame:
    """Wedges of an edge table: ``(k, u, v, copies)``, ``copies`` being how often the wedge occurs.

    ``keep``: ``lt`` each pair once with u < v; ``ne`` both orders; ``all`` also u = v.
    ``degree`` / ``weight`` add the degree of k or its Adamic/Adar weight, ``end_degrees`` the degrees
    ``degree_u`` and ``degree_v`` of the pair (NULL where the node has no outgoing edge). ``parts``: dealt out by u
    into so many parts (see :func:`pair_parts`), for ``lt`` and ``ne``. ``groups``: dealt out by k into so many, without ``parts``.
    """
    if keep not in ("lt", "ne", "all"):
        raise ValueError(f"keep must be 'lt', 'ne' or 'all', not {keep!r}")
    shared = [name for name, wanted in (("degree", degree), ("weight", weight)) if wanted]
    if parts and parts > 1 and keep != "all" and wedge_totals(edges).most_targets <= tuning.slice_rows:
        bag = edge_bag(edges)
        rows = attach(bag, "dst", source_nodes(bag), {"degree": "end_degree"}) if end_degrees else bag
        found = gathered_lists(rows, shared, ["end_degree"] if end_degrees else [], parts, keep)
        return found.withColumnsRenamed({"end_degree_u": "degree_u", "end_degree_v": "degree_v"})
    bag = shuffled_bag(edges)
    rows = source_rows(bag, [*shared, "fan_out"])
    linking = linking_rows(rows)
    ends = []
    if end_degrees:
        linking = attach(linking, "dst", source_nodes(bag), {"degree": "end_degree"})
        ends.append("end_degree")
    if parts and keep != "all":
        found = gathered_pairs(linking, tuning, shared, ends, parts, keep)
    else:
        found = linked_pairs(linking, tuning.slice_rows, shared, ends, groups)
    if end_degrees:
        found = found.withColumnsRenamed({"end_degree_u": "degree_u", "end_degree_v": "degree_v"})
    if keep == "lt" or (parts and keep == "ne"):
        return found
    both = both_orders(found)
    if keep == "ne":
        return both
    if end_degrees:
        raise ValueError("end_degrees needs keep='lt' or 'ne'")
    return both.union(
        rows.select(
            F.col("src").alias("k"),
            F.col("dst").alias("u"),
            F.col("dst").alias("v"),
            (F.col("copies") * F.col("copies")).alias("copies"),
            *shared,
        )
    )


def two_hop_pairs(edges: DataFrame, keep: str = "lt", tuning: Tuning = DEFAULT, parts: int | None = None) -> DataFrame:
    """Pairs that share a neighbour, connected or not, as ``(u, v, instances)``; ``keep`` and ``parts`` as in :func:`wedges`."""
    if parts:
        return wedges(edges, keep, tuning=tuning, parts=parts).groupBy("u", "v").agg(F.sum("copies").alias("instances"))
    found = wedges(edges, "lt" if keep == "ne" else keep, tuning=tuning)
    pairs = found.groupBy("u", "v").agg(F.sum("copies").alias("instances"))
    return both_orders(pairs) if keep == "ne" else pairs


def middle_weights(edges: DataFrame, tuning: Tuning = DEFAULT) -> DataFrame:
    """The degrees of the shared neighbours of each pair, as a multiset: ``(u, v, degree, shared)``.

    A pair with very many shared neighbours is many small rows here, never one long list.
    """
    found = wedges(edges, degree=True, tuning=tuning, parts=pair_parts(edges, tuning))
    return found.groupBy("u", "v", "degree").agg(F.sum("copies").alias("shared"))
