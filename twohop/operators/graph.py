"""Edge tables: bag form, degrees, and the jobs that bring a graph to the undirected contract.

An edge table has ``src`` and ``dst`` and is a bag: equal rows count again. It may carry ``copies``,
the number of equal rows one row stands for, so that a heavily repeated edge stays one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twohop.store import write_out


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` in memory, spilling to disk, for the length of the block."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def copies_of(edges: DataFrame) -> Column:
    return F.col("copies") if "copies" in edges.columns else F.lit(1).cast("bigint")


def whole_edges(edges: DataFrame) -> DataFrame:
    """A row lacking an id is no edge, wherever edges are read."""
    return edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def folded(edges: DataFrame) -> DataFrame:
    """``edges``, of which the caller knows that no edge has two rows, so that they are not folded a second time."""
    edges._folded = True
    return edges


def edge_bag(edges: DataFrame) -> DataFrame:
    """Equal rows folded into one: ``(src, dst, copies)``, unless they are known to be."""
    if getattr(edges, "_folded", False):
        return folded(whole_edges(edges).select("src", "dst", copies_of(edges).alias("copies")))
    return shuffled_bag(edges)


def shuffled_bag(edges: DataFrame) -> DataFrame:
    """The same, folded in any case. Folding starts before the shuffle.

    Every use of the bag has the same filter on ids, and so the same shuffle to share.
    """
    return whole_edges(edges).groupBy("src", "dst").agg(F.sum(copies_of(edges)).alias("copies"))


def written_bag(edges: DataFrame) -> DataFrame:
    """The bag of ``edges`` as a table, written unless it is one already."""
    if getattr(edges, "_written", False):
        return edges
    bag = folded(write_out(edge_bag(edges), "bag"))
    bag._written = True
    return bag


def degrees(edges: DataFrame) -> DataFrame:
    """Edge rows per source as ``(node, degree)``."""
    return whole_edges(edges).groupBy(F.col("src").alias("node")).agg(F.sum(copies_of(edges)).alias("degree"))


def symmetrize(edges: DataFrame) -> DataFrame:
    """The distinct edges together with their reverses."""
    whole = whole_edges(edges)
    return whole.select("src", "dst").union(whole.select("dst", "src")).distinct()


def simple_graph(edges: DataFrame) -> DataFrame:
    """The distinct edges without self-loops."""
    return edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct()


def contract_report(edges: DataFrame) -> DataFrame:
    """How far a bag of edges is from a simple undirected graph, as one row.

    ``edge_rows``, ``distinct_edges``, ``duplicate_rows`` (rows beyond the first of their kind),
    ``loop_rows``, and ``asymmetric_rows`` (rows whose reverse is nowhere in the table).
    """
    bag = edge_bag(edges)
    forward = F.col("src") <= F.col("dst")
    # Both directions of a link meet in one row, so no self-join is needed to see a missing reverse.
    links = bag.groupBy(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).agg(
        F.sum(F.when(forward, F.col("copies"))).alias("forward"),
        F.sum(F.when(~forward, F.col("copies"))).alias("backward"),
        F.count(F.lit(1)).alias("kinds"),
    )
    rows = F.coalesce("forward", F.lit(0)) + F.coalesce("backward", F.lit(0))
    loop = F.col("u") == F.col("v")

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")

    return links.select(rows.alias("rows"), "kinds", loop.alias("loop")).agg(
        total(F.col("rows")).alias("edge_rows"),
        total(F.col("kinds")).alias("distinct_edges"),
        total(F.col("rows") - F.col("kinds")).alias("duplicate_rows"),
        total(F.when(F.col("loop"), F.col("rows"))).alias("loop_rows"),
        total(F.when(~F.col("loop") & (F.col("kinds") == 1), F.col("rows"))).alias("asymmetric_rows"),
    )
