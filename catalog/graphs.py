"""Graphs and text lines derived from the given tables.

``co_returned``: parts that share an order and a return flag, both directions (undirected, with triangles, no
loops), over all ordered lines; the bag form counts how often two parts meet. ``supply``: customer to supplier of every ordered
line, the ids read as one numbering (directed, with duplicates and loops).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twohop.operators import folded, two_hop_pairs
from twohop.sources import edge_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge_table(_table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


def co_returned_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Order and flag as one number, different for different pairs: a flag is one character, below 2^21.
    together = F.shiftleft("l_orderkey", 21) + F.ascii("l_returnflag")
    lines = _table(spark, sf_dir, "lineitem").withColumn("together", together)
    # It is the shared neighbour of its parts, so a very long order is sliced like any hub.
    met = two_hop_pairs(edge_table(lines, "together", "l_partkey"), "ne")
    return folded(met.select(F.col("u").alias("src"), F.col("v").alias("dst"), F.col("instances").alias("copies")))


def co_returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pair of parts is one row of the bag, and a row each way round: nothing is left to fold.
    return folded(co_returned_bag(spark, sf_dir).select("src", "dst"))


def supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders")
    met = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return edge_table(met, "o_custkey", "l_suppkey")


def co_returned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``co_returned`` as an edge-list text: two comment lines, then an edge and a blank per line."""
    edges = co_returned(spark, sf_dir)
    lines = edges.select(F.concat(F.col("src").cast("string"), F.lit(" "), F.col("dst").cast("string"), F.lit(" ")).alias("value"))
    head = spark.createDataFrame([("# parts of one order and flag",), ("# both directions",)], "value string")
    return head.union(lines)


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as lines of a careless edge list: good, commented or malformed by event type."""
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    kind = F.col("event_type")
    value = (
        F.when(kind == "view", F.concat(user, F.lit(" "), event, F.lit(" ")))
        .when(kind == "purchase", F.concat(F.lit(" "), user, F.lit("\t"), event, F.lit(" "), "props"))
        .when(kind == "signup", F.concat(user, F.lit(" "), event, F.lit(" # "), kind))
        .when(kind == "click", F.concat(user, F.lit(" "), kind))
        .when(kind == "error", F.concat(kind, F.lit(" "), user))
        .otherwise(user)
    )
    return _table(spark, sf_dir, "events").select(value.alias("value"))
