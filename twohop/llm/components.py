"""Connected components of a link table that no machine holds: alternating large and small stars.

A node may have a large share of all links. Its smallest neighbour is joined to them in a way that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twohop.operators.nodes import attach
from twohop.store import write_out


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or the node)."""
    both = links.union(links.select(F.col("low").alias("high"), F.col("high").alias("low"))).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("node", "least"))
    met = attach(both.where("other > node"), "node", least, {"least": "least"})
    return met.select(F.col("other").alias("high"), F.col("least").alias("low")).where("high > low").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    met = attach(links, "high", least.withColumnRenamed("high", "node"), {"least": "least"}).select(F.col("low").alias("high"), F.col("least").alias("low")).where("high > low")
    return met.union(least.select("high", F.col("least").alias("low"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component``: the smallest node that it is linked with, for every node with a link; null ends link nothing.

    Rounds are written to the shared folder, so each starts from files. It ends when all links lead straight to smallest
    nodes; the number of rounds grows with the logarithm of the longest path.
    """
    ends = links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"), (F.col(a).isNotNull() & F.col(b).isNotNull()).alias("ok"))
    now = write_out(ends.where("ok and high > low").select("high", "low").distinct(), "links")
    while True:
        # Done if every larger node has one link and no smaller node is itself the larger one of a link.
        many = now.groupBy("high").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1)
        deep = now.join(now.select(F.col("high").alias("low")), "low", "left_semi").limit(1)
        if not many.count() and not deep.count():
            break
        now = write_out(_small_star(_large_star(now)), "links")
    return now.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        now.select("low", "low").distinct()
    )
