"""Node attributes, and joining them to edge rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_nodes(bag: DataFrame) -> DataFrame:
    """Per source of a bag: ``degree``, its edge rows; ``fan_out``, its different targets; ``peak``, the
    copies of its most repeated edge."""
    # Counting the copies column, not rows, keeps it in the bag, so that all uses share one shuffle.
    return bag.groupBy(F.col("src").alias("node")).agg(
        F.sum("copies").alias("degree"), F.count("copies").alias("fan_out"), F.max("copies").alias("peak")
    )


def attach(rows: DataFrame, key: str, nodes: DataFrame, names: dict[str, str]) -> DataFrame:
    """Left-join columns of ``nodes`` (``names``: node column -> new column) to ``rows`` on ``key``.

    One node may own a large share of ``rows``. Adaptive execution splits such a key, but only in a join
    whose two inputs both come straight from a shuffle. ``nodes`` is an aggregate already partitioned by
    node and would get none, so its key is recomputed (two negations the optimizer does not cancel):
    that costs one shuffle of the node table, small beside the rows, and lets the hot key be split.
    A node without id is left out before the key is made, so it cannot pass for another. The fresh key is declared never null; else a filter on it would reach the scan below
    ``nodes`` and keep it from sharing a shuffle with the same scan elsewhere.
    """
    fresh_key = F.coalesce(F.bitwise_not(F.bitwise_not(F.col("node"))), F.lit(0))
    side = nodes.where(F.col("node").isNotNull()).select(fresh_key.alias("_node"), *[F.col(old).alias(new) for old, new in names.items()])
    return rows.join(side, F.col(key) == F.col("_node"), "left").drop("_node")
