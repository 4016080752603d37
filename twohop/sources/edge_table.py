"""Edge tables: two id columns of any table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def edge_table(table: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Two columns of a table as ``edges(src, dst)``; a row lacking an id is no edge."""
    edges = table.select(F.col(src).cast("bigint").alias("src"), F.col(dst).cast("bigint").alias("dst"))
    return edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def read_edge_table(spark: SparkSession, path: str | list[str], src: str = "src", dst: str = "dst") -> DataFrame:
    """A Parquet edge table; only the two id columns are read."""
    paths = [path] if isinstance(path, str) else path
    return edge_table(spark.read.parquet(*paths), src, dst)
