"""Small helpers on DataFrames that several operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of a batch of rows that a task hands to Python; Spark's default is 64 MB.
BATCH_BYTES = 4 << 20
_SETTING, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bound_batches(spark: SparkSession) -> None:
    """Smaller batches than Spark's default, which long texts fill; a value that the session has set itself stays."""
    if spark.conf.get(_SETTING, None) == _DEFAULT:
        spark.conf.set(_SETTING, BATCH_BYTES)


def texts_of(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` and ``text`` only, so that no further column, whatever its name, can interfere; and what is asked for."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def total_bytes(texts: DataFrame) -> int:
    """Bytes of all texts: what the numbers of groups and buckets are derived from."""
    return texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def parts(amount: int, each: int, least: int = 1) -> int:
    return max(least, -(-amount // each))
