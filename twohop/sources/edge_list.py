"""Text edge lists: one edge per line, two integer ids separated by blanks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twohop.store import write_out

# Fixed values of the input format: the blanks that separate ids, and the comment mark.
BLANKS = " \t\x0b\f\r"
SEPARATOR = r"[ \t\x0B\f\r]+"
COMMENT_MARK = "#"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of a file, directory, glob or compressed text as ``value``."""
    return spark.read.text(path)


def drop_comments(lines: DataFrame, comment: str = "anywhere") -> DataFrame:
    """Drop comment lines: those with the mark ``anywhere`` or, if asked, only as their ``prefix``."""
    if comment == "anywhere":
        return lines.where(~F.col("value").contains(COMMENT_MARK))
    if comment == "prefix":
        return lines.where(~F.ltrim("value").startswith(COMMENT_MARK))
    raise ValueError(f"comment must be 'anywhere' or 'prefix', not {comment!r}")


def _once(*columns: Column) -> Column:
    """The columns behind a generator of one row: a filter on them does not cross it, so each is computed once."""
    return F.inline(F.array(F.struct(*columns)))


def _with_ids(lines: DataFrame) -> DataFrame:
    # At most three parts: everything after the second id stays unsplit and is ignored.
    parts = F.split(F.btrim("value", F.lit(BLANKS)), SEPARATOR, 3)
    tokens = lines.select("value", _once(parts.alias("parts")))
    first, second = F.get("parts", F.lit(0)), F.get("parts", F.lit(1))
    ids = tokens.select(
        "value",
        _once(
            first.try_cast("bigint").alias("src"),
            second.try_cast("bigint").alias("dst"),
            (first == "").alias("blank"),
            second.isNull().alias("single"),
        ),
    )
    reason = (
        F.when(F.col("blank"), "blank line")
        .when(F.col("single"), "one id only")
        .when(F.col("src").isNull(), "source id is not an integer")
        .when(F.col("dst").isNull(), "target id is not an integer")
    )
    return ids.select("value", "src", "dst", reason.alias("reason"))


def parse_edges(lines: DataFrame, comment: str = "anywhere", mode: str = "failfast") -> DataFrame:
    """Lines to ``edges(src, dst)``, one row per line, duplicates kept.

    ``failfast`` stops the job at the first malformed line and names it; ``permissive`` leaves
    malformed lines out, to be read with :func:`bad_rows`.
    """
    parsed = _with_ids(drop_comments(lines, comment))
    good = F.col("reason").isNull()
    if mode == "permissive":
        return parsed.where(good).select("src", "dst")
    if mode != "failfast":
        raise ValueError(f"mode must be 'failfast' or 'permissive', not {mode!r}")
    message = F.concat(F.lit("malformed edge line ("), "reason", F.lit("): "), "value")
    # The id itself fails, so that no later filter on ids can drop a malformed line unseen.
    src = F.when(good, F.col("src")).otherwise(F.raise_error(message).cast("bigint"))
    return parsed.select(_once(src.alias("src"), F.col("dst").alias("dst")))


def bad_rows(lines: DataFrame, comment: str = "anywhere") -> DataFrame:
    """The malformed lines as ``(value, reason)``."""
    parsed = _with_ids(drop_comments(lines, comment))
    return parsed.where(F.col("reason").isNotNull()).select("value", "reason")


def split_lines(lines: DataFrame, comment: str = "anywhere") -> tuple[DataFrame, DataFrame]:
    """``edges(src, dst)`` and the malformed lines ``(value, reason)``, from one scan: lines are parsed once, written in one folder for good
    and one for bad ones, and each result reads its own."""
    parsed = _with_ids(drop_comments(lines, comment))
    bad = F.col("reason").isNotNull()
    # A good line is its ids; its text is not kept.
    written = write_out(parsed.select("src", "dst", F.when(bad, F.col("value")).alias("value"), "reason", bad.alias("bad")), "parsed", ("bad",))
    return written.where("not bad").select("src", "dst"), written.where("bad").select("value", "reason")


def read_edge_list(
    spark: SparkSession, path: str | list[str], comment: str = "anywhere", mode: str = "failfast"
) -> DataFrame:
    return parse_edges(read_lines(spark, path), comment, mode)
