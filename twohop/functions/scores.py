"""Column expressions of the measures.

Adamic/Adar weights are summed as whole numbers of 1e-12, so a score does not depend on the order of
the rows. The sum is kept in two parts (multiples of 1e-6, and the rest) because one 64-bit sum
would overflow at a few million shared neighbours, while two last for about 1e12.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The decimals kept of a weight, and the two parts it is summed in.
WEIGHT_SCALE = 10**12
PART = 10**6

LABEL_MARK = " <-> "


def inverse_log_weight(degree: Column) -> Column:
    """``1 / log10(degree)`` in units of 1e-12; NULL for degree 1, which links no two nodes."""
    return F.when(degree > 1, F.round(F.lit(float(WEIGHT_SCALE)) / F.log10(degree)).cast("bigint"))


def _millionths(weight: Column) -> Column:
    return F.call_function("div", weight, F.lit(PART))


def weight_parts(weight: Column) -> tuple[Column, Column]:
    return _millionths(weight), weight % F.lit(PART)


def adamic_adar_score(high: Column, low: Column) -> Column:
    """The two summed parts as one double: the exact sum, rounded once, so that order is kept."""
    whole, rest = high + _millionths(low), low % F.lit(PART)
    exact = whole.cast("decimal(20,0)") * F.lit(PART) + rest
    fits = whole < F.lit(2**63 // PART - 1)
    return F.when(fits, (whole * F.lit(PART) + rest).cast("double")).otherwise(exact.cast("double")) / F.lit(
        float(WEIGHT_SCALE)
    )


def jaccard_ratio(common: Column, total: Column) -> Column:
    """``common / (total - common)``, infinite where the union is empty."""
    union = total - common
    return F.when(union == 0, F.lit(float("inf"))).otherwise(common.cast("double") / union.cast("double"))


def pair_label(u: str = "u", v: str = "v") -> Column:
    return F.concat_ws(LABEL_MARK, F.col(u).cast("string"), F.col(v).cast("string"))


def score_text(score: Column) -> Column:
    """Five decimals, rounded half up."""
    return F.format_string("%.5f", score)
