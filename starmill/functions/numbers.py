"""Exact decimal arithmetic for shares, scores and means.

Spark caps decimals at 38 digits and gives up scale first, so every operand is cast to the width
it needs before it is multiplied, divided or averaged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEIGHT = "decimal(20,12)"


def equal_share(n: Column, number: str = WEIGHT) -> Column:
    """``1/n``, rounded once, to the places of ``number``; NULL for zero."""
    one = F.lit(1).cast("decimal(2,1)")
    return (one / F.nullif(n, F.lit(0)).cast("decimal(20,0)")).cast(number)


def weighted(measure: Column, weight: Column) -> Column:
    """Whole-number measure times weight, without losing a digit: decimal(33,12)."""
    return measure.cast("decimal(19,0)") * weight.cast("decimal(13,12)")


def quotient(total: Column, by: Column) -> Column:
    """Mean from two sums with 14 and 12 places, neither negative and both below 10^16: rounded
    to 16 places, whatever their size; NULL for zero.

    A long division in whole numbers: the whole part, then eight digits from each remainder.
    """
    ten = lambda n: F.lit(10**n).cast(f"decimal({n + 1},0)")
    rest = (total.cast("decimal(30,14)") * ten(14)).cast("decimal(30,0)")
    divisor = (by.cast("decimal(28,12)") * ten(14)).cast("decimal(30,0)")
    divisor = F.nullif(divisor, F.lit(0).cast("decimal(30,0)"))
    digits = []
    for _ in range(3):
        digits.append(F.call_function("div", rest, divisor).cast("decimal(20,0)"))
        rest = ((rest % divisor).cast("decimal(30,0)") * ten(8)).cast("decimal(38,0)")
    up = F.when(rest >= divisor * 5 * ten(7), 1).otherwise(0).cast("decimal(1,0)")
    small = lambda c, n: (c * F.lit(f"1e-{n}").cast(f"decimal({n},{n})")).cast(
        "decimal(36,16)"
    )
    return (
        digits[0].cast("decimal(36,16)") + small(digits[1], 8) + small(digits[2] + up, 16)
    ).cast("decimal(36,16)")


def mean(total: Column, n: Column) -> Column:
    """Mean from a sum with at most two decimals and a count, to 14 places."""
    return F.try_divide(total.cast("decimal(26,2)"), n.cast("decimal(14,0)")).cast("decimal(38,14)")


def score(issues: Column, total: Column) -> Column:
    """Share of rows without an issue, to four places; NULL when nothing was checked."""
    share = F.try_divide(issues.cast("decimal(20,0)"), total.cast("decimal(20,0)"))
    return F.round(F.lit(1) - share, 4).cast("decimal(24,4)")


def severity(score_col: Column) -> Column:
    """Traffic-light band of a score."""
    return (
        F.when(score_col.isNull(), "INFO")
        .when(score_col >= F.lit("0.95").cast("decimal(3,2)"), "GREEN")
        .when(score_col >= F.lit("0.80").cast("decimal(3,2)"), "YELLOW")
        .otherwise("RED")
    )
