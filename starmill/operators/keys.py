"""Dense surrogate keys without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from starmill.sources.store import written

# Consecutive ids numbered by one task; and blocks, then wide blocks, whose counts are added up
# by one task. With 64-bit ids at most 2**24 counts meet in one task, however sparse the ids.
BLOCK_SPAN = 1 << 20
WIDE_SPAN = 1 << 20


def dense_key(
    df: DataFrame,
    key: str,
    order_by: list[str],
    span: int = BLOCK_SPAN,
    wide: int = WIDE_SPAN,
) -> DataFrame:
    """Add ``key`` = 1, 2, 3, ... in the order of ``order_by``, whose first column is a bigint.

    Blocks of ``span`` consecutive ids are numbered apart and shifted by the number of rows in
    the blocks before them, which are counted on two levels: within a wide block of ``wide``
    blocks, and over the wide blocks. Block limits come from the ids alone, so a task that is run
    again hands out the same keys, and sparse ids make no more counts meet than dense ones can.
    """
    blocked = df.withColumn("_block", F.expr(f"`{order_by[0]}` div {span}"))
    before = lambda w: w.rowsBetween(W.Window.unboundedPreceding, -1)
    sums = lambda w: F.coalesce(F.sum("_rows").over(before(w)), F.lit(0))
    rows = F.sum("_rows").alias("_rows")
    counts = (
        blocked.groupBy("_block")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_wide", F.expr(f"_block div {wide}"))
    )
    over = counts.groupBy("_wide").agg(rows).select(
        "_wide", sums(W.Window.orderBy("_wide")).alias("_above")
    )
    beside = sums(W.Window.partitionBy("_wide").orderBy("_block"))
    shifts = (
        counts.withColumn("_beside", beside)
        .join(over, "_wide")
        .select("_block", (F.col("_above") + F.col("_beside")).alias("_shift"))
    )
    within = W.Window.partitionBy("_block").orderBy(*order_by)
    return (
        blocked.withColumn("_place", F.row_number().over(within))
        .join(shifts, "_block")
        .select(
            (F.col("_shift") + F.col("_place")).cast("bigint").alias(key),
            *[F.col(c) for c in df.columns],
        )
    )


def ordered_key(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Add ``key`` = 1, 2, 3, ... in the order of ``order_by``, columns of any kind that can be
    ordered, NULLs first. Rows that are equal in all of them get their keys in any order.

    Rows are dealt to tasks by sampled ranges of all those columns, so a name that a large part of
    the rows has is split by the columns behind it. The dealt rows are written: a range keeps its
    rows whatever is run again. What one task adds up is one count per range.
    """
    dealt = written(df.repartitionByRange(*order_by).withColumn("_range", F.spark_partition_id()))
    earlier = W.Window.orderBy("_range").rowsBetween(W.Window.unboundedPreceding, -1)
    shifts = (
        dealt.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"))
    )
    within = W.Window.partitionBy("_range").orderBy(*order_by)
    return (
        dealt.withColumn("_place", F.row_number().over(within))
        .join(shifts, "_range")
        .select(
            (F.col("_shift") + F.col("_place")).cast("bigint").alias(key),
            *[F.col(f"`{c}`") for c in df.columns],
        )
    )
