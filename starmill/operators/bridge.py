"""Many-to-many bridge between snapshots and genres, and its weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from starmill.config import Config
from starmill.functions.numbers import equal_share
from starmill.functions.text import name_key
from starmill.operators.domains import open_lists

# Fixed value: the preview shows weights to six places.
PREVIEW_WEIGHT = "decimal(20,6)"


def build_bridge(
    raw: DataFrame, snapshot: DataFrame, genre: DataFrame, cfg: Config, column: str = "genres"
) -> DataFrame:
    """Distinct (snapshot_id, genre_id).

    Duplicates are dropped and genres looked up per landing row; the rows meet their snapshots
    last, on the partitioning by ``raw_id``. So nothing is shuffled while genres are small enough
    to be broadcast, and two numbers a row otherwise.
    """
    found = (
        open_lists(raw, "raw_id", column, cfg)
        .select("raw_id", name_key(F.col("value")).alias("genre_name_norm"))
        .distinct()
        .join(genre.select("genre_name_norm", "genre_id"), "genre_name_norm")
        .select("raw_id", "genre_id")
    )
    # A merge join, as a broadcast one could leave the partitioning of the landing rows.
    known = snapshot.select("raw_id", "snapshot_id").hint("merge")
    return found.join(known, "raw_id").select("snapshot_id", "genre_id")


def genre_counts(bridge: DataFrame, key: str = "snapshot_id") -> DataFrame:
    """(key, genre_count) of the snapshots that have a genre."""
    return bridge.groupBy(key).agg(F.count("*").alias("genre_count"))


def counts_with_zero(snapshot: DataFrame, bridge: DataFrame) -> DataFrame:
    """(snapshot_id, genre_count) of every snapshot, 0 for none."""
    return snapshot.select("snapshot_id").join(
        genre_counts(bridge), "snapshot_id", "left"
    ).select("snapshot_id", F.coalesce("genre_count", F.lit(0)).cast("bigint").alias("genre_count"))


def genre_histogram(snapshot: DataFrame, bridge: DataFrame) -> DataFrame:
    """How many snapshots have 0, 1, 2, ... genres."""
    return (
        counts_with_zero(snapshot, bridge)
        .groupBy("genre_count")
        .agg(F.count("*").alias("snapshot_count"))
        .orderBy("genre_count")
    )


def bridge_weights(bridge: DataFrame, key: str = "snapshot_id") -> DataFrame:
    """Bridge rows with ``weight`` = 1 / number of genres of their snapshot, to 12 places.

    The window is partitioned by the snapshot: its groups are as small as one row's list.
    """
    n = F.count("*").over(W.Window.partitionBy(key))
    return bridge.withColumn("weight", equal_share(n))


def weight_preview(bridge: DataFrame, genre: DataFrame) -> DataFrame:
    """Genre count and six-place weight of every bridge row, before cleaning.

    Only rows whose genre exists are counted, as they are the rows that will be weighted.
    """
    known = bridge.join(genre.select("genre_id", "genre_name"), "genre_id")
    n = F.count("*").over(W.Window.partitionBy("snapshot_id"))
    return known.withColumn("genre_count_for_snapshot", n).select(
        "snapshot_id",
        "genre_id",
        "genre_name",
        "genre_count_for_snapshot",
        equal_share(F.col("genre_count_for_snapshot"), PREVIEW_WEIGHT).alias(
            "future_dw_bridge_weight"
        ),
    )


def weight_errors(
    weights: DataFrame, key: str, tolerance: float, weight: str = "weight"
) -> DataFrame:
    """Snapshots whose weights do not add up to one: (key, genre_count, weight_sum, weight_error)."""
    sums = weights.groupBy(key).agg(
        F.count("*").alias("genre_count"), F.sum(weight).alias("weight_sum")
    )
    error = F.abs(F.col("weight_sum") - F.lit(1).cast("decimal(2,1)"))
    limit = F.lit(f"{tolerance:.12f}").cast("decimal(20,12)")
    return sums.withColumn("weight_error", error).where(F.col("weight_error") > limit)
