"""Analyses over the star schema.

Rows are summed per dimension key before they meet the dimension, so what is joined and regrouped
by name is one row per member and task, however many facts a member holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions.numbers import mean, quotient, weighted

# Measure and the decimal it is summed as; up to eight digits are added as plain longs.
SUMS = {
    "rating": "decimal(8,2)",
    "reviews_count": "decimal(28,0)",
    "installs_count": "decimal(28,0)",
    "price_usd": "decimal(28,2)",
    "size_bytes": "decimal(28,0)",
}


def genre_fractional(fact: DataFrame, bridge: DataFrame, dim_genre: DataFrame) -> DataFrame:
    """One row per snapshot and genre, additive measures multiplied by the weight."""
    return (
        fact.join(bridge, "app_snapshot_key")
        .join(dim_genre.select("genre_key", "genre_name"), "genre_key")
        .select(
            "app_snapshot_key",
            "snapshot_id",
            "genre_name",
            "weight",
            "rating",
            "reviews_count",
            "installs_count",
            "price_usd",
            "size_bytes",
            weighted(F.col("reviews_count"), F.col("weight")).alias("weighted_reviews_count"),
            weighted(F.col("installs_count"), F.col("weight")).alias("weighted_installs_count"),
            F.col("weight").alias("weighted_snapshot_count"),
            "rating_missing_flag",
            "size_missing_flag",
            "size_varies_with_device_flag",
            "multiple_genre_flag",
            "dq_status",
        )
    )


def genre_weighted_kpis(fact: DataFrame, bridge: DataFrame, dim_genre: DataFrame) -> DataFrame:
    """Sums and mean rating per genre that count every snapshot once in total.

    Rows of one genre and one weight are added up before they are multiplied: there are only as
    many weights as lengths of lists, and the products stay exact.
    """
    rows = fact.select("app_snapshot_key", "rating", "reviews_count", "installs_count").join(
        bridge.select("app_snapshot_key", "genre_key", "weight"), "app_snapshot_key"
    )
    per_weight = rows.groupBy("genre_key", F.col("weight").cast("decimal(13,12)").alias("w")).agg(
        F.count("*").alias("n"),
        _sum("reviews_count").alias("reviews"),
        _sum("installs_count").alias("installs"),
        _sum("rating").alias("ratings"),
        F.count("rating").alias("rated"),
    )
    w = F.col("w")
    per_key = per_weight.groupBy("genre_key").agg(
        F.sum(weighted(F.col("n"), w)).alias("weights"),
        F.sum(F.col("reviews").cast("decimal(24,0)") * w).alias("reviews"),
        F.sum(F.col("installs").cast("decimal(24,0)") * w).alias("installs"),
        F.sum("ratings").alias("ratings"),
        F.sum("rated").alias("rated"),
        F.sum(F.col("ratings").cast("decimal(18,2)") * w).alias("weighted_ratings"),
        F.sum(F.when(F.col("rated") > 0, weighted(F.col("rated"), w))).alias("rated_weights"),
    )
    return (
        per_key.join(dim_genre.select("genre_key", "genre_name"), "genre_key")
        .groupBy("genre_name")
        .agg(
            F.sum("weights").alias("weighted_snapshot_count"),
            F.sum("reviews").alias("weighted_reviews_count"),
            F.sum("installs").alias("weighted_installs_count"),
            mean(F.sum("ratings"), F.sum("rated")).alias("avg_rating_unweighted"),
            quotient(F.sum("weighted_ratings"), F.sum("rated_weights")).alias(
                "avg_rating_weighted"
            ),
        )
    )


def genre_membership(fact: DataFrame, bridge: DataFrame, dim_genre: DataFrame) -> DataFrame:
    """Plain means per genre; a snapshot counts in each of its genres.

    Rows are folded per snapshot and genre on the partitioning that fact and bridge share, then
    per genre, so the genre's name meets one row per genre and a frequent genre is no hot key.
    """
    measures = ("rating", "price_usd", "size_bytes")
    pairs = (
        fact.select("app_snapshot_key", *measures)
        .join(bridge.select("app_snapshot_key", "genre_key"), "app_snapshot_key")
        .groupBy("app_snapshot_key", "genre_key")
        .agg(
            *[_sum(m).alias(f"sum_{m}") for m in measures],
            *[F.count(m).alias(f"n_{m}") for m in measures],
        )
    )
    folded = pairs.groupBy("genre_key").agg(
        F.count("*").alias("members"),
        *[F.sum(f"sum_{m}").alias(f"sum_{m}") for m in measures],
        *[F.sum(f"n_{m}").alias(f"n_{m}") for m in measures],
    )
    return (
        folded.join(dim_genre.select("genre_key", "genre_name"), "genre_key")
        .groupBy("genre_name")
        .agg(
            F.sum("members").alias("snapshot_membership_count"),
            *[
                mean(F.sum(f"sum_{m}"), F.sum(f"n_{m}")).alias(f"avg_{m}")
                for m in measures
            ],
        )
    )


def measures_by(fact: DataFrame, dim: DataFrame, entity: str) -> DataFrame:
    """Main measures per member of a dimension other than genre."""
    name = f"{entity}_name"
    members = _summed(fact, f"{entity}_key").join(
        dim.select(f"{entity}_key", name), f"{entity}_key"
    )
    return members.groupBy(name).agg(
        F.sum("n").alias("snapshot_count"),
        _mean_of("rating").alias("avg_rating"),
        F.sum("sum_reviews_count").alias("sum_reviews"),
        F.sum("sum_installs_count").alias("sum_installs"),
        _mean_of("price_usd").alias("avg_price_usd"),
        _mean_of("size_bytes").alias("avg_size_bytes"),
    )


def snapshots_over_time(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Snapshot counts and means per year, quarter and month of update, with subtotals.

    Only counts and means: the measures do not add up over time. The roll-up expands days, not
    snapshots.
    """
    days = _summed(fact, "last_updated_date_key").join(
        dim_date.select("last_updated_date_key", "year", "quarter", "month"),
        "last_updated_date_key",
    )
    return days.rollup("year", "quarter", "month").agg(
        F.sum("n").alias("snapshot_count"),
        _mean_of("rating").alias("avg_rating"),
        _mean_of("reviews_count").alias("avg_reviews"),
        _mean_of("installs_count").alias("avg_installs"),
    )


def top_k(df: DataFrame, by: str, k: int, tiebreak: str) -> DataFrame:
    """The ``k`` rows with the highest ``by``."""
    return df.orderBy(F.desc(by), tiebreak).limit(k)


def _summed(fact: DataFrame, key: str) -> DataFrame:
    """Count, sum and non-NULL count of every measure per dimension key."""
    return fact.groupBy(key).agg(
        F.count("*").alias("n"),
        *[_sum(m).alias(f"sum_{m}") for m in SUMS],
        *[F.count(m).alias(f"n_{m}") for m in SUMS],
    )


def _sum(measure: str) -> Column:
    return F.sum(F.col(measure).cast(SUMS[measure]))


def _mean_of(measure: str) -> Column:
    return mean(F.sum(f"sum_{measure}"), F.sum(f"n_{measure}"))
