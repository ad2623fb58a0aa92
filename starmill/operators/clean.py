"""Cleaning by flags: nothing is imputed, every doubt is marked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.config import Config
from starmill.functions.text import name_key, tokens_to_null
from starmill.operators.bridge import genre_counts

# Flags that count as issues; varying size and several genres are facts, not issues.
ISSUE_FLAGS = (
    "rating_missing_flag",
    "size_missing_flag",
    "app_type_missing_flag",
    "current_version_missing_flag",
    "android_version_missing_flag",
    "type_price_conflict_flag",
    "invalid_measure_flag",
    "genre_missing_flag",
)
ERROR_FLAGS = ("invalid_measure_flag", "type_price_conflict_flag", "genre_missing_flag")
NOTE_FLAGS = (
    "rating_missing_flag",
    "size_missing_flag",
    "app_type_missing_flag",
    "current_version_missing_flag",
    "android_version_missing_flag",
    "multiple_genre_flag",
)
FLAGS = (
    "rating_missing_flag",
    "size_missing_flag",
    "size_varies_with_device_flag",
    "app_type_missing_flag",
    "current_version_missing_flag",
    "android_version_missing_flag",
    "type_price_conflict_flag",
    "invalid_measure_flag",
    "genre_missing_flag",
    "multiple_genre_flag",
)


def type_price_conflict(cfg: Config) -> Column:
    """A free app with a price or a paid one without; NULL when the type is missing."""
    kind, price = F.col("app_type_name_norm"), F.col("price_usd")
    return ((kind == cfg.free_type) & (price > 0)) | (
        (kind == cfg.paid_type) & (F.coalesce(price, F.lit(0)) == 0)
    )


def rating_out_of_range() -> Column:
    rating = F.col("rating")
    return rating.isNotNull() & ((rating < 0) | (rating > 5))


def invalid_measure() -> Column:
    """A measure outside its range; NULL when none is but one of the last four is missing."""
    return (
        rating_out_of_range()
        | (F.col("reviews_count") < 0)
        | (F.col("installs_count") < 0)
        | (F.col("price_usd") < 0)
        | (F.col("size_bytes") < 0)
    )


def quality_flags(cfg: Config) -> dict[str, Column]:
    return {
        "rating_missing_flag": F.col("rating").isNull(),
        "size_missing_flag": F.col("size_bytes").isNull(),
        "size_varies_with_device_flag": name_key(F.coalesce("raw_size", F.lit("")))
        == cfg.size_varies,
        "app_type_missing_flag": F.col("app_type_id").isNull(),
        "current_version_missing_flag": F.col("current_version").isNull(),
        "android_version_missing_flag": F.col("android_version_text").isNull(),
        "type_price_conflict_flag": type_price_conflict(cfg),
        "invalid_measure_flag": invalid_measure(),
        "genre_missing_flag": F.col("genre_count") == 0,
        "multiple_genre_flag": F.col("genre_count") > 1,
    }


def issue_count(strict: bool = False) -> Column:
    """Number of issue flags set; NULL when one is unknown, unless ``strict`` reads that as no."""
    counts = [F.col(f).cast("int") for f in ISSUE_FLAGS]
    if strict:
        counts = [F.coalesce(c, F.lit(0)) for c in counts]
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return total


def quality_status() -> Column:
    return (
        F.when(_any(ERROR_FLAGS), "ERROR_REVIEW")
        .when(_any(NOTE_FLAGS), "FLAGGED_OK")
        .otherwise("OK")
    )


def clean_snapshot(
    snapshot: DataFrame, raw: DataFrame, app_type: DataFrame, bridge: DataFrame, cfg: Config
) -> DataFrame:
    """Snapshots with standardised versions, ten flags, issue count and status.

    The type is looked up first, so whichever way that join goes, the rows end up on the
    partitioning by row id that the large sides share. Flags are three-valued on purpose: an
    unknown comparison stays NULL.
    """
    base = (
        snapshot.join(app_type.select("app_type_id", "app_type_name_norm"), "app_type_id", "left")
        .join(raw.select("raw_id", F.col("size").alias("raw_size")), "raw_id", "left")
        .join(genre_counts(bridge), "snapshot_id", "left")
        .withColumns(
            {
                "genre_count": F.coalesce("genre_count", F.lit(0)).cast("bigint"),
                "current_version": tokens_to_null(
                    F.col("current_version"), cfg.clean_null_tokens
                ),
                "android_version_text": tokens_to_null(
                    F.col("android_version_text"), cfg.clean_null_tokens
                ),
            }
        )
    )
    flagged = base.withColumns(quality_flags(cfg))
    return flagged.select(
        *snapshot.columns,
        "genre_count",
        *FLAGS,
        issue_count().alias("dq_issue_count"),
        issue_count(strict=True).alias("dq_issue_count_strict"),
        quality_status().alias("dq_status"),
    )


def _any(flags: tuple[str, ...]) -> Column:
    hit = F.col(flags[0])
    for flag in flags[1:]:
        hit = hit | F.col(flag)
    return hit
