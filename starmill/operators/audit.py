"""Audit log: one row per snapshot and cleaning decision."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions.text import labelled
from starmill.operators.enrich import NO_CELLS

AUDITED_TABLE = "clean.app_snapshot_clean"


@dataclass(frozen=True)
class AuditRule:
    """What to log where ``flag`` is set; values are columns over the clean row and its raw text."""

    flag: str
    column_name: str
    issue_type: Column
    old_value: Column
    new_value: Column
    action: str
    reason: str


def audit_rules() -> list[AuditRule]:
    none = F.lit(None).cast("string")
    text = lambda name: F.col(name).cast("string")
    # Column names, issue types, actions and reasons of the log.
    return [
        AuditRule(
            "rating_missing_flag",
            "rating",
            F.lit("rating_missing"),
            none,
            none,
            "PRESERVE_AND_FLAG",
            "Rating is an analytical measure. Missing ratings are preserved as NULL to avoid biased imputation; rating_missing_flag is set to true.",
        ),
        AuditRule(
            "size_missing_flag",
            "size_bytes",
            F.when(F.col("size_varies_with_device_flag"), "size_varies_with_device").otherwise(
                "size_missing"
            ),
            F.col("raw_size"),
            text("size_bytes"),
            "PRESERVE_AND_FLAG",
            'Application size is missing or reported as "Varies with device". It is preserved as NULL and flagged instead of being imputed.',
        ),
        AuditRule(
            "app_type_missing_flag",
            "app_type_id",
            F.lit("app_type_missing"),
            F.col("raw_type"),
            none,
            "PRESERVE_AND_FLAG",
            "App type is missing in the source. It is not inferred as Free/Paid without a documented business rule.",
        ),
        AuditRule(
            "current_version_missing_flag",
            "current_version",
            F.lit("current_version_missing"),
            F.col("raw_current_ver"),
            F.col("current_version"),
            "STANDARDIZE_NULL_AND_FLAG",
            "Missing or textual-null current version values are standardized to NULL and flagged.",
        ),
        AuditRule(
            "android_version_missing_flag",
            "android_version_text",
            F.lit("android_version_missing"),
            F.col("raw_android_ver"),
            F.col("android_version_text"),
            "STANDARDIZE_NULL_AND_FLAG",
            "Missing or textual-null Android version values are standardized to NULL and flagged.",
        ),
        AuditRule(
            "type_price_conflict_flag",
            "app_type_id / price_usd",
            F.lit("type_price_conflict"),
            labelled(("type", F.col("raw_type")), ("price", F.col("raw_price"))),
            labelled(("app_type_id", F.col("app_type_id")), ("price_usd", F.col("price_usd"))),
            "FLAG_FOR_REVIEW",
            "Free apps should have price 0 and Paid apps should normally have price greater than 0.",
        ),
        AuditRule(
            "invalid_measure_flag",
            "measures",
            F.lit("invalid_measure"),
            labelled(
                ("rating", F.col("raw_rating")),
                ("reviews", F.col("raw_reviews")),
                ("size", F.col("raw_size")),
                ("installs", F.col("raw_installs")),
                ("price", F.col("raw_price")),
            ),
            labelled(
                ("rating", F.col("rating")),
                ("reviews", F.col("reviews_count")),
                ("size", F.col("size_bytes")),
                ("installs", F.col("installs_count")),
                ("price", F.col("price_usd")),
            ),
            "FLAG_FOR_REVIEW",
            "One or more typed measures violate validity rules.",
        ),
        AuditRule(
            "multiple_genre_flag",
            "genre_count",
            F.lit("multiple_genre_membership"),
            text("genre_count"),
            text("genre_count"),
            "PRESERVE_AND_USE_WEIGHTED_BRIDGE",
            "The snapshot belongs to multiple genres. This is preserved, and bridge weights are created to avoid double counting in Genre analyses.",
        ),
    ]


def audit_log(
    clean: DataFrame, raw: DataFrame, rules: list[AuditRule] | None = None
) -> DataFrame:
    """All rules in one pass over the clean rows and one join with their raw text.

    A rule whose flag is not set, or NULL, leaves an empty entry, which is dropped.
    """
    rules = audit_rules() if rules is None else rules
    texts = [c for c in raw.columns if c not in NO_CELLS]
    before = raw.select("raw_id", *[F.col(c).alias(f"raw_{c}") for c in texts])
    entries = F.array(
        *[
            F.when(
                F.col(rule.flag),
                F.struct(
                    F.lit(AUDITED_TABLE).alias("table_name"),
                    F.col("snapshot_id").cast("string").alias("row_pk"),
                    F.lit(rule.column_name).alias("column_name"),
                    rule.issue_type.alias("issue_type"),
                    rule.old_value.cast("string").alias("old_value"),
                    rule.new_value.cast("string").alias("new_value"),
                    F.lit(rule.action).alias("action"),
                    F.lit(rule.reason).alias("reason"),
                ),
            )
            for rule in rules
        ]
    )
    # Rows without a decision to log, most of them, never meet the wide raw text.
    decided = reduce(or_, [F.coalesce(F.col(rule.flag), F.lit(False)) for rule in rules])
    logged = clean.where(decided).join(before, "raw_id", "left").select(F.inline(entries))
    return logged.where(F.col("table_name").isNotNull())


def audit_summary(log: DataFrame) -> DataFrame:
    return (
        log.groupBy("issue_type", "action")
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), "issue_type")
    )
