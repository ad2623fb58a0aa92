"""Assessment before cleaning, and the scorecard after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.config import Config
from starmill.functions.text import is_missing
from starmill.operators.bridge import counts_with_zero, weight_errors
from starmill.operators.clean import invalid_measure, rating_out_of_range, type_price_conflict
from starmill.operators.enrich import enrich_snapshot, issue_rows, not_loaded
from starmill.operators.report import (
    Measure,
    Metric,
    duplicate_counts,
    duplicate_excess,
    measure,
    metric_rows,
    row_count,
    scorecard,
)
from starmill.plans.layers import Layers

# Reading order of the quality dimensions.
DIMENSION_ORDER = (
    "Completeness",
    "Uniqueness",
    "Validity",
    "Consistency",
    "Timeliness",
    "Accuracy",
)

# Snapshot columns a fact row cannot do without.
CORE_COLUMNS = (
    "app_id",
    "category_id",
    "content_rating_id",
    "reviews_count",
    "installs_count",
    "price_usd",
    "last_updated_date",
)


def enriched_snapshot(ly: Layers) -> DataFrame:
    return enrich_snapshot(ly["snapshot"], ly.masters(), ly["raw"])


def reconciliation_counts(ly: Layers) -> DataFrame:
    counted = {
        "raw_rows": ly["raw"],
        "reconciled_app_rows": ly["app"],
        "reconciled_category_rows": ly["category"],
        "reconciled_app_type_rows": ly["app_type"],
        "reconciled_content_rating_rows": ly["content_rating"],
        "reconciled_app_snapshot_rows": ly["snapshot"],
        "reconciled_genre_rows": ly["genre"],
        "reconciled_app_snapshot_genre_rows": ly["bridge"],
        "raw_rows_not_loaded_to_snapshot": not_loaded(ly["raw"], ly["snapshot"]),
    }
    measures = [Measure(name, name, row_count()) for name in counted]
    return metric_rows(measure(counted, measures), list(counted))


def baseline_scorecard(ly: Layers) -> DataFrame:
    """21 metrics over the reconciled layer.

    The eleven metrics on snapshot columns share one scan; of the masters only the app type is
    joined to it.
    """
    cfg = ly.config
    snapshot, bridge = ly["snapshot"], ly["bridge"]
    tables = {
        "snapshot": snapshot.join(
            ly["app_type"].select("app_type_id", "app_type_name_norm"), "app_type_id", "left"
        ),
        "raw_ids": duplicate_counts(snapshot, ["raw_id"]),
        "app_names": duplicate_counts(ly["app"], ["app_name_norm"]),
        "pairs": duplicate_counts(bridge, ["snapshot_id", "genre_id"]),
        "genre_counts": counts_with_zero(snapshot, bridge),
        "bridge": _bridge_ends(bridge, snapshot, ly["genre"]),
        **ly.masters(),
    }
    measured = measure(tables, _baseline_measures(cfg))
    return scorecard(measured, _baseline_metrics(cfg))


def baseline_scorecard_in_order(ly: Layers) -> DataFrame:
    rank = F.coalesce(
        *[F.when(F.col("dimension") == d, i + 1) for i, d in enumerate(DIMENSION_ORDER)],
        F.lit(99),
    )
    return baseline_scorecard(ly).orderBy(rank, "metric")


def issue_views(cfg: Config) -> dict[str, Column]:
    """Rules of the issue lists over the enriched snapshot."""
    return {
        "missing_rating": F.col("rating").isNull(),
        "missing_size": F.col("size_bytes").isNull(),
        "missing_app_type": F.col("app_type_id").isNull(),
        "type_price_conflict": type_price_conflict(cfg),
        "invalid_measures": invalid_measure(),
    }


def issue_view(ly: Layers, name: str) -> DataFrame:
    """The enriched snapshots a rule finds wanting; only these meet the wide raw text."""
    snapshot = ly["snapshot"]
    typed = snapshot.join(ly["app_type"], "app_type_id", "left")
    found = issue_rows(typed, issue_views(ly.config)[name]).select(*snapshot.columns)
    return enrich_snapshot(found, ly.masters(), ly["raw"])


def after_cleaning_scorecard(ly: Layers) -> DataFrame:
    """8 metrics: known issues are managed, none is left unmarked."""
    clean = ly["clean"]
    tables = {
        "clean": clean,
        "snapshot": ly["snapshot"],
        "weight_errors": weight_errors(
            ly["clean_bridge"], "snapshot_id", ly.config.weight_tolerance
        ),
    }
    measures = [
        Measure("clean_rows", "clean", row_count()),
        *unflagged_measures(),
        Measure("invalid", "clean", F.count_if("invalid_measure_flag")),
        Measure("conflicts", "clean", F.count_if("type_price_conflict_flag")),
        Measure("without_genre", "clean", F.count_if("genre_missing_flag")),
        Measure("snapshot_rows", "snapshot", row_count()),
        Measure("weight_errors", "weight_errors", row_count()),
    ]
    rows = F.col("clean_rows")
    parity = F.when(rows == F.col("snapshot_rows"), 0).otherwise(1)
    # Dimensions, metric names and details.
    lines = [
        (
            "Completeness Management",
            "rating_missing_values_are_flagged",
            rows,
            F.col("unflagged_rating"),
            "All NULL ratings must be explicitly flagged.",
        ),
        (
            "Completeness Management",
            "size_missing_values_are_flagged",
            rows,
            F.col("unflagged_size"),
            "All NULL size values must be explicitly flagged.",
        ),
        (
            "Completeness Management",
            "app_type_missing_values_are_flagged",
            rows,
            F.col("unflagged_app_type"),
            "All missing app type values must be explicitly flagged.",
        ),
        (
            "Validity",
            "invalid_measures_remaining",
            rows,
            F.col("invalid"),
            "Invalid typed measures should not exist after the reconciled ETL.",
        ),
        (
            "Consistency",
            "type_price_conflicts_remaining",
            rows,
            F.col("conflicts"),
            "Free/Paid type should be consistent with price.",
        ),
        (
            "Consistency",
            "genre_missing_remaining",
            rows,
            F.col("without_genre"),
            "Every app snapshot should have at least one genre.",
        ),
        (
            "Many-to-Many Integrity",
            "genre_bridge_weight_errors",
            rows,
            F.col("weight_errors"),
            "For each snapshot, the sum of Genre bridge weights must be equal to 1.",
        ),
        (
            "Reconciliation",
            "clean_rows_match_reconciled_rows",
            F.lit(1),
            parity,
            "Clean layer should preserve the reconciled snapshot grain.",
        ),
    ]
    metrics = [Metric(d, m, None, total, issues, details) for d, m, total, issues, details in lines]
    return scorecard(measure(tables, measures), metrics).drop("checked_object", "recommendation")


def after_cleaning_scorecard_in_order(ly: Layers) -> DataFrame:
    return after_cleaning_scorecard(ly).orderBy("dimension", "metric")


def cleaning_summary(ly: Layers) -> DataFrame:
    flags = (
        "rating_missing",
        "size_missing",
        "size_varies_with_device",
        "app_type_missing",
        "current_version_missing",
        "android_version_missing",
        "type_price_conflict",
        "invalid_measure",
        "genre_missing",
        "multiple_genre",
    )
    statuses = ("OK", "FLAGGED_OK", "ERROR_REVIEW")
    measures = [
        Measure("clean_app_snapshot_rows", "clean", row_count()),
        Measure("clean_bridge_rows", "clean_bridge", row_count()),
        Measure("audit_log_rows", "audit_log", row_count()),
        *[Measure(f"{f}_flag_rows", "clean", F.count_if(f"{f}_flag")) for f in flags],
        *[
            Measure(
                f"dq_status_{s.lower()}_rows", "clean", F.count_if(F.col("dq_status") == s)
            )
            for s in statuses
        ],
    ]
    tables = {name: ly[name] for name in ("clean", "clean_bridge", "audit_log")}
    return metric_rows(measure(tables, measures), [m.name for m in measures])


def unflagged_measures() -> list[Measure]:
    """Missing values whose flag is not set, over the clean table."""
    pairs = {"rating": "rating", "size": "size_bytes", "app_type": "app_type_id"}
    return [
        Measure(
            f"unflagged_{name}",
            "clean",
            F.count_if(F.col(c).isNull() & ~F.col(f"{name}_missing_flag").eqNullSafe(True)),
        )
        for name, c in pairs.items()
    ]


def _bridge_ends(bridge: DataFrame, snapshot: DataFrame, genre: DataFrame) -> DataFrame:
    """Bridge rows with a mark on each end that exists."""
    return bridge.join(
        snapshot.select("snapshot_id", F.lit(True).alias("has_snapshot")), "snapshot_id", "left"
    ).join(genre.select("genre_id", F.lit(True).alias("has_genre")), "genre_id", "left")


def _baseline_measures(cfg: Config) -> list[Measure]:
    today = F.current_date() if cfg.as_of_date is None else F.lit(cfg.as_of_date)
    core_missing = F.lit(False)
    for c in CORE_COLUMNS:
        core_missing = core_missing | F.col(c).isNull()

    def on_snapshot(name: str, condition: Column) -> Measure:
        return Measure(name, "snapshot", F.count_if(condition))

    assess = cfg.assess_null_tokens
    return [
        Measure("rows", "snapshot", row_count()),
        on_snapshot("core_missing", core_missing),
        on_snapshot("rating_missing", F.col("rating").isNull()),
        on_snapshot("size_missing", F.col("size_bytes").isNull()),
        on_snapshot("app_type_missing", F.col("app_type_id").isNull()),
        on_snapshot("current_missing", is_missing(F.col("current_version"), assess)),
        on_snapshot("android_missing", is_missing(F.col("android_version_text"), assess)),
        on_snapshot("rating_range", rating_out_of_range()),
        on_snapshot("negative_reviews", F.col("reviews_count") < 0),
        on_snapshot("negative_installs", F.col("installs_count") < 0),
        on_snapshot("negative_price", F.col("price_usd") < 0),
        on_snapshot("negative_size", F.col("size_bytes") < 0),
        on_snapshot("conflicts", type_price_conflict(cfg)),
        on_snapshot("future_date", F.col("last_updated_date") > today),
        on_snapshot("date_missing", F.col("last_updated_date").isNull()),
        Measure("raw_id_excess", "raw_ids", duplicate_excess()),
        Measure("app_rows", "app_names", F.coalesce(F.sum("key_rows"), F.lit(0))),
        Measure("app_excess", "app_names", duplicate_excess()),
        Measure("pair_excess", "pairs", duplicate_excess()),
        Measure("without_genre", "genre_counts", F.count_if(F.col("genre_count") == 0)),
        Measure("bridge_rows", "bridge", row_count()),
        Measure(
            "orphan_rows",
            "bridge",
            F.count_if(F.col("has_snapshot").isNull() | F.col("has_genre").isNull()),
        ),
        Measure("category_rows", "category", row_count()),
        Measure(
            "bad_categories",
            "category",
            F.count_if(F.col("category_name_norm").isin(*cfg.bad_categories)),
        ),
        Measure("app_type_rows", "app_type", row_count()),
        Measure(
            "bad_app_types",
            "app_type",
            F.count_if(~F.col("app_type_name_norm").isin(cfg.free_type, cfg.paid_type)),
        ),
        Measure("content_rating_rows", "content_rating", row_count()),
        Measure(
            "bad_content_ratings",
            "content_rating",
            F.count_if(F.col("content_rating_name_norm").isin(*cfg.bad_content_ratings)),
        ),
    ]


def _baseline_metrics(cfg: Config) -> list[Metric]:
    rows = F.col("rows")
    nothing = F.lit(None).cast("bigint")
    # Dimensions, metric names, checked objects, details and recommendations.
    lines = [
        (
            "Completeness",
            "core_required_fields_missing",
            "reconciled.app_snapshot",
            rows,
            F.col("core_missing"),
            "Core fields should be present for each loaded app snapshot. Rating and size are excluded because missing values are analytically meaningful.",
            "Investigate rows with missing core fields before loading the DW fact table.",
        ),
        (
            "Completeness",
            "rating_missing",
            "reconciled.app_snapshot.rating",
            rows,
            F.col("rating_missing"),
            "Rating can be missing in the source dataset. It should not be blindly imputed because it is an analytical measure.",
            "Preserve NULL rating and create rating_missing_flag during cleaning.",
        ),
        (
            "Completeness",
            "size_missing_or_varies_with_device",
            "reconciled.app_snapshot.size_bytes",
            rows,
            F.col("size_missing"),
            'Size is NULL when the raw value is missing or equal to "Varies with device". This is meaningful source information.',
            "Preserve NULL size and create size_missing_or_varies_flag during cleaning.",
        ),
        (
            "Completeness",
            "app_type_missing",
            "reconciled.app_snapshot.app_type_id",
            rows,
            F.col("app_type_missing"),
            "App type should usually be Free or Paid. Missing type should be flagged instead of guessed.",
            "Create app_type_missing_flag. Do not infer Free/Paid unless a documented business rule is approved.",
        ),
        (
            "Completeness",
            "current_version_missing",
            "reconciled.app_snapshot.current_version",
            rows,
            F.col("current_missing"),
            "Current version is descriptive metadata and may be missing for some apps.",
            "Preserve missing value and optionally flag it for metadata-quality analysis.",
        ),
        (
            "Completeness",
            "android_version_missing",
            "reconciled.app_snapshot.android_version_text",
            rows,
            F.col("android_missing"),
            "Android version is descriptive metadata and may be missing or vary across devices.",
            "Preserve missing value and optionally flag it for metadata-quality analysis.",
        ),
        (
            "Uniqueness",
            "duplicate_raw_id_in_app_snapshot",
            "reconciled.app_snapshot.raw_id",
            rows,
            F.col("raw_id_excess"),
            "Each raw row should generate at most one reconciled app snapshot.",
            "If duplicates exist, inspect ETL joins and source row identifiers.",
        ),
        (
            "Uniqueness",
            "duplicate_app_name_norm",
            "reconciled.app.app_name_norm",
            F.col("app_rows"),
            F.col("app_excess"),
            "Normalized app names should be unique in the app master table.",
            "If duplicates exist, improve normalization rules.",
        ),
        (
            "Uniqueness",
            "duplicate_snapshot_genre_pair",
            "reconciled.app_snapshot_genre(snapshot_id, genre_id)",
            F.col("bridge_rows"),
            F.col("pair_excess"),
            "Each snapshot-genre pair should appear only once.",
            "If duplicates exist, deduplicate the bridge table before DW loading.",
        ),
        (
            "Validity",
            "rating_out_of_range",
            "reconciled.app_snapshot.rating",
            rows,
            F.col("rating_range"),
            "Rating must be between 0 and 5.",
            "Invalid ratings should be set to NULL and logged during cleaning.",
        ),
        (
            "Validity",
            "negative_reviews_count",
            "reconciled.app_snapshot.reviews_count",
            rows,
            F.col("negative_reviews"),
            "Review count cannot be negative.",
            "Invalid review counts should be investigated and nullified if needed.",
        ),
        (
            "Validity",
            "negative_installs_count",
            "reconciled.app_snapshot.installs_count",
            rows,
            F.col("negative_installs"),
            "Install count cannot be negative.",
            "Invalid install counts should be investigated and nullified if needed.",
        ),
        (
            "Validity",
            "negative_price_usd",
            "reconciled.app_snapshot.price_usd",
            rows,
            F.col("negative_price"),
            "Price cannot be negative.",
            "Invalid prices should be set to NULL or corrected from source if possible.",
        ),
        (
            "Validity",
            "negative_size_bytes",
            "reconciled.app_snapshot.size_bytes",
            rows,
            F.col("negative_size"),
            "Application size in bytes cannot be negative.",
            "Invalid sizes should be set to NULL and logged.",
        ),
        (
            "Validity",
            "invalid_domain_values_after_load",
            "reconciled domain tables",
            F.col("category_rows") + F.col("app_type_rows") + F.col("content_rating_rows"),
            F.col("bad_categories") + F.col("bad_app_types") + F.col("bad_content_ratings"),
            "Domain tables should not contain shifted row values or textual null markers.",
            "If issues exist, fix domain-load filters and rerun the reconciled load.",
        ),
        (
            "Consistency",
            "type_price_conflict",
            "reconciled.app_snapshot + reconciled.app_type",
            rows,
            F.col("conflicts"),
            "Free apps should have price 0. Paid apps should usually have price greater than 0.",
            "Rows with Type/Price conflicts should be flagged and inspected.",
        ),
        (
            "Consistency",
            "snapshot_without_genre",
            "reconciled.app_snapshot vs reconciled.app_snapshot_genre",
            rows,
            F.col("without_genre"),
            "Each snapshot should have at least one genre according to the source dataset.",
            "If missing, inspect raw Genres and bridge ETL.",
        ),
        (
            "Consistency",
            "orphan_snapshot_genre_rows",
            "reconciled.app_snapshot_genre foreign-key consistency",
            F.col("bridge_rows"),
            F.col("orphan_rows"),
            "Bridge rows must reference existing snapshots and existing genres.",
            "Orphan bridge rows must be removed before DW loading.",
        ),
        (
            "Timeliness",
            "future_last_updated_date",
            "reconciled.app_snapshot.last_updated_date",
            rows,
            F.col("future_date"),
            "Last updated date should not be in the future.",
            "Future dates should be corrected if source evidence exists, otherwise nullified and logged.",
        ),
        (
            "Timeliness",
            "last_updated_date_missing",
            "reconciled.app_snapshot.last_updated_date",
            rows,
            F.col("date_missing"),
            "Last updated date supports the time dimension and should be present.",
            "Missing update dates must be investigated before DW loading.",
        ),
        (
            "Accuracy",
            "external_ground_truth_not_available",
            f"{cfg.source_name} source values",
            nothing,
            nothing,
            f"Accuracy cannot be fully verified without an external trusted source such as current {cfg.source_name} metadata.",
            "Document this limitation. Use validity, consistency, and outlier checks as internal proxies only.",
        ),
    ]
    return [Metric(*line) for line in lines]
