"""The named views over the layers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmill.operators.audit import audit_summary
from starmill.operators.bridge import genre_histogram, weight_errors, weight_preview
from starmill.operators.enrich import not_loaded
from starmill.plans import analysis, quality, verification
from starmill.plans.layers import Layers
from starmill.sources.exports import export_csv


def weight_preview_check(ly: Layers) -> DataFrame:
    return weight_errors(
        weight_preview(ly["bridge"], ly["genre"]),
        "snapshot_id",
        ly.config.preview_weight_tolerance,
        "future_dw_bridge_weight",
    ).drop("weight_error")


def _issue(name: str) -> Callable[[Layers], DataFrame]:
    return lambda ly: quality.issue_view(ly, name)


# Schema and name of each view.
VIEWS: dict[str, Callable[[Layers], DataFrame]] = {
    "dq.v_reconciliation_counts": quality.reconciliation_counts,
    "dq.v_app_snapshot_enriched": quality.enriched_snapshot,
    "dq.v_dqa_baseline_scorecard": quality.baseline_scorecard,
    "dq.v_issue_missing_rating": _issue("missing_rating"),
    "dq.v_issue_missing_size": _issue("missing_size"),
    "dq.v_issue_missing_app_type": _issue("missing_app_type"),
    "dq.v_issue_type_price_conflict": _issue("type_price_conflict"),
    "dq.v_issue_invalid_measures": _issue("invalid_measures"),
    "dq.v_issue_raw_rows_not_loaded": lambda ly: not_loaded(ly["raw"], ly["snapshot"]),
    "dq.v_genre_distribution_per_snapshot": lambda ly: genre_histogram(
        ly["snapshot"], ly["bridge"]
    ),
    "dq.v_snapshot_genre_weight_preview": lambda ly: weight_preview(ly["bridge"], ly["genre"]),
    "dq.v_snapshot_genre_weight_check": weight_preview_check,
    "clean.v_cleaning_summary": quality.cleaning_summary,
    "clean.v_audit_summary_by_issue_type": lambda ly: audit_summary(ly["audit_log"]),
    "clean.v_bridge_weight_check": verification.clean_weight_errors,
    "clean.v_dqa_after_cleaning_scorecard": quality.after_cleaning_scorecard,
    "dw.v_fact_app_snapshot_enriched": analysis.enriched_fact,
    "dw.v_genre_fractional_analysis": analysis.genre_fractional,
    "dw.v_genre_membership_analysis": analysis.genre_membership,
    "dw.v_bridge_weight_check": verification.dw_weight_errors,
    "dw.v_dw_load_summary": verification.load_summary,
    "dw.v_dw_integrity_checks": verification.integrity_checks,
    "dw.v_genre_weighted_kpis": analysis.genre_weighted_kpis,
}


def register_views(spark: SparkSession, ly: Layers) -> list[str]:
    """Make every view a temporary view named ``schema_view``, for use from SQL."""
    names = []
    for name, view in VIEWS.items():
        temp = name.replace(".", "_")
        view(ly).createOrReplaceTempView(temp)
        names.append(temp)
    return names


def export_views(ly: Layers, folder: str, names: list[str] | None = None) -> None:
    """Write views as CSV folders named like them, for BI tools."""
    for name in names or list(VIEWS):
        export_csv(VIEWS[name](ly), f"{folder.rstrip('/')}/{name}")
