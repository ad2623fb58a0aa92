"""Snapshots and facts with the names behind their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.star import FACT_FLAGS, FACT_MEASURES

# Raw columns that the view calls by a longer name.
NO_CELLS = ("raw_id", "imported_at", "malformed_line")
LONG_NAMES = {"current_ver": "current_version", "android_ver": "android_version"}


def enrich_snapshot(
    snapshot: DataFrame, masters: dict[str, DataFrame], raw: DataFrame
) -> DataFrame:
    """Snapshots with master names and the raw text of every cell.

    The raw text joins first, on the row id both tables are bucketed by; the app master joins
    last, as it may be large.
    """
    texts = {
        c: f"raw_{LONG_NAMES.get(c, c)}" for c in raw.columns if c not in NO_CELLS
    }
    cells = [F.col(c).alias(name) for c, name in texts.items()]
    rows = snapshot.join(raw.select("raw_id", *cells), "raw_id", "left")
    for entity in ("category", "app_type", "content_rating", "app"):
        rows = rows.join(masters[entity], f"{entity}_id", "left")
    names = [
        f"{entity}_{part}"
        for entity in ("app", "category", "app_type", "content_rating")
        for part in ("id", "name", "name_norm")
    ]
    rest = [c for c in snapshot.columns if not c.endswith("_id")]
    return rows.select("snapshot_id", "raw_id", *names, *rest, *texts.values())


def enrich_fact(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Facts with dimension names and calendar parts instead of keys."""
    rows = fact
    for entity in ("category", "app_type", "content_rating", "app"):
        rows = rows.join(dims[entity].select(f"{entity}_key", f"{entity}_name"), f"{entity}_key")
    dates = dims["last_updated_date"].select(
        "last_updated_date_key",
        F.col("full_date").alias("last_updated_date"),
        "day",
        "month",
        "quarter",
        "year",
    )
    return rows.join(dates, "last_updated_date_key").select(
        "app_snapshot_key",
        "snapshot_id",
        "raw_id",
        "app_name",
        "category_name",
        "app_type_name",
        "content_rating_name",
        "last_updated_date",
        "day",
        "month",
        "quarter",
        "year",
        *FACT_MEASURES,
        *FACT_FLAGS,
        "dq_status",
    )


def issue_rows(enriched: DataFrame, rule: Column) -> DataFrame:
    """Rows a rule finds wanting."""
    return enriched.where(rule)


def not_loaded(raw: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Landing rows that gave no snapshot."""
    return raw.join(snapshot.select("raw_id"), "raw_id", "left_anti")
