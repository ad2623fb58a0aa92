"""Dimensions, fact and weighted bridge of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.keys import dense_key

# The technical member for missing references.
UNKNOWN_NAME = "Unknown"
UNKNOWN_NORM = "unknown"

FACT_MEASURES = ("rating", "reviews_count", "installs_count", "price_usd", "size_bytes")
FACT_FLAGS = (
    "rating_missing_flag",
    "size_missing_flag",
    "size_varies_with_device_flag",
    "app_type_missing_flag",
    "current_version_missing_flag",
    "android_version_missing_flag",
    "multiple_genre_flag",
)
ENTITY_DIMENSIONS = ("app", "category", "app_type", "content_rating")


def build_dim(master: DataFrame, entity: str, unknown: bool = False) -> DataFrame:
    """Master rows under a dense key in id order, plus an Unknown member on request."""
    columns = [f"{entity}_id", f"{entity}_name", f"{entity}_name_norm"]
    dim = dense_key(master.select(*columns), f"{entity}_key", [columns[0]])
    if not unknown:
        return dim
    member = master.agg((F.count("*") + 1).cast("bigint").alias(f"{entity}_key")).select(
        f"{entity}_key",
        F.lit(None).cast("bigint").alias(columns[0]),
        F.lit(UNKNOWN_NAME).alias(columns[1]),
        F.lit(UNKNOWN_NORM).alias(columns[2]),
    )
    return dim.unionByName(member)


def build_date_dim(df: DataFrame, column: str, unknown: bool = False) -> DataFrame:
    """Distinct days of ``column`` with their calendar parts, plus an Unknown member without a
    day on request."""
    days = (
        df.where(F.col(column).isNotNull())
        .select(F.col(column).alias("full_date"))
        .distinct()
        .withColumn("_day", F.unix_date("full_date").cast("bigint"))
    )
    day = F.col("full_date")
    dim = dense_key(days, "last_updated_date_key", ["_day"]).select(
        "last_updated_date_key",
        "full_date",
        F.dayofmonth(day).cast("smallint").alias("day"),
        F.month(day).cast("smallint").alias("month"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.year(day).alias("year"),
        F.date_format(day, "MMMM").alias("month_name"),
    )
    if not unknown:
        return dim
    parts = [F.lit(None).cast(kind).alias(name) for name, kind in dim.dtypes[1:-1]]
    key = (F.count("*") + 1).cast("bigint").alias("last_updated_date_key")
    member = days.agg(key).select("*", *parts, F.lit(UNKNOWN_NAME).alias("month_name"))
    return dim.unionByName(member)


def build_fact(
    clean: DataFrame, dims: dict[str, DataFrame], unknown: Sequence[str] = ("app_type",)
) -> DataFrame:
    """Clean snapshots with their dimension keys.

    Rows whose category, content rating or date is missing drop out, unless that dimension has
    an Unknown member; the integrity checks count what was lost. The Unknown key is one scalar,
    not a join. The fact is keyed by its snapshot, which needs no numbering of the largest table.

    Measures and flags stay where the clean rows are: only :func:`dimension_keys` goes through
    lookups, and what it found meets them on the snapshot, on the partitioning by that id.
    """
    found = dimension_keys(clean, dims, unknown).hint("merge")
    fact = clean.join(found, "snapshot_id").withColumn("app_snapshot_key", F.col("snapshot_id"))
    return fact.select(
        "app_snapshot_key",
        "snapshot_id",
        "raw_id",
        *[f"{entity}_key" for entity in ENTITY_DIMENSIONS],
        "last_updated_date_key",
        *FACT_MEASURES,
        *FACT_FLAGS,
        "dq_status",
    )


def dimension_keys(
    clean: DataFrame, dims: dict[str, DataFrame], unknown: Sequence[str] = ("app_type",)
) -> DataFrame:
    """``snapshot_id`` and dimension keys of the clean snapshots that become facts. Each id gives
    way to its key as soon as it is looked up."""
    ids = [f"{entity}_id" for entity in ENTITY_DIMENSIONS]
    fact = clean.select("snapshot_id", *ids, "last_updated_date")
    for entity in ("category", "app_type", "content_rating", "app"):
        keys = dims[entity].select(f"{entity}_id", f"{entity}_key")
        if entity in unknown:
            fact = fact.join(keys.where(F.col(f"{entity}_id").isNotNull()), f"{entity}_id", "left")
            key = F.coalesce(f"{entity}_key", _unknown_key(dims[entity], entity))
            fact = fact.withColumn(f"{entity}_key", key).where(
                F.col(f"{entity}_key").isNotNull()
            )
        else:
            fact = fact.join(keys, f"{entity}_id")
        fact = fact.drop(f"{entity}_id")
    dates = dims["last_updated_date"].select(
        F.col("full_date").alias("last_updated_date"), "last_updated_date_key"
    )
    if "last_updated_date" in unknown:
        none = dims["last_updated_date"].where(F.col("full_date").isNull())
        fact = fact.join(dates, "last_updated_date", "left").withColumn(
            "last_updated_date_key",
            F.coalesce("last_updated_date_key", none.select("last_updated_date_key").scalar()),
        )
    else:
        fact = fact.join(dates, "last_updated_date")
    return fact.drop("last_updated_date")


def build_dw_bridge(clean_bridge: DataFrame, fact: DataFrame, dim_genre: DataFrame) -> DataFrame:
    """Weighted bridge on warehouse keys, for the snapshots that reached the fact.

    The fact joins last: the rows stay on the partitioning by snapshot.
    """
    return (
        clean_bridge.join(dim_genre.select("genre_id", "genre_key"), "genre_id")
        .join(fact.select("snapshot_id", "app_snapshot_key"), "snapshot_id")
        .select("app_snapshot_key", "genre_key", "weight")
    )


def _unknown_key(dim: DataFrame, entity: str) -> Column:
    """Key of the technical member; a source member that is called the same has an id."""
    technical = F.col(f"{entity}_id").isNull() & (F.col(f"{entity}_name_norm") == UNKNOWN_NORM)
    return dim.where(technical).select(f"{entity}_key").scalar()
