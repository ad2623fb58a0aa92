"""Constraints of any DataFrame as one row: ``constraint_name`` and the number of ``violations``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.operators.report import duplicate_counts, orphan_rows, orphans


def assert_unique(df: DataFrame, *columns: str, name: str | None = None) -> DataFrame:
    """Rows beyond the first of their key; keys with a NULL are exempt."""
    counts = duplicate_counts(df.dropna(subset=list(columns)), list(columns))
    value = F.coalesce(F.sum(F.col("key_rows") - 1), F.lit(0))
    return _line(counts, value, name or f"unique({', '.join(columns)})")


def assert_fk(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str | None = None
) -> DataFrame:
    """Rows of ``child`` whose key ``parent`` lacks; NULL keys are exempt."""
    keys = parent.select(F.col(parent_key).alias(key))
    missing = orphans(child.dropna(subset=[key]), key, keys)
    return _line(missing, orphan_rows(), name or f"foreign key {key} in {parent_key}")


def assert_check(df: DataFrame, condition: str, name: str | None = None) -> DataFrame:
    """Rows that fail a condition; an unknown outcome passes."""
    return _line(df, F.count_if(~F.expr(condition)), name or f"check {condition}")


def assert_not_null(df: DataFrame, *columns: str, name: str | None = None) -> DataFrame:
    """Rows in which one of the columns is NULL."""
    empty = F.lit(False)
    for column in columns:
        empty = empty | F.col(column).isNull()
    return _line(df, F.count_if(empty), name or f"not null({', '.join(columns)})")


def _line(df: DataFrame, value, name: str) -> DataFrame:
    return df.agg(value.cast("bigint").alias("violations")).select(
        F.lit(name).alias("constraint_name"), "violations"
    )
