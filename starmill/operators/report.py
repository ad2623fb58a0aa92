"""Counts, scorecards and PASS/FAIL rows, each table scanned once.

A report first takes all its measures: one aggregate per table, every condition a filtered count
inside it. The few resulting numbers become one row, over which the report's lines are plain
expressions, so a line may compare numbers of several tables without joining them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions.numbers import score, severity

NUMBER = "decimal(38,12)"


@dataclass(frozen=True)
class Measure:
    """A named aggregate over one table."""

    name: str
    table: str
    value: Column


@dataclass(frozen=True)
class Metric:
    """A line of a scorecard; ``total`` and ``issues`` are expressions over measures."""

    dimension: str
    metric: str
    checked_object: str | None
    total: Column
    issues: Column
    details: str
    recommendation: str | None = None


@dataclass(frozen=True)
class Check:
    """A PASS/FAIL line; without ``passed`` the two values must be equal."""

    check_id: str
    check_name: str
    expected: Column
    actual: Column
    passed: Column | None = None


def measure(tables: dict[str, DataFrame], measures: Sequence[Measure]) -> DataFrame:
    """One row holding every measure."""
    long = []
    for table in dict.fromkeys(m.table for m in measures):
        own = [m for m in measures if m.table == table]
        row = tables[table].agg(*[m.value.cast(NUMBER).alias(m.name) for m in own])
        pairs = [F.struct(F.lit(m.name).alias("name"), F.col(m.name).alias("value")) for m in own]
        long.append(row.select(F.inline(F.array(*pairs))))
    values = reduce(DataFrame.unionByName, long)
    return values.agg(
        *[F.max(F.when(F.col("name") == m.name, F.col("value"))).alias(m.name) for m in measures]
    )


def metric_rows(measured: DataFrame, names: Sequence[str]) -> DataFrame:
    """(metric, value) with the value as text."""
    return _lines(
        measured,
        [
            F.struct(
                F.lit(name).alias("metric"), _whole(F.col(name)).cast("string").alias("value")
            )
            for name in names
        ],
    )


def scorecard(measured: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """Score and traffic light of every metric."""
    lines = _lines(
        measured,
        [
            F.struct(
                F.lit(m.dimension).alias("dimension"),
                F.lit(m.metric).alias("metric"),
                F.lit(m.checked_object).cast("string").alias("checked_object"),
                _whole(m.total).alias("total_checked"),
                _whole(m.issues).alias("issue_count"),
                F.lit(m.details).alias("details"),
                F.lit(m.recommendation).cast("string").alias("recommendation"),
            )
            for m in metrics
        ],
    )
    scored = lines.withColumn("score", score(F.col("issue_count"), F.col("total_checked")))
    return scored.withColumn("severity", severity(F.col("score"))).select(
        "dimension",
        "metric",
        "checked_object",
        "total_checked",
        "issue_count",
        "score",
        "severity",
        "details",
        "recommendation",
    )


def run_checks(measured: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check_id, check_name, expected, actual, status); an unknown outcome is a FAIL."""
    lines = []
    for c in checks:
        passed = c.expected == c.actual if c.passed is None else c.passed
        lines.append(
            F.struct(
                F.lit(c.check_id).alias("check_id"),
                F.lit(c.check_name).alias("check_name"),
                c.expected.cast(NUMBER).alias("expected"),
                c.actual.cast(NUMBER).alias("actual"),
                F.when(passed, "PASS").otherwise("FAIL").alias("status"),
            )
        )
    return _lines(measured, lines)


def row_count() -> Column:
    return F.count("*")


def duplicate_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys with ``key_rows``, the number of rows that share each."""
    return df.groupBy(*keys).agg(F.count("*").alias("key_rows"))


def keys_counts(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """``key_no`` and ``key_rows``: for each of several keys, how many rows share each of its
    values, those with a NULL left out.

    All keys are counted in one pass, as rows tagged by the number of their key. A single one is
    grouped by its own columns, which needs no shuffle of a table that is bucketed by one of them.
    """
    if len(keys) == 1:
        counts = duplicate_counts(df.dropna(subset=list(keys[0])), list(keys[0]))
        return counts.select(F.lit(0).alias("key_no"), "key_rows")

    def value(no: int, columns: Sequence[str]) -> Column:
        whole = F.lit(True)
        for c in columns:
            whole = whole & F.col(c).isNotNull()
        cells = F.array(*[F.col(c).cast("string") for c in columns])
        return F.when(whole, F.struct(F.lit(no).alias("key_no"), cells.alias("key_value")))

    tagged = F.inline(F.array_compact(F.array(*[value(no, key) for no, key in enumerate(keys)])))
    counts = duplicate_counts(df.select(tagged), ["key_no", "key_value"])
    return counts.select("key_no", "key_rows")


def duplicate_excess(key_no: int | None = None) -> Column:
    """Rows beyond the first of their key, over :func:`duplicate_counts` or, of one of the keys,
    over :func:`keys_counts`."""
    surplus = F.col("key_rows") - 1
    if key_no is not None:
        surplus = F.when(F.col("key_no") == key_no, surplus)
    return F.coalesce(F.sum(surplus), F.lit(0))


def duplicate_keys() -> Column:
    """Keys that occur more than once, over :func:`duplicate_counts`."""
    return F.count_if(F.col("key_rows") > 1)


def orphans(child: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """(key, key_rows) of the child keys the parent lacks, a NULL key among them.

    Child rows are folded per key before they meet the parent, so a key that holds a large part
    of the rows moves as one row per task.
    """
    folded = duplicate_counts(child.select(key), [key])
    return folded.join(parent.select(key), key, "left_anti")


def orphan_rows() -> Column:
    """Child rows without a parent, over :func:`orphans`."""
    return F.coalesce(F.sum("key_rows"), F.lit(0))


def _whole(c: Column) -> Column:
    return c.cast("bigint")


def _lines(measured: DataFrame, lines: Sequence[Column]) -> DataFrame:
    return measured.select(F.inline(F.array(*lines)))
