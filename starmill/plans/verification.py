"""PASS/FAIL checks over the layers, and the constraints the tables must meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.bridge import weight_errors
from starmill.operators.enrich import not_loaded
from starmill.operators.kpi import genre_weighted_kpis
from starmill.operators.report import (
    Check,
    Measure,
    duplicate_counts,
    duplicate_excess,
    duplicate_keys,
    keys_counts,
    measure,
    metric_rows,
    orphan_rows,
    orphans,
    row_count,
    run_checks,
)
from starmill.operators.star import UNKNOWN_NORM
from starmill.plans.layers import DIMENSIONS, MASTERS, TABLES, Layers
from starmill.plans.quality import after_cleaning_scorecard, unflagged_measures

# Flags with a rule in the audit log.
LOGGED_FLAGS = (
    "rating_missing_flag",
    "size_missing_flag",
    "app_type_missing_flag",
    "current_version_missing_flag",
    "android_version_missing_flag",
    "type_price_conflict_flag",
    "invalid_measure_flag",
    "multiple_genre_flag",
)


def clean_weight_errors(ly: Layers) -> DataFrame:
    return weight_errors(ly["clean_bridge"], "snapshot_id", ly.config.weight_tolerance)


def dw_weight_errors(ly: Layers) -> DataFrame:
    return weight_errors(ly["dw_bridge"], "app_snapshot_key", ly.config.weight_tolerance)


def load_summary(ly: Layers) -> DataFrame:
    """12 row counts of the star schema, the fact scanned once."""
    tables = {f"dim_{d}": ly[f"dim_{d}"] for d in DIMENSIONS}
    tables |= {"fact": _fact_with_unknown(ly), "dw_bridge": ly["dw_bridge"]}
    measures = [
        *[Measure(f"dim_{d}_rows", f"dim_{d}", row_count()) for d in DIMENSIONS],
        Measure("fact_app_snapshot_rows", "fact", row_count()),
        Measure("bridge_app_snapshot_genre_rows", "dw_bridge", row_count()),
        Measure("unknown_app_type_fact_rows", "fact", F.count_if("is_unknown")),
        Measure("fact_rating_missing_flag_rows", "fact", F.count_if("rating_missing_flag")),
        Measure("fact_size_missing_flag_rows", "fact", F.count_if("size_missing_flag")),
        Measure("fact_multiple_genre_flag_rows", "fact", F.count_if("multiple_genre_flag")),
    ]
    return metric_rows(measure(tables, measures), [m.name for m in measures])


def integrity_checks(ly: Layers) -> DataFrame:
    """5 checks of the warehouse load: (check_name, expected_value, actual_value, status)."""
    tables = {name: ly[name] for name in ("clean", "clean_bridge", "fact", "dw_bridge")}
    tables["weight_errors"] = dw_weight_errors(ly)
    tables["fact_ids"] = duplicate_counts(ly["fact"], ["snapshot_id"])
    measures = [
        *_row_counts("clean", "clean_bridge", "fact", "dw_bridge", "weight_errors"),
        Measure("duplicate_facts", "fact_ids", duplicate_keys()),
        Measure("error_review", "fact", F.count_if(F.col("dq_status") == "ERROR_REVIEW")),
    ]
    none = F.lit(0)
    c = F.col
    # Check names.
    checks = [
        Check("1", "fact_rows_match_clean_rows", c("clean_rows"), c("fact_rows")),
        Check(
            "2",
            "bridge_rows_match_clean_bridge_rows",
            c("clean_bridge_rows"),
            c("dw_bridge_rows"),
        ),
        Check("3", "genre_bridge_weight_errors", none, c("weight_errors_rows")),
        Check("4", "fact_duplicate_snapshot_id", none, c("duplicate_facts")),
        Check("5", "fact_error_review_rows", none, c("error_review")),
    ]
    return run_checks(measure(tables, measures), checks).select(
        "check_name",
        F.col("expected").alias("expected_value"),
        F.col("actual").alias("actual_value"),
        "status",
    )


def count_checks(ly: Layers) -> DataFrame:
    """Rows carried from layer to layer."""
    names = (
        "raw", "snapshot", "clean", "bridge", "clean_bridge", "fact", "dw_bridge", *MASTERS,
        "genre", *[f"dim_{d}" for d in DIMENSIONS],
    )
    tables = {name: ly[name] for name in names}
    tables["dates"] = (
        ly["clean"].select("last_updated_date").where("last_updated_date is not null").distinct()
    )
    tables["source"] = ly.source
    c, cfg = F.col, ly.config
    name = F.trim("app")
    loadable = Measure(
        "loadable_rows", "raw", F.count_if((name != "") & ~name.isin(*cfg.app_sentinels))
    )
    given = lambda number, found: c(found) if number is None else F.lit(number)

    def members(entity: str) -> Column:
        """Rows the dimension must have: its master's, and the Unknown one if it has that."""
        return c(f"{entity}_rows") + int(entity in cfg.unknown_members)

    # Check ids and names.
    checks = [
        Check(
            "P2-COUNT-01",
            "raw rows are preserved",
            given(cfg.expected_raw_rows, "source_rows"),
            c("raw_rows"),
        ),
        Check(
            "P2-COUNT-02",
            "reconciled snapshot rows",
            given(cfg.expected_snapshot_rows, "loadable_rows"),
            c("snapshot_rows"),
        ),
        Check(
            "P2-COUNT-03",
            "clean snapshot rows match reconciled snapshot rows",
            c("snapshot_rows"),
            c("clean_rows"),
        ),
        Check(
            "P2-COUNT-04",
            "clean bridge rows match reconciled bridge rows",
            c("bridge_rows"),
            c("clean_bridge_rows"),
        ),
        Check(
            "P2-COUNT-05", "fact rows match clean snapshot rows", c("clean_rows"), c("fact_rows")
        ),
        Check(
            "P2-COUNT-06",
            "dw bridge rows match clean bridge rows",
            c("clean_bridge_rows"),
            c("dw_bridge_rows"),
        ),
        Check(
            "P2-COUNT-07", "dim_app rows match reconciled.app rows", members("app"), c("dim_app_rows")
        ),
        Check(
            "P2-COUNT-08",
            "dim_category rows match reconciled.category rows",
            members("category"),
            c("dim_category_rows"),
        ),
        Check(
            "P2-COUNT-09",
            "dim_app_type rows include Unknown technical row",
            members("app_type"),
            c("dim_app_type_rows"),
        ),
        Check(
            "P2-COUNT-10",
            "dim_content_rating rows match reconciled.content_rating rows",
            members("content_rating"),
            c("dim_content_rating_rows"),
        ),
        Check(
            "P2-COUNT-11",
            "dim_genre rows match reconciled.genre rows",
            c("genre_rows"),
            c("dim_genre_rows"),
        ),
        Check(
            "P2-COUNT-12",
            "dim_last_updated_date rows match distinct clean dates",
            c("dates_rows") + int("last_updated_date" in cfg.unknown_members),
            c("dim_last_updated_date_rows"),
        ),
    ]
    measures = [*_row_counts(*tables), loadable]
    return run_checks(measure(tables, measures), checks).orderBy("check_id")


def cleaning_checks(ly: Layers) -> DataFrame:
    """Nothing missing is unmarked, nothing wrong remains, every flag is logged."""
    logged = sum((F.count_if(flag) for flag in LOGGED_FLAGS), F.lit(0))
    measures = [
        *unflagged_measures(),
        Measure("invalid", "clean", F.count_if("invalid_measure_flag")),
        Measure("conflicts", "clean", F.count_if("type_price_conflict_flag")),
        Measure("without_genre", "clean", F.count_if("genre_missing_flag")),
        Measure("logged_flags", "clean", logged),
        Measure("error_review", "clean", F.count_if(F.col("dq_status") == "ERROR_REVIEW")),
        Measure("log_rows", "audit_log", row_count()),
    ]
    tables = {"clean": ly["clean"], "audit_log": ly["audit_log"]}
    c, none = F.col, F.lit(0)
    # Check ids and names.
    checks = [
        Check("P2-CLEAN-01", "NULL ratings are flagged", none, c("unflagged_rating")),
        Check("P2-CLEAN-02", "NULL sizes are flagged", none, c("unflagged_size")),
        Check("P2-CLEAN-03", "missing app types are flagged", none, c("unflagged_app_type")),
        Check("P2-CLEAN-04", "invalid measures remaining", none, c("invalid")),
        Check("P2-CLEAN-05", "type price conflicts remaining", none, c("conflicts")),
        Check("P2-CLEAN-06", "snapshots without genre remaining", none, c("without_genre")),
        Check(
            "P2-CLEAN-07",
            "audit log rows match all logged flag rows",
            c("logged_flags"),
            c("log_rows"),
        ),
        Check("P2-CLEAN-08", "ERROR_REVIEW rows after cleaning", none, c("error_review")),
    ]
    return run_checks(measure(tables, measures), checks).orderBy("check_id")


def bridge_checks(ly: Layers) -> DataFrame:
    """Both ends of the clean bridge exist, pairs are unique, weights are shares of one."""
    bridge = ly["clean_bridge"]
    tables = {
        "no_snapshot": orphans(bridge, "snapshot_id", ly["clean"]),
        "no_genre": orphans(bridge, "genre_id", ly["genre"]),
        "pairs": duplicate_counts(bridge, ["snapshot_id", "genre_id"]),
        "clean_bridge": bridge,
        "weight_errors": clean_weight_errors(ly),
    }
    weight = F.col("weight")
    measures = [
        Measure("no_snapshot", "no_snapshot", orphan_rows()),
        Measure("no_genre", "no_genre", orphan_rows()),
        Measure("double_pairs", "pairs", duplicate_keys()),
        Measure("bad_weights", "clean_bridge", F.count_if((weight <= 0) | (weight > 1))),
        Measure("weight_errors", "weight_errors", row_count()),
    ]
    c, none = F.col, F.lit(0)
    # Check ids and names.
    checks = [
        Check("P2-BRIDGE-01", "clean bridge orphan snapshot rows", none, c("no_snapshot")),
        Check("P2-BRIDGE-02", "clean bridge orphan genre rows", none, c("no_genre")),
        Check("P2-BRIDGE-03", "duplicate clean bridge pairs", none, c("double_pairs")),
        Check("P2-BRIDGE-04", "invalid clean bridge weights", none, c("bad_weights")),
        Check("P2-BRIDGE-05", "clean bridge weight sum errors", none, c("weight_errors")),
    ]
    return run_checks(measure(tables, measures), checks).orderBy("check_id")


def warehouse_checks(ly: Layers) -> DataFrame:
    """Every key of the fact and its bridge leads somewhere; Unknown rows are accounted for."""
    fact, bridge = ly["fact"], ly["dw_bridge"]
    # Check ids and names.
    dangling = [
        ("P2-DW-01", "fact orphan app_key rows", "app_key", "dim_app"),
        ("P2-DW-02", "fact orphan category_key rows", "category_key", "dim_category"),
        ("P2-DW-03", "fact orphan app_type_key rows", "app_type_key", "dim_app_type"),
        (
            "P2-DW-04",
            "fact orphan content_rating_key rows",
            "content_rating_key",
            "dim_content_rating",
        ),
        (
            "P2-DW-05",
            "fact orphan date_key rows",
            "last_updated_date_key",
            "dim_last_updated_date",
        ),
        ("P2-DW-06", "bridge orphan fact rows", "app_snapshot_key", "fact"),
        ("P2-DW-07", "bridge orphan genre rows", "genre_key", "dim_genre"),
    ]
    tables, measures, checks = {}, [], []
    for check_id, name, key, parent in dangling:
        child = bridge if key in bridge.columns else fact
        tables[key] = orphans(child, key, ly[parent])
        measures.append(Measure(f"orphan_{key}", key, orphan_rows()))
        checks.append(Check(check_id, name, F.lit(0), F.col(f"orphan_{key}")))
    tables |= {
        "fact_ids": duplicate_counts(fact, ["snapshot_id"]),
        "fact": _fact_with_unknown(ly),
        "clean": ly["clean"],
    }
    measures += [
        Measure("double_facts", "fact_ids", duplicate_keys()),
        Measure("unknown_facts", "fact", F.count_if("is_unknown")),
        Measure("missing_types", "clean", F.count_if("app_type_missing_flag")),
    ]
    checks += [
        Check("P2-DW-08", "duplicate fact snapshot_id rows", F.lit(0), F.col("double_facts")),
        Check(
            "P2-DW-09",
            "unknown app type fact rows match clean missing app type rows",
            F.col("missing_types"),
            F.col("unknown_facts"),
        ),
    ]
    return run_checks(measure(tables, measures), checks).orderBy("check_id")


def weight_checks(ly: Layers, relative: bool = True) -> DataFrame:
    """Weighted totals over the bridge equal plain totals over the fact.

    Each snapshot's weights are rounded, so the gap grows with the number of snapshots: the
    tolerances apply per snapshot and per million units. Without ``relative`` they apply to the
    whole table, and fail by rounding alone at some millions of snapshots.
    """
    cfg = ly.config
    tables = {
        "weight_errors": dw_weight_errors(ly),
        "fact": ly["fact"],
        "dw_bridge": ly["dw_bridge"],
        "genres": genre_weighted_kpis(ly["fact"], ly["dw_bridge"], ly["dim_genre"]),
    }
    total = lambda c: F.coalesce(F.sum(F.col(c).cast("decimal(25,0)")), F.lit(0))
    weighted = lambda c: F.coalesce(F.sum(c), F.lit(0))
    measures = [
        *_row_counts("weight_errors", "fact"),
        Measure("weights", "dw_bridge", F.sum("weight")),
        Measure("reviews", "fact", total("reviews_count")),
        Measure("installs", "fact", total("installs_count")),
        Measure("weighted_reviews", "genres", weighted("weighted_reviews_count")),
        Measure("weighted_installs", "genres", weighted("weighted_installs_count")),
    ]
    c = F.col

    def within(value: str, expected: str, tolerance: Column, per: Column) -> Column:
        gap = F.abs(c(value) - c(expected))
        return gap <= (tolerance * F.greatest(per, F.lit(1)) if relative else tolerance)

    rows_tolerance = F.lit(f"{cfg.weight_tolerance:.12f}").cast("decimal(13,12)")
    unit_tolerance = F.lit(cfg.measure_tolerance).cast("decimal(10,0)")
    millions = lambda name: (c(name) / F.lit(1_000_000)).cast("decimal(26,0)")
    # Check ids and names.
    checks = [
        Check(
            "P2-WEIGHT-01", "dw bridge weight sum errors", F.lit(0), c("weight_errors_rows")
        ),
        Check(
            "P2-WEIGHT-02",
            "weighted snapshot count equals fact row count",
            c("fact_rows"),
            F.round("weights", 6),
            within("weights", "fact_rows", rows_tolerance, c("fact_rows").cast("decimal(20,0)")),
        ),
        Check(
            "P2-WEIGHT-03",
            "weighted reviews equal fact reviews",
            c("reviews"),
            F.round("weighted_reviews", 6),
            within("weighted_reviews", "reviews", unit_tolerance, millions("reviews")),
        ),
        Check(
            "P2-WEIGHT-04",
            "weighted installs equal fact installs",
            c("installs"),
            F.round("weighted_installs", 6),
            within("weighted_installs", "installs", unit_tolerance, millions("installs")),
        ),
    ]
    return run_checks(measure(tables, measures), checks).orderBy("check_id")


def must_be_empty(ly: Layers) -> dict[str, DataFrame]:
    """Sets that hold a row only when something is wrong."""
    return {
        "clean_weight_errors": clean_weight_errors(ly),
        "dw_weight_errors": dw_weight_errors(ly),
        "non_green_metrics": after_cleaning_scorecard(ly).where(
            ~F.col("severity").isin("GREEN", "INFO")
        ),
        "integrity_failures": integrity_checks(ly).where(F.col("status") != "PASS"),
    }


def must_be_empty_rows(ly: Layers) -> DataFrame:
    """(set_name, row_count) of :func:`must_be_empty`."""
    sets = must_be_empty(ly)
    measured = measure(sets, [Measure(name, name, row_count()) for name in sets])
    return metric_rows(measured, list(sets)).select(
        F.col("metric").alias("set_name"), F.col("value").cast("bigint").alias("row_count")
    )


def stage_one_checks(ly: Layers) -> DataFrame:
    """Evidence after the reconciled load, as (metric, value)."""
    cfg = ly.config
    c = F.col
    tables = {
        **{name: ly[name] for name in ("raw", *MASTERS, "snapshot", "genre", "bridge")},
        "not_loaded": not_loaded(ly["raw"], ly["snapshot"]),
        "bridge_snapshots": ly["bridge"].select("snapshot_id").distinct(),
        "no_snapshot": orphans(ly["bridge"], "snapshot_id", ly["snapshot"]),
        "no_genre": orphans(ly["bridge"], "genre_id", ly["genre"]),
    }
    sentinel_norms = [s.lower() for s in cfg.app_sentinel_prefixes or cfg.app_sentinels]
    foreign = ("app_id", "category_id", "app_type_id", "content_rating_id")
    dirty_category = c("category_name_norm").isin(*[t for t in cfg.bad_categories if t])
    bad_rating = c("rating").isNotNull() & ((c("rating") < 0) | (c("rating") > 5))
    bad_genre = c("genre_name_norm").rlike(cfg.date_like) | c("genre_name_norm").isin(*cfg.bad_genres)
    measures = [
        Measure("raw_rows", "raw", row_count()),
        Measure(
            "sentinel_raw_rows", "raw", F.count_if(c("category").isin(*cfg.category_sentinels))
        ),
        Measure("category_rows", "category", row_count()),
        Measure("app_type_rows", "app_type", row_count()),
        Measure("content_rating_rows", "content_rating", row_count()),
        Measure("app_rows", "app", row_count()),
        Measure("dirty_categories", "category", F.count_if(dirty_category)),
        Measure(
            "dirty_app_types",
            "app_type",
            F.count_if(~c("app_type_name_norm").isin(cfg.free_type, cfg.paid_type)),
        ),
        Measure(
            "sentinel_apps", "app", F.count_if(_starts_with_any("app_name_norm", sentinel_norms))
        ),
        Measure("app_snapshot_rows", "snapshot", row_count()),
        Measure("excluded_raw_rows", "not_loaded", row_count()),
        *[Measure(f"null_{k}", "snapshot", F.count_if(c(k).isNull())) for k in foreign],
        Measure("bad_rating", "snapshot", F.count_if(bad_rating)),
        Measure("bad_reviews", "snapshot", F.count_if(c("reviews_count") < 0)),
        Measure("bad_size", "snapshot", F.count_if(c("size_bytes") < 0)),
        Measure("bad_installs", "snapshot", F.count_if(c("installs_count") < 0)),
        Measure("bad_price", "snapshot", F.count_if(c("price_usd") < 0)),
        Measure(
            "null_last_updated_date", "snapshot", F.count_if(c("last_updated_date").isNull())
        ),
        Measure("genre_rows", "genre", row_count()),
        Measure("app_snapshot_genre_rows", "bridge", row_count()),
        Measure("snapshots_with_genre", "bridge_snapshots", row_count()),
        Measure("orphan_bridge_snapshots", "no_snapshot", orphan_rows()),
        Measure("orphan_bridge_genres", "no_genre", orphan_rows()),
        Measure("bad_genres", "genre", F.count_if(bad_genre)),
    ]
    return metric_rows(measure(tables, measures), [m.name for m in measures])


def unique_constraints(ly: Layers) -> DataFrame:
    """(constraint_name, violations): rows beyond the first of their key; NULL keys are exempt.

    All keys of a table are counted in one pass, and a key once by whatever name it goes.
    """
    keys = [
        *[(m, [f"{m}_id"]) for m in (*MASTERS, "genre")],
        *[(m, [f"{m}_name_norm"]) for m in (*MASTERS, "genre")],
        ("raw", ["raw_id"]),
        ("snapshot", ["snapshot_id"]),
        ("snapshot", ["raw_id"]),
        ("bridge", ["snapshot_id", "genre_id"]),
        ("clean", ["snapshot_id"]),
        ("clean_bridge", ["snapshot_id", "genre_id"]),
        *[(f"dim_{d}", [f"{d}_key"]) for d in DIMENSIONS],
        *[(f"dim_{m}", [f"{m}_id"]) for m in (*MASTERS, "genre")],
        ("dim_app_type", ["app_type_name"]),
        ("dim_last_updated_date", ["full_date"]),
        ("fact", ["app_snapshot_key"]),
        ("fact", ["snapshot_id"]),
        ("dw_bridge", ["app_snapshot_key", "genre_key"]),
    ]

    def stored(table: str, columns: list[str]) -> tuple[str, ...]:
        same = TABLES[table].equal_to_key
        return tuple(TABLES[table].key if c in same else c for c in columns)

    by_table: dict[str, list[tuple[str, ...]]] = {}
    for table, columns in keys:
        found = by_table.setdefault(table, [])
        if stored(table, columns) not in found:
            found.append(stored(table, columns))
    counted = {table: keys_counts(ly[table], found) for table, found in by_table.items()}
    return _violations(
        {
            f"unique {table}({', '.join(columns)})": (
                counted[table],
                duplicate_excess(by_table[table].index(stored(table, columns))),
            )
            for table, columns in keys
        }
    )


def foreign_key_constraints(ly: Layers) -> DataFrame:
    """(constraint_name, violations): rows whose key the parent lacks; NULL keys are exempt."""
    keys = [
        ("snapshot", "raw_id", "raw"),
        *[("snapshot", f"{m}_id", m) for m in MASTERS],
        ("bridge", "snapshot_id", "snapshot"),
        ("bridge", "genre_id", "genre"),
        ("clean_bridge", "snapshot_id", "clean"),
        ("clean_bridge", "genre_id", "genre"),
        *[("fact", f"{d}_key", f"dim_{d}") for d in (*MASTERS, "last_updated_date")],
        ("dw_bridge", "app_snapshot_key", "fact"),
        ("dw_bridge", "genre_key", "dim_genre"),
    ]
    return _violations(
        {
            f"foreign key {child}({key}) in {parent}": (
                orphans(ly[child].dropna(subset=[key]), key, ly[parent]),
                orphan_rows(),
            )
            for child, key, parent in keys
        }
    )


def check_constraints(ly: Layers) -> DataFrame:
    """(constraint_name, violations): rows that fail a condition; an unknown outcome passes."""
    counts = ("reviews_count", "installs_count", "price_usd", "size_bytes")
    at_least_zero = {c: f"{c} >= 0" for c in counts}
    measures_ok = {"rating": "rating between 0 and 5", **at_least_zero}
    rules = {
        "snapshot": measures_ok,
        "dim_last_updated_date": {
            "day": "day between 1 and 31",
            "month": "month between 1 and 12",
            "quarter": "quarter between 1 and 4",
            "year": "year >= 1900",
        },
        "fact": {**measures_ok, "dq_status": "dq_status in ('OK', 'FLAGGED_OK', 'ERROR_REVIEW')"},
        "dw_bridge": {"weight": "weight > 0 and weight <= 1"},
    }
    return _violations(
        {
            f"check {table}({column})": (ly[table], F.count_if(~F.expr(rule)))
            for table, columns in rules.items()
            for column, rule in columns.items()
        }
    )


def not_null_constraints(ly: Layers) -> DataFrame:
    """(constraint_name, violations): NULLs in columns that must be filled."""
    flags = [c for c in ly["fact"].columns if c.endswith("_flag")]
    filled = {
        **{m: [f"{m}_id", f"{m}_name", f"{m}_name_norm"] for m in (*MASTERS, "genre")},
        "snapshot": ["snapshot_id", "raw_id", "app_id"],
        "bridge": ["snapshot_id", "genre_id"],
        "audit_log": ["table_name", "row_pk", "issue_type", "action", "reason"],
        **{
            f"dim_{m}": [
                f"{m}_key",
                f"{m}_name",
                *([] if m in ly.config.unknown_members else [f"{m}_id"]),
            ]
            for m in (*MASTERS, "genre")
        },
        "dim_last_updated_date": [
            "last_updated_date_key",
            "month_name",
            *(
                []
                if "last_updated_date" in ly.config.unknown_members
                else ["full_date", "day", "month", "quarter", "year"]
            ),
        ],
        "fact": [
            "app_snapshot_key",
            "snapshot_id",
            *[f"{d}_key" for d in (*MASTERS, "last_updated_date")],
            *flags,
            "dq_status",
        ],
        "dw_bridge": ["app_snapshot_key", "genre_key", "weight"],
    }
    return _violations(
        {
            f"not null {table}({column})": (ly[table], F.count_if(F.col(column).isNull()))
            for table, columns in filled.items()
            for column in columns
        }
    )


def _violations(rules: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Rules over the same DataFrame share one scan of it."""
    tables, measures = {}, []
    for i, (df, value) in enumerate(rules.values()):
        tables[str(id(df))] = df
        measures.append(Measure(f"rule_{i}", str(id(df)), value))
    measured = measure(tables, measures)
    lines = [
        F.struct(
            F.lit(name).alias("constraint_name"),
            F.col(f"rule_{i}").cast("bigint").alias("violations"),
        )
        for i, name in enumerate(rules)
    ]
    return measured.select(F.inline(F.array(*lines)))


def _fact_with_unknown(ly: Layers) -> DataFrame:
    """Facts marked where their type is the Unknown member."""
    types = ly["dim_app_type"].select(
        "app_type_key", (F.col("app_type_name_norm") == UNKNOWN_NORM).alias("is_unknown")
    )
    return ly["fact"].join(types, "app_type_key", "left")


def _row_counts(*tables: str) -> list[Measure]:
    return [Measure(f"{t}_rows", t, row_count()) for t in tables]


def _starts_with_any(column: str, prefixes: list[str]) -> Column:
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | F.col(column).startswith(prefix)
    return hit
