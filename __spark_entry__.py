"""

Results are brought to plain types (whole numbers as bigint, decimals as double) so that both
engines hash the same values.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The modules below lie next to this file, wherever it is loaded from.
if str(Path(__file__).parent) not in sys.path:
    sys.path.insert(0, str(Path(__file__).parent))

from oracles import ORACLES
from starmill.operators.audit import audit_summary
from starmill.operators.bridge import genre_histogram, weight_preview
from starmill.operators.domains import build_domain, insert_if_absent
from starmill.config import LANDING_HEADERS
from starmill.operators.assertions import assert_check, assert_fk, assert_not_null, assert_unique
from starmill.operators.enrich import not_loaded
from starmill.operators.keys import dense_key, ordered_key
from starmill.operators.snapshot import type_rows, unreadable_cells
from starmill.operators.star import build_fact
from starmill.plans import analysis, orders, quality, verification, views
from starmill.plans.layers import MASTERS, Layers
from starmill.sources.exports import export_csv, read_export
from starmill.sources.landing import land_csv, malformed_rows
from starmill.sources.store import LayerStore, scratch_path, written



def _needed(missing: ModuleNotFoundError) -> bool:
    """Whether a module is missing that the rest of the library needs, too."""
    name = missing.name or ""
    return name.startswith("starmill") and not name.startswith("starmill.llm")


# The operators for training text and the pipeline over them can be left out of a checkout, and are
# left out where a module that only they need, such as a tokenizer, isn't installed.
try:
    from starmill.llm.queries import ORACLES as LLM_ORACLES
    from starmill.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as missing:
    if _needed(missing):
        raise
    LLM_QUERIES, LLM_ORACLES = {}, {}
try:
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if _needed(missing):
        raise
    corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    return queries()["j53_genre_weighted_kpis"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    found = {"a1_landing": lambda spark, folder: plain(orders.landing(spark, folder))}
    found["a1_csv_landing"] = lambda spark, folder: _as_files(spark, folder, False).drop(
        "imported_at", "malformed_line"
    )
    found["a1_malformed_rows"] = lambda spark, folder: malformed_rows(
        written(_as_files(spark, folder, True))
    ).select("raw_id", "app", F.col("malformed_line").endswith(",surplus").alias("surplus"))
    found["a2_append"] = lambda spark, folder: plain(_appended(spark, folder))
    found["a6_export"] = _exported
    found["k0_assertions"] = lambda spark, folder: plain(_assertions(spark, folder))
    found["l1_dense_key_sparse"] = lambda spark, folder: plain(_sparse_keys(spark, folder))
    found["f2_ordered_key"] = lambda spark, folder: plain(_ordered_keys(spark, folder))
    found["j05_insert_if_absent"] = lambda spark, folder: plain(_segments(spark, folder))
    for name, view in _over_layers().items():
        found[name] = _query(view)
    found = dict(sorted(found.items())) | LLM_QUERIES
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = ORACLES | LLM_ORACLES
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint; decimals as double, rounded to 6 places except weights."""

    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
            c = c if f.name == "weight" else F.round(c, 6)
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        return c.alias(f.name)

    return df.select(*[column(f) for f in df.schema.fields])


def _query(view: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, folder: plain(view(orders.layers(spark, folder)))


def _over_layers() -> dict[str, Callable[[Layers], DataFrame]]:
    def table(name: str):
        return lambda ly: ly[name]

    def typed(*columns: str):
        return lambda ly: type_rows(ly["raw"]).select("raw_id", *columns)

    def issues(name: str):
        return lambda ly: quality.issue_view(ly, name)

    return {
        "j01_domain_category": table("category"),
        "j02_domain_app_type": table("app_type"),
        "j03_domain_content_rating": table("content_rating"),
        "j04_domain_app": table("app"),
        "j06_parse_rating": typed("rating"),
        "j07_parse_count": typed("reviews_count"),
        "j08_parse_size": typed("size_bytes"),
        "j09_parse_installs": typed("installs_count"),
        "j10_parse_price": typed("price_usd"),
        "j11_parse_date": typed("last_updated_date"),
        "j12_parse_text": typed("current_version", "android_version_text"),
        "j12_unreadable_cells": lambda ly: unreadable_cells(ly["raw"]),
        "j13_snapshot": table("snapshot"),
        "j14_genre": table("genre"),
        "j15_bridge": table("bridge"),
        "j16_reconciliation_counts": quality.reconciliation_counts,
        "j17_enriched_snapshot": quality.enriched_snapshot,
        "j18_baseline_scorecard": quality.baseline_scorecard,
        "j19_issue_missing_rating": issues("missing_rating"),
        "j20_issue_missing_size": issues("missing_size"),
        "j21_issue_missing_app_type": issues("missing_app_type"),
        "j22_issue_type_price_conflict": issues("type_price_conflict"),
        "j23_issue_invalid_measures": issues("invalid_measures"),
        "j24_raw_rows_not_loaded": lambda ly: not_loaded(ly["raw"], ly["snapshot"]),
        "j25_genre_histogram": lambda ly: genre_histogram(ly["snapshot"], ly["bridge"]),
        "j26_weight_preview": lambda ly: weight_preview(ly["bridge"], ly["genre"]),
        "j27_weight_preview_check": views.weight_preview_check,
        "j28_version_tokens": lambda ly: ly["clean"].select(
            "snapshot_id", "current_version", "android_version_text"
        ),
        "j29_flags": lambda ly: ly["clean"].select(
            "snapshot_id", *[c for c in ly["clean"].columns if c.endswith("_flag")]
        ),
        "j30_issue_count": lambda ly: ly["clean"].select(
            "snapshot_id", "dq_issue_count", "dq_issue_count_strict"
        ),
        "j31_status": lambda ly: ly["clean"].groupBy("dq_status").agg(F.count("*").alias("n")),
        "j32_clean_snapshot": table("clean"),
        "j33_clean_bridge": table("clean_bridge"),
        "j34_audit_log": table("audit_log"),
        "j35_cleaning_summary": quality.cleaning_summary,
        "j36_audit_summary": lambda ly: audit_summary(ly["audit_log"]),
        "j37_clean_weight_errors": verification.clean_weight_errors,
        "j38_after_cleaning_scorecard": quality.after_cleaning_scorecard,
        "j39_dim_app": table("dim_app"),
        "j40_dim_category": table("dim_category"),
        "j41_j44_dim_app_type": table("dim_app_type"),
        "j42_dim_content_rating": table("dim_content_rating"),
        "j43_dim_genre": table("dim_genre"),
        "j45_dim_date": table("dim_last_updated_date"),
        "j46_fact": table("fact"),
        "j46_fact_unknown_date": _undated,
        "j47_dw_bridge": table("dw_bridge"),
        "j48_load_summary": verification.load_summary,
        "j49_integrity_checks": verification.integrity_checks,
        "j50_enriched_fact": analysis.enriched_fact,
        "j51_genre_fractional": analysis.genre_fractional,
        "j52_genre_membership": analysis.genre_membership,
        "j53_genre_weighted_kpis": analysis.genre_weighted_kpis,
        "j53_weighted_mean_exact": lambda ly: analysis.genre_weighted_kpis(ly).select(
            "genre_name", F.col("avg_rating_weighted").cast("string").alias("mean")
        ),
        "j54_dw_weight_errors": verification.dw_weight_errors,
        "j56_count_checks": verification.count_checks,
        "j57_cleaning_checks": verification.cleaning_checks,
        "j58_bridge_checks": verification.bridge_checks,
        "j59_warehouse_checks": verification.warehouse_checks,
        "j60_weight_checks": verification.weight_checks,
        "j60_weight_checks_flat": lambda ly: verification.weight_checks(ly, relative=False),
        "j61_must_be_empty": verification.must_be_empty_rows,
        "j61_non_green_metrics": lambda ly: verification.must_be_empty(ly)["non_green_metrics"],
        "j61_integrity_failures": lambda ly: verification.must_be_empty(ly)["integrity_failures"],
        "j62_stage_one_checks": verification.stage_one_checks,
        "j63_scorecard_in_order": quality.baseline_scorecard_in_order,
        "j63_after_cleaning_in_order": quality.after_cleaning_scorecard_in_order,
        "j63_top_genres": analysis.top_genres,
        "j64_by_category": analysis.by_category,
        "j65_by_app_type": analysis.by_app_type,
        "j66_by_content_rating": analysis.by_content_rating,
        "j67_over_time": analysis.over_time,
        "k1_unique": verification.unique_constraints,
        "k2_foreign_keys": verification.foreign_key_constraints,
        "k3_checks": verification.check_constraints,
        "k4_not_null": verification.not_null_constraints,
    }


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    """Market segments of the customers, plus the categories of the landing rows they lack."""
    customer = orders.read_table(spark, folder, "customer")
    known = build_domain(customer, "c_mktsegment", "category", row_id="c_custkey")
    found = build_domain(orders.layers(spark, folder)["raw"], "category", "category")
    return insert_if_absent(
        known, found, ["category_name_norm"], ["category_id"], number="category_id"
    )


def _undated(ly: Layers) -> DataFrame:
    """Facts with an Unknown date, so that snapshots without one stay."""
    config = replace(ly.config, unknown_members=("app_type", "last_updated_date"))
    below = ("clean", *[f"dim_{entity}" for entity in MASTERS])
    dated = Layers(ly.source, config, given={name: ly[name] for name in below})
    dims = {entity: dated[f"dim_{entity}"] for entity in (*MASTERS, "last_updated_date")}
    return build_fact(dated["clean"], dims, config.unknown_members).select(
        "snapshot_id", "last_updated_date_key"
    )


def _sparse_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Dense keys over ids scattered over the whole range of a bigint."""
    scattered = F.expr("o_orderkey * 2654435761 % 9007199254740881 * 1000")
    ids = orders.read_table(spark, folder, "orders").select(
        "o_orderkey", scattered.cast("bigint").alias("sparse_id")
    )
    return dense_key(ids, "dense_id", ["sparse_id"])


def _ordered_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Dense keys in the order of a status that half of the orders have, then of their dates."""
    rows = orders.read_table(spark, folder, "orders").select(
        "o_orderstatus", F.col("o_orderdate").cast("date").alias("day"), "o_orderkey"
    )
    keyed = ordered_key(rows, "order_no", ["o_orderstatus", "day", "o_orderkey"])
    return keyed.select("order_no", "o_orderkey")


def _as_files(spark: SparkSession, folder: str, damage: bool) -> DataFrame:
    """The landing rows written as several CSV files without a header, and landed from them. With
    ``damage`` some lines have a cell too many or too few."""
    rows = orders.landing(spark, folder).drop("imported_at")
    cells = F.struct(*[F.col(c) for c in LANDING_HEADERS])
    line = F.to_csv(cells, {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    if damage:
        more = F.concat(line, F.lit(",surplus"))
        fewer = F.regexp_extract(line, "^[^,]*", 0)
        line = F.when(F.col("raw_id") % 97 == 0, more).when(
            F.col("raw_id") % 101 == 0, fewer
        ).otherwise(line)
    path = scratch_path(spark)
    placed = rows.select("raw_id", line.alias("line")).repartitionByRange(5, "raw_id")
    placed.sortWithinPartitions("raw_id").select("line").write.text(path)
    return land_csv(spark, path, header=False)


def _appended(spark: SparkSession, folder: str) -> DataFrame:
    """The enriched facts after all orders were loaded as two extracts, one after the other.

    Extracts are ranges of ids, as a catalogue's extracts follow one another.
    """
    rows = orders.landing(spark, folder)
    ends = orders.read_table(spark, folder, "orders").agg((F.max("o_orderkey") * 0.6).alias("end"))
    first = F.col("raw_id") <= ends.select("end").scalar()
    store = LayerStore(spark, f"appended_{uuid.uuid4().hex}", spark.sparkContext.defaultParallelism)
    store.drop_at_exit()
    ly = Layers(rows.where(first), orders.CONFIG, store)
    ly.append(rows.where(~first))
    return analysis.enriched_fact(ly)


def _exported(spark: SparkSession, folder: str) -> DataFrame:
    """A view written as a CSV folder and read back."""
    view = plain(analysis.by_category(orders.layers(spark, folder)))
    path = scratch_path(spark)
    export_csv(view, path)
    return read_export(spark, path, ", ".join(f"{name} {kind}" for name, kind in view.dtypes))


def _assertions(spark: SparkSession, folder: str) -> DataFrame:
    """Constraints that the given tables break, and some that they meet."""
    read = lambda name: orders.read_table(spark, folder, name)
    line, customer = read("lineitem"), read("customer")
    found = [
        assert_unique(line, "l_orderkey", "l_linenumber", name="line number per order"),
        assert_unique(customer, "c_custkey", name="customer key"),
        assert_check(customer, "c_acctbal >= 0", name="balance"),
        assert_not_null(customer, "c_name", name="customer name"),
        assert_fk(customer, "c_custkey", read("orders"), "o_custkey", name="customer orders"),
        assert_fk(read("orders"), "o_custkey", customer, "c_custkey", name="order customer"),
    ]
    return reduce(DataFrame.unionAll, found)
