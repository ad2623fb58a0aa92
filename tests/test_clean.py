"""Flags, status, audit and weights on typed rows no parser would produce."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmill import Config, Layers
from starmill.functions.numbers import WEIGHT
from starmill.operators.audit import audit_summary
from starmill.operators.bridge import bridge_weights, weight_errors
from starmill.plans import analysis, quality, verification
from tests.test_reconcile import landing

DAY = dt.date(2018, 1, 7)
SNAPSHOT = (
    "snapshot_id long, raw_id long, app_id long, category_id long, app_type_id long, "
    "content_rating_id long, rating decimal(3,2), reviews_count long, size_bytes long, "
    "installs_count long, price_usd decimal(10,2), last_updated_date date, "
    "current_version string, android_version_text string"
)
D = Decimal


def typed(i, app_type=1, rating="4.1", reviews=1, size=1, installs=1, price="0", day=DAY,
          version="1.0", android="4.1"):
    number = lambda v: None if v is None else D(v)
    return (i, i, 1, 1, app_type, 1, number(rating), reviews, size, installs, number(price), day,
            version, android)


@pytest.fixture(scope="module")
def odd(spark):
    snapshots = [
        typed(1),
        typed(2, size=None),
        typed(3, app_type=None, price="2"),
        typed(4, app_type=2, price="0"),
        typed(5, app_type=2, price=None),
        typed(6, price="1"),
        typed(7, reviews=-1, size=None),
        typed(8, rating="5.5"),
        typed(9, rating=None, version="n/a", android=" "),
        typed(10),
        typed(11, version="NaN", day=dt.date(2300, 1, 1)),
    ]
    texts = [dict(raw_id=r[0], size="Varies with device" if r[0] == 2 else "x", type="t",
                  price="p", rating="r") for r in snapshots]
    names = lambda e, rows: spark.createDataFrame(
        rows, f"{e}_id long, {e}_name string, {e}_name_norm string"
    )
    pairs = [(i, 1) for i in range(1, 12) if i != 10] + [(1, 2), (1, 3)]
    return Layers(
        landing(spark, texts),
        Config(as_of_date=dt.date(2020, 1, 1)),
        given={
            "snapshot": spark.createDataFrame(snapshots, SNAPSHOT),
            "app": names("app", [(1, "A", "a")]),
            "category": names("category", [(1, "C", "c")]),
            "content_rating": names("content_rating", [(1, "R", "r")]),
            "app_type": names("app_type", [(1, "Free", "free"), (2, "Paid", "paid")]),
            "genre": names("genre", [(1, "G", "g"), (2, "H", "h"), (3, "I", "i")]),
            "bridge": spark.createDataFrame(pairs, "snapshot_id long, genre_id long"),
        },
    )


def by_id(df, column):
    return {r.snapshot_id: r[column] for r in df.select("snapshot_id", column).collect()}


def test_unknown_comparisons_stay_null(odd):
    invalid = by_id(odd["clean"], "invalid_measure_flag")
    conflict = by_id(odd["clean"], "type_price_conflict_flag")
    issues = by_id(odd["clean"], "dq_issue_count")
    strict = by_id(odd["clean"], "dq_issue_count_strict")
    assert invalid == {1: False, 2: None, 3: False, 4: False, 5: None, 6: False, 7: True, 8: True,
                       9: False, 10: False, 11: False}
    assert conflict == {1: False, 2: False, 3: None, 4: True, 5: True, 6: True, 7: False,
                        8: False, 9: False, 10: False, 11: False}
    assert issues == {1: 0, 2: None, 3: None, 4: 1, 5: None, 6: 1, 7: 2, 8: 1, 9: 3, 10: 1, 11: 1}
    assert strict == {**issues, 2: 1, 3: 1, 5: 1}


def test_status(odd):
    assert by_id(odd["clean"], "dq_status") == {
        1: "FLAGGED_OK", 2: "FLAGGED_OK", 3: "FLAGGED_OK", 4: "ERROR_REVIEW", 5: "ERROR_REVIEW",
        6: "ERROR_REVIEW", 7: "ERROR_REVIEW", 8: "ERROR_REVIEW", 9: "FLAGGED_OK",
        10: "ERROR_REVIEW", 11: "FLAGGED_OK",
    }
    assert by_id(odd["clean"], "size_varies_with_device_flag")[2] is True


def test_audit_logs_every_set_flag_but_missing_genres(odd):
    log = odd["audit_log"]
    counts = {r.issue_type: r.row_count for r in audit_summary(log).collect()}
    assert counts == {
        "rating_missing": 1, "size_varies_with_device": 1, "size_missing": 1,
        "app_type_missing": 1, "current_version_missing": 2, "android_version_missing": 1,
        "type_price_conflict": 3, "invalid_measure": 2, "multiple_genre_membership": 1,
    }
    conflict = log.where("issue_type = 'type_price_conflict' and row_pk = '5'").first()
    assert (conflict.old_value, conflict.new_value) == (
        "type=t; price=p", "app_type_id=2; price_usd=NULL"
    )
    invalid = log.where("issue_type = 'invalid_measure' and row_pk = '7'").first()
    assert invalid.old_value == "rating=r; reviews=NULL; size=x; installs=NULL; price=p"
    assert invalid.new_value == "rating=4.10; reviews=-1; size=NULL; installs=1; price=0.00"
    checks = {r.check_id: r.status for r in verification.cleaning_checks(odd).collect()}
    assert checks["P2-CLEAN-07"] == "PASS" and checks["P2-CLEAN-04"] == "FAIL"


def test_weights(odd):
    weights = odd["clean_bridge"]
    assert {r.weight for r in weights.where("snapshot_id = 1").collect()} == {D("0.333333333333")}
    assert weights.where("snapshot_id <> 1").select("weight").distinct().first()[0] == 1
    assert verification.clean_weight_errors(odd).count() == 0


def test_weight_errors_are_found(spark):
    rows = [(1, 1, D("0.5")), (1, 2, D("0.499")), (2, 1, D("1")), (3, 1, D("0.9999995"))]
    df = spark.createDataFrame(rows, f"snapshot_id long, genre_id long, weight {WEIGHT}")
    got = weight_errors(df, "snapshot_id", 0.000001).collect()
    assert [tuple(r) for r in got] == [(1, 2, D("0.999"), D("0.001"))]


def test_seven_genres_stay_within_tolerance(spark):
    bridge = spark.range(7).select(F.lit(1).alias("snapshot_id"), F.col("id").alias("genre_id"))
    assert weight_errors(bridge_weights(bridge), "snapshot_id", 0.000001).count() == 0


def test_baseline_sees_what_the_parsers_cannot_produce(odd):
    issues = {r.metric: r.issue_count for r in quality.baseline_scorecard(odd).collect()}
    assert issues["negative_reviews_count"] == 1
    assert issues["rating_out_of_range"] == 1
    assert issues["type_price_conflict"] == 3
    assert issues["snapshot_without_genre"] == 1
    assert issues["future_last_updated_date"] == 1
    # Assessment knows fewer words for "missing" than cleaning.
    assert issues["current_version_missing"] == 1
    assert issues["core_required_fields_missing"] == 1
    ids = {r.snapshot_id for r in quality.issue_view(odd, "invalid_measures").collect()}
    assert ids == {7, 8}


def test_unknown_members_are_an_option_per_dimension(spark):
    """By default only a missing type maps to Unknown; other missing members drop the fact."""
    day = "7-Jan-18"
    raw = landing(
        spark,
        [
            dict(raw_id=1, app="A", category="C", type="Free", content_rating="R", last_updated=day),
            dict(raw_id=2, app="A", category="C", type=None, content_rating="R", last_updated=day),
            dict(raw_id=3, app="A", category="", type="Free", content_rating="R", last_updated=day),
            dict(raw_id=4, app="A", category="C", type="Free", content_rating=None, last_updated=day),
            dict(raw_id=5, app="A", category="C", type="Free", content_rating="R", last_updated=""),
        ],
    )
    ids = lambda ly: {r.snapshot_id for r in ly["fact"].collect()}
    assert ids(Layers(raw)) == {1, 2}
    wide = Layers(raw, Config(unknown_members=("app_type", "category", "content_rating")))
    assert ids(wide) == {1, 2, 3, 4}
    names = {r.snapshot_id: r.category_name for r in analysis.enriched_fact(wide).collect()}
    assert names[3] == "Unknown" and names[4] == "C"
    status = {r.check_id: r.status for r in verification.count_checks(wide).collect()}
    assert {status[f"P2-COUNT-{i:02}"] for i in (7, 8, 9, 10, 11)} == {"PASS"}


def test_a_source_member_called_unknown_does_not_stop_the_load(spark):
    raw = landing(
        spark,
        [
            dict(raw_id=i, app="A", category="C", type=t, content_rating="R", last_updated="7-Jan-18")
            for i, t in enumerate(["Unknown", None, "Free"])
        ],
    )
    ly = Layers(raw)
    names = {r.snapshot_id: r.app_type_name for r in analysis.enriched_fact(ly).collect()}
    assert names == {0: "Unknown", 1: "Unknown", 2: "Free"}
    broken = [r.constraint_name for r in verification.unique_constraints(ly).collect() if r.violations]
    assert broken == ["unique dim_app_type(app_type_name)"]
