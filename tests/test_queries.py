"""Every registered query against its oracle, and the invariants of the layers."""

import pytest

import __spark_entry__ as e
from starmill.functions.numbers import WEIGHT
from starmill.plans import analysis, orders, quality, verification, views
from starmill.plans.layers import TABLES, Layers
from tests.compare import compare, oracle_connection

# The other operators have tests of their own.
OWN = set(e.queries()) - set(e.LLM_QUERIES) - {"pipeline"}
QUERIES = {name: query for name, query in e.queries().items() if name in OWN}
ORACLES = {name: sql for name, sql in e.oracle_sql().items() if name in OWN}
SCALES = {"0.001": (1499, 4381, 1497, 4375), "0.01": (14985, 43676, 14969, 43632)}

# Checks the dirty orders are meant to fail.
FAILING = {
    "P2-COUNT-05", "P2-COUNT-06", "P2-CLEAN-05", "P2-CLEAN-06",
    "P2-CLEAN-08", "P2-WEIGHT-02", "P2-WEIGHT-03", "P2-WEIGHT-04",
}


@pytest.fixture(scope="module")
def con(folder):
    return oracle_connection(folder)


def all_checks(layers, relative=False):
    parts = [
        verification.count_checks(layers),
        verification.cleaning_checks(layers),
        verification.bridge_checks(layers),
        verification.warehouse_checks(layers),
        verification.weight_checks(layers, relative),
    ]
    return {r.check_id: r.status for part in parts for r in part.collect()}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, folder, con, name):
    assert compare(QUERIES[name](spark, folder), con, ORACLES[name]) == ""


@pytest.mark.parametrize("scale", SCALES)
def test_layer_sizes(spark, scale):
    ly = orders.layers(spark, f"/root/testdata/sf{scale}")
    got = tuple(ly[t].count() for t in ("snapshot", "bridge", "fact", "dw_bridge"))
    assert got == SCALES[scale]


def test_38_checks_fail_where_the_rows_are_dirty(ly):
    got = all_checks(ly)
    assert len(got) == 38
    assert {check for check, status in got.items() if status != "PASS"} == FAILING


def test_clean_subset_passes_everything(spark, folder):
    """Rows with a date and genres and without price conflicts meet every check."""
    raw = orders.landing(spark, folder).where(
        "genres is not null and last_updated <> '' and raw_id % 101 <> 0 and raw_id % 103 <> 0 "
        "and raw_id % 1000 <> 999"
    )
    config = orders.Config()
    ly = Layers(raw.checkpoint(), config)
    ly = Layers(raw, config, given={t: ly[t].checkpoint() for t in TABLES})
    assert set(all_checks(ly).values()) == {"PASS"}
    assert set(all_checks(ly, relative=True).values()) == {"PASS"}
    assert {r.row_count for r in verification.must_be_empty_rows(ly).collect()} == {0}


def test_constraints_hold(ly):
    for report in (
        verification.unique_constraints,
        verification.foreign_key_constraints,
        verification.check_constraints,
        verification.not_null_constraints,
    ):
        broken = [r for r in report(ly).collect() if r.violations]
        assert broken == []


def fault(ly, **tables):
    known = {t: ly[t] for t in TABLES}
    return Layers(ly["raw"], ly.config, given={**known, **tables})


def changed(good, bad):
    return {k for k in good if good[k] != bad[k]}


def test_injected_faults_turn_their_checks(spark, ly):
    good = all_checks(ly)
    fact, bridge, clean_bridge = ly["fact"], ly["dw_bridge"], ly["clean_bridge"]
    double = fault(ly, fact=fact.unionByName(fact.limit(1)))
    assert "P2-DW-08" in changed(good, all_checks(double))
    assert sum(r.violations for r in verification.unique_constraints(double).collect()) == 2

    orphan = spark.createDataFrame([(-1, -1, 1)], "a long, g long, w int")
    orphan = orphan.selectExpr("a as app_snapshot_key", "g as genre_key", f"cast(w as {WEIGHT}) weight")
    lost = fault(ly, dw_bridge=bridge.unionByName(orphan))
    assert {"P2-DW-06", "P2-DW-07"} <= changed(good, all_checks(lost))
    assert sum(r.violations for r in verification.foreign_key_constraints(lost).collect()) == 2

    for weight in ("0", "1.5"):
        heavy = fault(ly, clean_bridge=clean_bridge.withColumn("weight", _weight(weight)))
        assert {"P2-BRIDGE-04", "P2-BRIDGE-05"} <= changed(good, all_checks(heavy))
    heavy = fault(ly, dw_bridge=bridge.withColumn("weight", _weight("1.5")))
    assert "P2-WEIGHT-01" in changed(good, all_checks(heavy))
    broken = {r.constraint_name for r in verification.check_constraints(heavy).collect() if r.violations}
    assert broken == {"check dw_bridge(weight)"}
    assert verification.dw_weight_errors(heavy).count() > 0

    untyped = fact.selectExpr("* except (dq_status)", "cast(null as string) as dq_status")
    missing = verification.not_null_constraints(fault(ly, fact=untyped)).collect()
    assert {r.constraint_name for r in missing if r.violations} == {"not null fact(dq_status)"}


def _weight(value):
    from pyspark.sql import functions as F

    return F.lit(value).cast(WEIGHT)


def test_weights_conserve_totals(ly):
    """Sum of weights = facts with a genre, weighted sums = their plain sums."""
    bridge = ly["dw_bridge"]
    with_genre = ly["fact"].join(bridge.select("app_snapshot_key").distinct(), "app_snapshot_key")
    plain = with_genre.selectExpr("count(*) n", "sum(reviews_count) r", "sum(installs_count) i").first()
    kpis = analysis.genre_weighted_kpis(ly).selectExpr(
        "sum(weighted_snapshot_count) n", "sum(weighted_reviews_count) r",
        "sum(weighted_installs_count) i",
    ).first()
    for exact, weighted in zip(plain, kpis):
        assert abs(exact - weighted) < 1e-6 * exact


def test_fractional_rows_sum_to_the_kpis(ly):
    sums = {
        r.genre_name: (r.w, r.v)
        for r in analysis.genre_fractional(ly)
        .groupBy("genre_name")
        .agg({"weighted_snapshot_count": "sum", "weighted_reviews_count": "sum"})
        .toDF("genre_name", "w", "v")
        .collect()
    }
    kpis = analysis.genre_weighted_kpis(ly).collect()
    found = {r.genre_name: {r.weighted_snapshot_count, r.weighted_reviews_count} for r in kpis}
    assert {g: set(v) for g, v in sums.items()} == found


def test_rerun_gives_the_same_layers(spark, folder, ly):
    """Keys do not depend on how rows are spread over tasks."""
    again = Layers(orders.landing(spark, folder).repartition(3, "app"), ly.config)
    for table in ("app", "genre", "bridge", "dim_app", "dim_last_updated_date"):
        assert again[table].exceptAll(ly[table]).count() == 0
        assert ly[table].exceptAll(again[table]).count() == 0


def test_reports_keep_their_order(ly):
    dims = [r.dimension for r in quality.baseline_scorecard_in_order(ly).collect()]
    ranks = [quality.DIMENSION_ORDER.index(d) for d in dims]
    assert ranks == sorted(ranks) and len(dims) == 21
    top = [r.weighted_installs_count for r in analysis.top_genres(ly).collect()]
    assert top == sorted(top, reverse=True)


def test_views_register(spark, ly):
    names = views.register_views(spark, ly)
    assert len(names) == 23
    got = spark.sql("select count(*) from dw_v_genre_weighted_kpis").first()[0]
    assert got == ly["dim_genre"].count()


def test_entry(spark):
    assert e.entry(spark).count() == 6
