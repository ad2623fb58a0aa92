"""Plans that must hold at scale, and results that must not depend on them."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from starmill import Config, Layers
from starmill.operators.keys import ordered_key
from starmill.operators.snapshot import TYPED
from starmill.operators.star import FACT_FLAGS, FACT_MEASURES
from starmill.plans import analysis, quality, verification
from starmill.plans.layers import TABLES
from tests.test_reconcile import landing


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {f"spark.sql.{k.replace('__', '.')}": v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def no_broadcast(spark):
    return settings(spark, autoBroadcastJoinThreshold="-1")


LOOKUPS = ("app_type", "dim_genre")
WIDE = ("snapshot", "bridge", "fact")


IN_PLACE = [t for t, spec in TABLES.items() if spec.in_place]


def test_all_tables_keyed_by_the_row_are_written_where_they_are_computed():
    assert set(IN_PLACE) == {t for t, spec in TABLES.items() if spec.key} - {"raw"}


@pytest.mark.parametrize("table", IN_PLACE)
def test_tables_keyed_by_the_row_meet_without_a_shuffle(spark, ly, table):
    """With only the lookups broadcast, no row leaves its bucket."""
    ly.build_all()
    lookups = ("app", "dim_app", "genre", "dim_genre") if table in WIDE else LOOKUPS
    limit = 2 * max(_stored_bytes(ly[t]) for t in lookups)
    with settings(spark, autoBroadcastJoinThreshold=str(limit)):
        text = plan(TABLES[table].build(ly))
    assert "Exchange hashpartitioning" not in text
    assert table == "clean_bridge" or "SortMergeJoin" in text
    assert "Bucketed: true" in text


def exchanged(text):
    """Columns that each shuffle moves, by the lines below it in the plan."""
    lines = text.splitlines()
    found = []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = next(x for x in lines[i + 1 :] if "Project [" in x or "FileScan" in x)
            found.append(set(re.findall(r"(\w+)#\d+", below.split("Project ", 1)[-1])))
    return found


@pytest.mark.parametrize("table, wide", [("snapshot", TYPED), ("fact", (*FACT_MEASURES, *FACT_FLAGS))])
def test_lookups_without_broadcast_move_ids_alone(spark, ly, table, wide):
    ly.build_all()
    with no_broadcast(spark):
        text = plan(TABLES[table].build(ly))
    moved = exchanged(text)
    assert len(moved) >= 5 and not any(columns & set(wide) for columns in moved)


def test_bridge_without_broadcast_moves_two_columns(spark, ly):
    ly.build_all()
    with no_broadcast(spark):
        moved = exchanged(plan(TABLES["bridge"].build(ly)))
    assert moved and not any("genres" in columns for columns in moved)


def test_all_unique_keys_of_a_table_take_one_shuffle(spark, ly):
    """Keyed tables none, each of the eleven others one for its keys and one for the sums."""
    ly.build_all()
    text = plan(verification.unique_constraints(ly))
    others = [t for t in TABLES if not TABLES[t].key and t != "audit_log"]
    assert text.count("Exchange hashpartitioning") <= len(others)


def _stored_bytes(df):
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def test_in_place_tables_have_one_file_per_bucket(spark, ly):
    for table in ("raw", *IN_PLACE):
        ly[table]
        with no_broadcast(spark):
            written = ly.store.write(
                TABLES[table].build(ly), f"{table}_again", TABLES[table].key,
                TABLES[table].equal_to_key, TABLES[table].in_place,
            )
        assert len(written.inputFiles()) <= ly.store.buckets


def test_kpis_aggregate_before_they_meet_the_dimension(spark, ly):
    with no_broadcast(spark):
        text = plan(analysis.genre_weighted_kpis(ly))
    lines = [line.strip() for line in text.splitlines()]
    join = next(i for i, line in enumerate(lines) if "Join [genre_key" in line)
    below = "\n".join(lines[join:])
    assert "HashAggregate(keys=[genre_key" in below


def test_scorecard_scans_the_snapshot_once_for_its_own_metrics(spark, ly):
    text = plan(quality.baseline_scorecard(ly))
    wide = [line for line in text.splitlines() if ".snapshot[" in line and "rating" in line]
    assert len(wide) == 1


def test_parsing_needs_no_shuffle_and_reads_only_its_columns(spark, ly):
    from starmill.operators.snapshot import type_rows

    text = plan(type_rows(ly["raw"]).select("raw_id", "rating"))
    assert "Exchange" not in text
    assert "[raw_id#" in text and ",rating#" in text and "genres" not in text


HOT = 20_000


@pytest.fixture(scope="module")
def skewed(spark):
    """One app, category and genre hold well over a third of the rows."""
    ids = spark.range(HOT).withColumnRenamed("id", "raw_id")
    hot = F.col("raw_id") % 5 < 2
    pick = lambda c, text: F.when(hot, text).otherwise(F.concat(F.lit(c), F.col("raw_id").cast("string")))
    columns = {
        "app": pick("app ", "Hot App"),
        "category": F.when(hot, "Hot").otherwise(F.concat(F.lit("c"), (F.col("raw_id") % 50).cast("string"))),
        "rating": (F.col("raw_id") % 5).cast("string"),
        "reviews": F.col("raw_id").cast("string"),
        "size": F.lit("1M"),
        "installs": F.lit("1,000+"),
        "type": F.when(F.col("raw_id") % 3 == 0, None).otherwise("Free"),
        "price": F.lit("0"),
        "content_rating": F.lit("Everyone"),
        "genres": F.concat(F.lit("Hot;"), F.when(hot, "Hot ; hot").otherwise(F.concat(F.lit("g"), (F.col("raw_id") % 40).cast("string")))),
        "last_updated": F.lit("7-Jan-18"),
        "current_ver": F.lit("1"),
        "android_ver": F.lit("4"),
    }
    return ids.select("raw_id", *[c.alias(n) for n, c in columns.items()]).checkpoint()


def test_hot_keys_are_split_and_give_the_same_rows(spark, skewed):
    small = Layers(skewed, Config())
    masters = {m: small[m].checkpoint() for m in ("app", "category", "app_type", "content_rating")}
    expected = Layers(skewed, given=masters)["snapshot"].checkpoint()
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="16k",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="8k",
    ):
        split = Layers(skewed.repartition(16), given=masters)["snapshot"]
        rows = split.collect()
        text = plan(split)
    assert "skew=true" in text
    assert sorted(rows) == sorted(expected.collect())
    assert len(rows) == HOT


def test_keys_in_the_order_of_a_hot_name(spark):
    """A name on two of three rows is dealt to several tasks and numbered in order."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("n"), F.col("id"))).when(
            F.col("id") % 500 != 1, F.lit("hot")
        ).alias("name"),
        (F.col("id") * 7919 % 3001).alias("no"),
        F.lit(1).alias("a.b"),
    )
    with settings(spark, shuffle__partitions="8"):
        keyed = ordered_key(rows, "key", ["name", "no"])
        found = keyed.orderBy("key").collect()
    want = sorted(rows.collect(), key=lambda r: (r.name is not None, r.name or "", r.no))
    assert [(r.key, r.name, r.no) for r in found] == [(i + 1, r.name, r.no) for i, r in enumerate(want)]
    assert keyed.columns == ["key", "name", "no", "a.b"]
    assert ordered_key(rows.where("no < 0"), "key", ["name"]).count() == 0


def test_hot_members_keep_all_their_rows(spark, skewed):
    ly = Layers(skewed)
    ly = Layers(skewed, given={t: ly[t].checkpoint() for t in TABLES})
    kpis = {r.genre_name: r for r in analysis.genre_weighted_kpis(ly).collect()}
    # Every row has the hot genre: alone in two of five rows, shared with another in the rest.
    assert kpis["Hot"].weighted_snapshot_count == HOT * 2 // 5 + HOT * 3 // 5 / 2
    members = {r.genre_name: r.snapshot_membership_count for r in analysis.genre_membership(ly).collect()}
    assert members["Hot"] == HOT and len(members) == 25
    by_category = {r.category_name: r.snapshot_count for r in analysis.by_category(ly).collect()}
    assert by_category["Hot"] == HOT * 2 // 5
    assert ly["app"].count() == HOT * 3 // 5 + 1


def test_a_row_with_a_very_long_list(spark):
    """Whole lists are used, and their weights still add up."""
    names = ";".join(f"g{i}" for i in range(5000))
    ly = Layers(landing(spark, [dict(raw_id=1, app="A", genres=names), dict(raw_id=2, app="B", genres="g1")]))
    assert ly["bridge"].count() == 5001
    assert ly["genre"].count() == 5000
    total = ly["clean_bridge"].where("snapshot_id = 1").agg(F.sum("weight")).first()[0]
    assert abs(total - 1) < 1e-6
