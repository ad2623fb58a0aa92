"""Masters, snapshots and bridge on hand-built landing rows."""

import pytest

from starmill import Config, Layers
from starmill.config import LANDING_HEADERS
from starmill.operators.domains import insert_if_absent
from starmill.operators.enrich import not_loaded
from starmill.operators.keys import dense_key
from starmill.operators.snapshot import unreadable_cells

CONFIG = Config(app_sentinels=("Shifted",))


def landing(spark, rows):
    """Landing rows from dicts; columns left out are NULL."""
    names = ["raw_id", *LANDING_HEADERS]
    schema = ", ".join(f"{n} {'long' if n == 'raw_id' else 'string'}" for n in names)
    return spark.createDataFrame([[r.get(n) for n in names] for r in rows], schema)


@pytest.fixture(scope="module")
def small(spark):
    return Layers(
        landing(
            spark,
            [
                dict(raw_id=10, app=" beta", category="Tools", type="Free", genres="A;B"),
                dict(raw_id=3, app="Beta ", category="TOOLS", type="Paid", genres="a ; B;"),
                dict(raw_id=7, app="Alpha", category=" tools", type="0", genres=";;"),
                dict(raw_id=5, app="Shifted", category="1.9", type="0", genres="11-Feb-18"),
                dict(raw_id=6, app="shifted", category="", type="  ", genres="B; C ;c;A"),
                dict(raw_id=8, app=None, category="Tools", genres="D"),
                dict(raw_id=9, app="  ", category="Tools", genres=None),
                dict(raw_id=4, app="Alpha", category="New", genres="1-Jan-20;A"),
            ],
        ),
        CONFIG,
    )


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_masters_keep_the_first_spelling_and_its_row_id(small):
    assert rows(small["app"], "app_id", "app_name", "app_name_norm") == [
        (3, "Beta", "beta"),
        (4, "Alpha", "alpha"),
        (6, "shifted", "shifted"),
    ]
    assert rows(small["category"], "category_id", "category_name") == [(3, "TOOLS"), (4, "New")]
    assert rows(small["app_type"], "app_type_name_norm") == [("free",), ("paid",)]


def test_sentinel_is_an_exact_spelling(small):
    """A differently cased copy of the sentinel brings its name back, and both rows load."""
    assert rows(small["snapshot"], "raw_id") == [(3,), (4,), (5,), (6,), (7,), (10,)]


def test_sentinel_row_and_rows_without_app_are_not_loaded(spark):
    raw = landing(
        spark,
        [dict(raw_id=i, app=a, genres="A") for i, a in enumerate([" Shifted", "A", "", None])],
    )
    ly = Layers(raw, CONFIG)
    assert rows(ly["snapshot"], "raw_id") == [(1,)]
    assert rows(not_loaded(raw, ly["snapshot"]), "raw_id") == [(0,), (2,), (3,)]
    assert rows(ly["bridge"], "snapshot_id") == [(1,)]


def test_missing_masters_leave_null_ids(small):
    got = rows(small["snapshot"], "raw_id", "app_id", "category_id", "app_type_id")
    assert (6, 6, None, None) in got and (7, 4, 3, None) in got and (10, 3, 3, 10) in got


def test_genres_and_bridge(small):
    """Lists of row 8 count for the genre master although the row itself is not loaded."""
    genres = rows(small["genre"], "genre_id", "genre_name", "genre_name_norm")
    assert genres == [(1, "a", "a"), (2, "B", "b"), (3, "C", "c"), (4, "D", "d")]
    assert rows(small["bridge"], "snapshot_id", "genre_id") == [
        (3, 1), (3, 2), (4, 1), (6, 1), (6, 2), (6, 3), (10, 1), (10, 2),
    ]


def test_insert_if_absent_first_writer_wins(spark):
    schema = "id long, name string, norm string"
    target = spark.createDataFrame([(1, "A", "a")], schema)
    new = spark.createDataFrame([(9, "a", "a"), (7, "C", "c"), (5, "c", "c"), (6, "b", "b")], schema)
    got = insert_if_absent(target, new, ["norm"], ["id"])
    assert rows(got, "id", "name") == [(1, "A"), (5, "c"), (6, "b")]
    assert rows(insert_if_absent(got, new, ["norm"], ["id"]), "id") == [(1,), (5,), (6,)]


@pytest.mark.parametrize("span", [1, 3, 1000])
def test_dense_key_equals_global_order(spark, span):
    ids = [5, 1, 99, 42, 43, 44, 1000, 7, 2**53 + 1, 2**53 + 2]
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(4)
    got = rows(dense_key(df, "key", ["id"], span), "key", "id")
    assert got == list(enumerate(sorted(ids), 1))


def test_unreadable_cells_are_listed_not_fatal(spark):
    raw = landing(spark, [dict(raw_id=1, app="A", price="1.2.3", reviews="1" * 30, size="1M")])
    got = rows(unreadable_cells(raw), "raw_id", "column_name", "raw_value")
    assert got == [(1, "price_usd", "1.2.3"), (1, "reviews_count", "1" * 30)]
    assert rows(Layers(raw)["snapshot"], "price_usd", "size_bytes") == [(None, 1048576)]


def test_sparse_ids_are_numbered_in_small_windows(spark):
    """Ids all over the range of a bigint: one block each, and few blocks per wide block."""
    ids = [i * 2654435761 * 1000003 % (2**62) - 2**61 for i in range(3000)]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r["id"]: r["key"] for r in dense_key(df, "key", ["id"]).collect()}
    assert got == {i: n for n, i in enumerate(sorted(ids), 1)}


def test_added_rows_get_ids_of_their_own(spark):
    target = spark.createDataFrame([(7, "a"), (9, "b")], "id long, name string")
    new = spark.createDataFrame([(9, "c"), (7, "d"), (3, "a")], "id long, name string")
    got = insert_if_absent(target, new, ["name"], ["id"], number="id")
    assert {tuple(r) for r in got.collect()} == {(7, "a"), (9, "b"), (10, "d"), (11, "c")}
