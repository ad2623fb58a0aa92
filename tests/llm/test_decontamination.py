"""Operator 8 against a search at every place, and its SQL."""

import hashlib
import re

import duckdb
import pytest

from starmill.llm import oracles
from starmill.llm.decontamination import Index, contamination, without_passages
from starmill.llm.queries import QUERIES
from tests.compare import compare
from tests.llm.texts import HARD, passage

ITEMS = [
    (1, passage(0, 25)),
    (2, passage(1, 10)),
    (3, "Two words"),
    (4, None),
    (5, "... !"),
    (6, passage(0, 25)),  # the same text again
    (None, passage(2, 14)),
    (7, "say"),
    (8, "never seen anywhere at all in these hard documents of ours"),
    (1, passage(0, 25)),  # a repeated row
]


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def expected(text, items):
    doc, hit, named = words(text), set(), set()
    for item, content in items:
        w = words(content)
        for s in range(max(1, len(w) - 9)) if w else ():
            window = w[s : s + 10]
            for i in range(len(doc) - len(window) + 1):
                if doc[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    if item is not None:
                        named.add(str(item))
    return len(doc), len(hit), sorted(named)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_hard_documents(hard, none, items):
    got = sorted(map(tuple, contamination(hard, items).collect()), key=str)
    assert got == sorted(((r[0], *expected(r[1], ITEMS)) for r in HARD), key=str)
    assert contamination(none, items).count() == 0
    nothing = contamination(hard, items.where("false"))
    assert {r["n_hit"] for r in nothing.collect()} == {0} and nothing.count() == len(HARD)


def test_clean_rows_stay(hard, items):
    left = without_passages(hard, items)
    assert left.columns == hard.columns
    want = sorted((str(r[:2]) for r in HARD if not expected(r[1], ITEMS)[1]))
    assert sorted(str((r["doc_id"], r["text"])) for r in left.collect()) == want


def test_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "alpha beta gamma delta"), (2, "alpha x beta gamma delta"), (3, "alpha x y z beta gamma delta")],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    index = Index(docs, items, "doc_id")
    found = lambda m: {r["row"] for r in m.collect()}
    assert found(index.exact_matches()) == {1}
    assert found(index.proximity_matches(0)) == {1}
    assert found(index.proximity_matches(1)) == {1, 2}
    assert found(index.proximity_matches(3)) == {1, 2, 3}


def test_sql(spark, folder):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    df = QUERIES["op8_decontamination"](spark, folder)
    assert compare(df, con, oracles.DECONTAMINATION) == ""
    assert df.where("contaminated").count() > 0
    digest = df.where("n_items = 0").first()["items_sha256"]
    assert digest == hashlib.sha256(b"").hexdigest()


def test_no_python_in_the_plan(spark, folder):
    plan = QUERIES["op8_decontamination"](spark, folder)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
