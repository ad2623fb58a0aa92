"""The audit of filters against every order applied document by document."""

import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from starmill.llm import filter_audit as fa
from tests.llm.texts import SCHEMA

LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (8, 1, 1), (None, 1, 1), (99, 1, 1), (15, None, 0)]


def plain(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, text, *_ in rows:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    docs = []
    for d, text, lang, *_ in rows:
        t = text or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": d is not None and least[t] < d,
        }
        docs.append((lang or "", d, {k for k, v in fails.items() if v}))
    out, shapley = [], Counter()
    for part in {p for p, *_ in docs}:
        for order in permutations("ABCDE"):
            left = [x for x in docs if x[0] == part]
            for step, k in enumerate(order, 1):
                gone = [x for x in left if k in x[2]]
                left = [x for x in left if k not in x[2]]
                earlier = set(order[: step - 1])
                shapley[part, k] += len(gone)
                out.append(
                    (part, "".join(order), step, len(left), len(gone),
                     sum(p == part and k in f and bool(f & earlier) for p, _, f in docs),
                     sum(p == part and f == {k} for p, _, f in docs),
                     sum(d in good for _, d, _ in gone), sum(d in toxic for _, d, _ in gone))
                )
    return sorted(r + (shapley[r[0], r[1][r[2] - 1]],) for r in out)


def labels_of(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_every_order_of_hard_documents(spark, hard):
    rows = [tuple(r) for r in hard.collect()]
    found = fa.filter_audit(hard, labels_of(spark)).collect()
    assert sorted(tuple(r) for r in found) == plain(rows, LABELS)


def test_hot_copies_are_salted_and_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(fa, "SALT_ROWS", 10)
    rows = [(i, "same text" if i % 3 else f"text {i}", "en", "s", i, *["x"] * 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    base = docs.select(F.col("doc_id").alias("row"), "doc_id", "text", F.xxhash64("text").alias("h"))
    found = {r["doc_id"] for r in fa.copies_of_smaller_ids(base).collect()}
    assert found == {i for i in range(300) if i % 3} - {1}


def test_equal_hashes_of_other_texts_are_no_copies(spark):
    rows = [(1, 1, "a", 7), (2, 2, "b", 7), (3, 3, "b", 7), (4, None, "a", 7), (5, 3, "b", 7)]
    base = spark.createDataFrame(rows, "row long, doc_id long, text string, h long")
    assert {r["row"] for r in fa.copies_of_smaller_ids(base).collect()} == {3, 5}


@pytest.mark.parametrize("schema", [SCHEMA])
def test_empty_tables(spark, none, hard, schema):
    assert fa.filter_audit(none, labels_of(spark)).collect() == []
    no_labels = labels_of(spark).limit(0)
    found = fa.filter_audit(hard, no_labels)
    assert found.agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0
