"""Near copies against all pairs of shingle sets."""

import random

import numpy as np
import pytest

from starmill.llm import near_copies as nc
from starmill.llm.components import components
from tests.llm.test_simhash import least_reached
from tests.llm.texts import FLOW


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def sets(texts):
    return {i: frozenset(nc.shingles(t or "").tolist()) for i, t in texts.items()}


def apart(prints, a, b):
    x, y = (np.frombuffer(prints[i], np.uint8) for i in (a, b))
    return int(np.bitwise_count(x ^ y).sum())


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def planted():
    """60 groups of an original and near copies, and texts of the same words that are none."""
    rng = random.Random(7)
    texts = {}
    for g in range(60):
        words = [rng.choice(FLOW) + str(rng.randrange(30)) for _ in range(150)]
        for k in range(4):
            texts[len(texts)] = edited(rng, words, 0 if k == 0 else rng.randrange(1, 4))
    for _ in range(200):
        texts[len(texts)] = " ".join(rng.choice(FLOW) + str(rng.randrange(30)) for _ in range(150))
    return texts


def components_of(spark, texts, **options):
    docs = spark.createDataFrame(list(texts.items()), "key long, text string").repartition(4)
    return {r["key"]: r["component_id"] for r in nc.near_copies(docs, "key", **options).collect()}


@pytest.mark.parametrize("most", [4096, 3])
def test_recall_and_precision_against_all_pairs(spark, planted, most):
    """With usual buckets, and with all of them dealt out again."""
    of = sets(planted)
    near = least_reached(planted, lambda a, b: similarity(of[a], of[b]) >= 0.8)
    found = components_of(spark, planted, most=most)
    pairs = lambda root: {(a, b) for a in root for b in root if a < b and root[a] == root[b]}
    true, got = pairs(near), pairs(found)
    assert len(true) > 100
    assert len(true & got) >= 0.9 * len(true)
    assert all(similarity(of[a], of[b]) > 0.5 for a, b in got)


def test_components_are_those_of_the_bits(spark, small, texts):
    """Whatever shares a key and is near by its bits is tied, and nothing else."""
    found = {i: nc.sketch(nc.shingles(t)) for i, t in texts.items()}
    prints = {i: f for i, (f, _) in found.items()}
    share = lambda a, b: any(x == y for x, y in zip(found[a][1], found[b][1]))
    want = least_reached(texts, lambda a, b: share(a, b) and apart(prints, a, b) <= nc.RADIUS)
    got = nc.near_copies(small, "doc_id").collect()
    assert {r["key"]: r["component_id"] for r in got} == want


@pytest.mark.parametrize("most", [2, 5, 16])
def test_large_buckets_lose_no_link(spark, most):
    """Classes that share one key only, in buckets of several groups and chains."""
    rng = np.random.default_rng(3)
    rows, bands = {}, {}
    for bucket in range(3):
        for _ in range(4):
            fp = rng.integers(0, 2, nc.BITS)
            for _ in range(12):
                fp = fp.copy()
                fp[rng.choice(nc.BITS, 30, replace=False)] ^= 1
                i = len(rows)
                rows[i] = np.packbits(fp).tobytes()
                bands[i] = [bucket, *range(100 + 20 * i, 111 + 20 * i)]
    links = lambda a, b: bands[a][0] == bands[b][0] and apart(rows, a, b) <= nc.RADIUS
    want = least_reached(rows, links)
    order = rng.permutation(len(rows)).tolist()
    table = [(i, rows[i], bands[i]) for i in order]
    classes = spark.createDataFrame(table, "first long, fp binary, bands array<long>")
    roots = components(nc.near_links(classes, nc.RADIUS, most)).collect()
    got = {i: i for i in rows} | {r["node"]: r["root"] for r in roots}
    assert got == want


def test_many_copies_of_one_text_are_one_class(spark, planted):
    texts = {i: planted[0] for i in range(500)} | {i + 500: planted[i] for i in range(1, 4)}
    found = components_of(spark, texts, most=2)
    assert set(found.values()) == {0}


def test_rows_and_columns_stay(spark, hard, none):
    left = nc.without_near_copies(hard)
    assert left.columns == hard.columns
    texts = [r["text"] for r in left.collect()]
    # Copies, empty texts and nulls are one each.
    assert len(texts) == len(set(texts)) and sum(not (t or "").strip() for t in texts) == 1
    rows = {(r["doc_id"], r["text"]) for r in hard.collect()}
    assert {(r["doc_id"], r["text"]) for r in left.collect()} <= rows
    assert nc.without_near_copies(none).count() == 0
    dotted = hard.withColumnRenamed("word", "a.b")
    assert nc.without_near_copies(dotted).columns == dotted.columns
