"""Operator 1 against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from starmill.llm import simhash
from starmill.llm.components import components
from tests.llm.texts import HARD


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return int(np.uint64(x).view(np.int64))


def least_reached(nodes, near):
    """By node the least node it reaches, all pairs looked at."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    order = sorted(nodes)
    for i, a in enumerate(order):
        for b in order[:i]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_documents(small, texts):
    prints = {i: fingerprint(t) for i, t in texts.items()}
    want = least_reached(texts, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    for r in simhash.near_duplicates(small).collect():
        assert r["fp"] == signed(prints[r["doc_id"]])
        assert r["component_id"] == want[r["doc_id"]]


def test_hard_documents(hard, none):
    got = sorted(
        (tuple(r) for r in simhash.near_duplicates(hard).select("doc_id", "fp").collect()), key=str
    )
    assert got == sorted(((r[0], signed(fingerprint(r[1]))) for r in HARD), key=str)
    ids = {
        r["doc_id"]: r["component_id"]
        for r in simhash.near_duplicates(hard).collect()
        if r["doc_id"] not in (None, 15)
    }
    assert ids[2] == ids[1] == 1 and ids[5] == ids[6] == ids[4] == 4
    assert simhash.near_duplicates(none).count() == 0


def test_one_of_each_group_stays(hard, none):
    left = simhash.without_copies(hard)
    assert left.columns == hard.columns
    rows = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert sum(t == HARD[0][1] for _, t in rows) == 1 and (1, HARD[0][1]) in rows
    assert sum(t == HARD[7][1] for _, t in rows) == 1  # both have null ids
    assert sum(not (t or "").split() for _, t in rows) == 1
    assert len({fingerprint(t) for _, t in rows}) == len(rows)
    assert simhash.without_copies(none).count() == 0


@pytest.mark.parametrize("radius, most", [(3, 16), (3, 4096), (1, 4096)])
def test_dense_cloud(spark, radius, most):
    """Hundreds of fingerprints within a few bits: buckets overflow and are dealt out again."""
    draw, base = random.Random(radius), random.Random(0).getrandbits(64)
    cloud = {draw.getrandbits(64) for _ in range(100)} | {0, 2**64 - 1}
    for _ in range(400):
        x = base
        for b in draw.sample(range(64), draw.choice([0, 1, 2, 3, 4, 6])):
            x ^= 1 << b
        cloud.add(x)
    nodes = sorted(map(signed, cloud))
    fps = spark.createDataFrame([(n,) for n in nodes], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.near_links(fps, radius, most)).collect()}
    mask = 2**64 - 1
    want = least_reached(nodes, lambda a, b: ((a ^ b) & mask).bit_count() <= radius)
    assert {n: got.get(n, n) for n in nodes} == want


def test_bit_slices_count_distances():
    draw = np.random.default_rng(1)
    members = draw.integers(0, 2**63, 150).astype(np.int64)
    members[1:40] = members[0] ^ (1 << np.arange(39))
    members = np.unique(members)
    for radius in range(6):
        got = set()
        for a, b in simhash.linked([members], radius):
            got |= set(a.tolist()) | set(b.tolist())
        mask = 2**64 - 1
        near = {
            int(a)
            for a in members
            for b in members
            if a != b and ((int(a) ^ int(b)) & mask).bit_count() <= radius
        }
        assert got == near


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 90), (90, 95)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {90: 90, 95: 90, 100: 90}
