"""The manifest against trees built and climbed in plain Python."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from starmill.llm import merkle, queries
from tests.llm.texts import HARD


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    doc, text, lang, source, n_chars = row[:5]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    said = [None if v is None else str(v) for v in (doc, source, lang, n_chars, text)]
    return h("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in said))


def tree(nodes):
    """Levels from the nodes to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h("".join(now[i : i + 16])) for i in range(0, len(now), 16)])
    return levels


def climb(levels, i, folded, proof):
    for level in levels[:-1]:
        run = level[i // 16 * 16 :][:16]
        proof += run[: i % 16] + run[i % 16 + 1 :]
        folded = h("".join(run[: i % 16] + [folded] + run[i % 16 + 1 :]))
        i //= 16
    return folded, proof


def plain(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    order = lambda r: (r[0] is not None, r[0] or 0, leaf(r))
    members = {s: sorted((r for r in rows if r[3] == s), key=order) for s in sources}
    trees = {s: tree([leaf(r) for r in members[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for at, s in enumerate(sources):
        for i, r in enumerate(members[s]):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded, proof = climb(trees[s], i, leaf(r, bad), [])
            folded, proof = climb(top, at, folded, proof)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, h("".join(proof)), folded, folded == root))
    return sorted(out, key=repr)


def found(docs, monkeypatch):
    monkeypatch.setattr(queries, "documents", lambda *_: docs)
    rows = queries.op12_merkle_manifest(docs.sparkSession, "")
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in rows.select(*names).collect()), key=repr)


def with_sources(rows, sources):
    return [(*r[:3], s, *r[4:]) for s in sources for r in rows]


@pytest.mark.parametrize(
    "sources",
    [["s"], [None, "", "a"], [*map(str, range(20)), None]],
    ids=["one", "null_and_empty", "more_than_a_run"],
)
def test_equals_plain_trees(spark, hard, monkeypatch, sources):
    rows = with_sources(HARD, sources)
    assert found(spark.createDataFrame(rows, hard.schema), monkeypatch) == plain(rows)


def test_sources_of_one_document_and_a_large_one(spark, hard, monkeypatch):
    rows = [(i, f"Text {i}", "en", "big" if i > 5 else f"s{i}", i, *HARD[0][5:]) for i in range(700)]
    monkeypatch.setattr(merkle, "SALT_RUNS", 4)
    assert found(spark.createDataFrame(rows, hard.schema).repartition(5), monkeypatch) == plain(rows)


def test_one_document_is_root_and_has_no_proof(spark, hard, monkeypatch):
    rows = HARD[:1]
    (only,) = found(spark.createDataFrame(rows, hard.schema), monkeypatch)
    assert only[1] == only[2] == only[3] and only[4] == h("")


def test_empty_table(none, monkeypatch):
    assert found(none, monkeypatch) == []


def test_any_tampering_breaks_the_root(spark, hard):
    docs = hard.filter("doc_id is not null and text is not null").dropDuplicates(["doc_id"])
    changed = F.when(F.col("doc_id") == 10, F.concat("text", F.lit(".")))
    broken = merkle.manifest(docs, changed).filter("folded_root <> root").collect()
    assert [r["doc_id"] for r in broken] == [10]


def test_the_limit_on_recursive_rows_is_put_back(spark, hard):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.manifest(hard)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
