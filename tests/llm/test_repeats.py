"""Repeated bytes against a dictionary of all strings of fifty bytes."""

import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from starmill.llm import repeats
from starmill.llm import suffix_array as sa


def plain(docs, n=50):
    """Per document (id, bytes, removed, spans, digest of the rest), in no order."""
    least = {}
    texts = [(d, (t or "").encode()) for d, t in docs]
    for d, t in texts:
        if d is not None:
            for i in range(len(t) - n + 1):
                w = t[i : i + n]
                least[w] = min(d, least.get(w, d))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        if d is not None:
            for i in range(len(t) - n + 1):
                if least[t[i : i + n]] < d:
                    gone[i : i + n] = True
        rest = bytes(b for b, g in zip(t, gone) if not g)
        spans = int(np.sum(gone & ~np.append(False, gone[:-1])))
        out.append((d, len(t), int(gone.sum()), spans, sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def found(docs, **sizes):
    return sorted((tuple(r) for r in repeats.repeat_digests(docs, **sizes).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_hard_documents(hard):
    assert found(hard) == plain([(r["doc_id"], r["text"]) for r in hard.collect()])


@pytest.mark.parametrize("hot, chunk", [(2_000, 2_000_000), (1, 2_000_000), (3, 5_000)])
def test_whole_table(small, texts, hot, chunk):
    """With usual anchors, with windows dealt one by one, and with many chunks and shards."""
    result = found(small, hot_docs=hot, chunk_bytes=chunk, shard_bytes=chunk * 5)
    assert result == plain(texts.items())
    assert sum(r[2] > 0 for r in result) > 10


def test_lengths_around_fifty_and_overlaps(spark):
    random.seed(3)
    s = "".join(random.choice("abcdefgh") for _ in range(120))
    rows = [(1, s), (2, "x" + s[:49] + "y"), (3, "x" + s[:50] + "y"), (4, s[10:70] + s[40:100])]
    rows += [(5, s[:50]), (6, s[:50]), (-7, s[:51]), (8, "a" * 400), (9, "a" * 50 + "b" + "a" * 49)]
    rows += [(10, "é" * 40), (11, "xé" + "é" * 30), (None, s), (12, None), (12, ""), (3, s)]
    assert found(frame(spark, rows)) == plain(rows)


def test_small_alphabets(spark):
    random.seed(4)
    rows = []
    for i in range(150):
        unit = "".join(random.choice("ab") for _ in range(random.randint(1, 9)))
        rows.append((i, unit * random.randint(1, 40) + random.choice(["", "c", unit])))
    assert found(frame(spark, rows)) == plain(rows)


def test_kept_bytes_and_empty_table(spark, none):
    rows = [(1, "k" + "é" * 40), (2, "é" * 30 + "!")]
    kept = {r["doc_id"]: bytes(r["kept"]) for r in repeats.without_repeats(frame(spark, rows)).collect()}
    assert kept == {1: ("k" + "é" * 40).encode(), 2: b"!"}
    assert found(none) == []


@pytest.mark.parametrize("crowded", [1, 10, 10**9])
def test_suffix_arrays(monkeypatch, crowded):
    """Over alphabets of any size, by recursion and by doubled ranks."""
    monkeypatch.setattr(sa, "CROWDED", crowded)
    random.seed(5)
    for _ in range(300):
        symbols = random.choice([1, 2, 3, 5, 50])
        text = np.array([random.randint(1, symbols) for _ in range(random.randint(0, 60))] + [0])
        order = sa.suffix_array(text)
        suffixes = [text[i:].tolist() for i in order]
        assert suffixes == sorted(suffixes) and sorted(order) == list(range(len(text)))
        common = sa.permuted_common_prefixes(text, order, 7)
        for a, b, at in zip(suffixes, suffixes[1:], order[1:]):
            assert common[at] == next((i for i in range(7) if a[i : i + 1] != b[i : i + 1]), 7)


def test_long_runs_of_one_symbol():
    text = np.append(np.ones(20_000, np.uint16), np.uint16(0))
    assert sa.suffix_array(text).tolist() == list(range(20_000, -1, -1))


def symbol_by_symbol(text, order, most):
    before = np.empty(len(text), np.int64)
    before[order[1:]], before[order[0]] = order[:-1], -1
    padded, common = np.append(text, np.zeros(most, text.dtype)), np.zeros(len(text), np.int64)
    left = np.flatnonzero(before >= 0)
    for step in range(most):
        left = left[padded[left + step] == padded[before[left] + step]]
        common[left] = step + 1
    return common


def test_common_prefixes_go_several_symbols_at_a_time(monkeypatch):
    """As symbol by symbol, for any length, and in fewer steps."""
    rng = np.random.default_rng(2)
    passage = rng.integers(1, 2**16, 3000)
    parts = [p for i in range(40) for p in (passage[i : 2900 + i], rng.integers(1, 2**16, 7))]
    text = np.append(np.concatenate(parts), 0).astype(np.uint16)
    order = sa.suffix_array(text.astype(np.int64))
    for most in (1, 3, 4, 5, 50):
        got = sa.permuted_common_prefixes(text, order, most)
        assert got.tolist() == symbol_by_symbol(text, order, most).tolist()

    steps = []

    def counted(*limits):
        for step in range(*limits):
            steps.append(step)
            yield step

    monkeypatch.setattr(sa, "range", counted, raising=False)
    sa.permuted_common_prefixes(text, order, 50)
    assert len(steps) <= 13


def test_common_prefixes_of_marked_places_alone(monkeypatch):
    """As symbol by symbol where both places are marked; chains of places cost one comparison."""
    rng = np.random.default_rng(4)
    passage = rng.integers(2, 258, 2000)
    parts = [p for i in range(50) for p in (passage[i : 1900 + i], np.ones(1, int))]
    text = np.append(np.concatenate(parts), 0).astype(np.uint16)
    order = sa.suffix_array(text)
    before = np.full(len(text), -1)
    before[order[1:]] = order[:-1]
    where = rng.random(len(text)) < 0.9
    both = (before >= 0) & where & where[before]
    want = symbol_by_symbol(text, order, 50)
    got = sa.permuted_common_prefixes(text, order, 50, where)
    assert got.tolist() == np.where(both, want, 0).tolist()

    compared = []

    class Counting:
        def __getattr__(self, name):
            return getattr(np, name)

        def flatnonzero(self, a):
            found = np.flatnonzero(a)
            compared.append(len(found))
            return found

    monkeypatch.setattr(sa, "np", Counting())
    assert sa.permuted_common_prefixes(text, order, 50).tolist() == want.tolist()
    assert compared[-1] < len(text) // 20  # the ends of chains


def test_chunks_take_whole_deals_and_equal_stretches_once():
    """However the rows come in batches: the same spans, and rows stay out of Python's lists."""
    rng = np.random.default_rng(6)
    line = rng.integers(0, 256, 400, np.uint8).tobytes()
    rows = []
    for deal in range(60):
        for shard in range(int(rng.integers(1, 6))):
            a = int(rng.integers(0, 40)) + 5 * deal
            at = np.array([(100 * shard + deal, deal, a)], repeats.PLACE)
            rows.append((deal, shard, line[a : a + 60 + deal % 7], at.tobytes()))
    names = ["deal", "shard", "stretch", "places"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    whole = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def spans(batch, chunk):
        cut = [whole.slice(i, batch) for i in range(0, whole.num_rows, batch)]
        out = {}
        for found in repeats.find_spans(iter(cut), chunk):
            for shard, cell in zip(*(c.to_pylist() for c in found.columns)):
                out.setdefault(shard, []).append(cell)
        joined = {s: np.frombuffer(b"".join(c), repeats.SPAN) for s, c in out.items()}
        return {s: sorted(x.tolist()) for s, x in joined.items()}

    want = spans(len(rows), 1)
    assert want
    for batch in (1, 7, len(rows)):
        assert spans(batch, 1) == want
    # Not the same spans over several deals at a time, but with all deals in one chunk, always.
    assert spans(3, 10**9) == spans(len(rows), 10**9)
    chunk = repeats.Chunk()
    chunk.add(whole)
    chunk.add(whole)
    assert len(chunk.stretches) == len({r[2] for r in rows})
