"""Operator 6: plain spans by their patterns, the field by all labelings of small graphs."""

import random
import re
from itertools import product

import numpy as np
import pytest

from starmill.llm import pii
from tests.llm.texts import HARD


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def by_patterns(text):
    found = [("email", *m.span()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.findall(r"[0-9]", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_plain_spans(texts):
    draw = random.Random(8)
    parts = [*"0123456789", ".", "-", " ", "+", "(", ")", "@", "a", "4111111111111111", "@x.y", "1.2.3.4", "+1 ", "é", "0.0"]
    made = ["".join(draw.choices(parts, k=draw.randint(1, 40))) for _ in range(20000)]
    short = [r[1] for r in HARD if r[1] and len(r[1]) < 9000]
    for text in [*texts.values(), *made, *short, "1" * 400 + ".2.3.4", "a@b.c@d.e"]:
        assert pii.plain_spans(text) == by_patterns(text), text


def test_message_passing_on_a_chain():
    """On a tree the messages give the exact probabilities."""
    draw = np.random.default_rng(2)
    graph = pii.Graph("7a 8b 9c 1d")
    assert graph.chain == [(0, 1), (1, 2), (2, 3)] and graph.skip == []
    weights = draw.standard_normal((pii.FEATURES, 5))
    chain = draw.standard_normal((5, 5))
    field = pii.Field(weights, chain, np.zeros((5, 5)))
    own = weights[np.array(graph.features)].sum(axis=1)
    want = np.zeros((4, 5))
    for labels in product(range(5), repeat=4):
        score = sum(own[i, y] for i, y in enumerate(labels))
        score += sum(chain[a, b] for a, b in zip(labels, labels[1:]))
        for i, y in enumerate(labels):
            want[i, y] += np.exp(score)
    want /= want.sum(axis=1, keepdims=True)
    assert np.abs(field.probabilities([graph]) - want).max() < 0.02


def test_equal_tokens_get_one_label():
    """A token is undecided by itself; a certain twin far away decides it."""
    graph = pii.Graph("id 77x and much later in the text again 77x")
    assert graph.skip == [(0, 1)]
    weights = np.zeros((pii.FEATURES, 5))
    field = pii.Field(weights, np.zeros((5, 5)), 3 * np.eye(5))
    assert np.allclose(field.probabilities([graph]), 0.2)
    only_first = set(graph.features[0]) - set(graph.features[1])
    if not only_first:
        graph.features[0] = [*graph.features[0][:-1], 5]
        only_first = {5}
    weights[list(only_first)[0], 3] = 5
    both = field.probabilities([graph])
    assert both[0].argmax() == both[1].argmax() == 3 and both[1, 3] > 0.6


def test_hard_documents(hard, none):
    rows = pii.find_spans(hard).collect()
    got = sorted(((r["doc_id"], r["plain"]) for r in rows), key=str)
    assert got == sorted(((r[0], pii.joined(by_patterns(r[1] or ""))) for r in HARD), key=str)
    for r in rows:
        assert set(filter(None, r["plain"].split(","))) <= set(r["spans"].split(","))
    assert pii.find_spans(none).count() == 0


def test_shapes_the_patterns_refuse_are_added(small, texts):
    added = 0
    for r in pii.find_spans(small).collect():
        plain, spans = ({*filter(None, x.split(","))} for x in (r["plain"], r["spans"]))
        for span in spans - plain:
            kind, start, end = span.split(":")
            assert re.search("[0-9@]", texts[r["doc_id"]][int(start) : int(end)])
            added += 1
    assert added < 60


def test_redaction(hard, none):
    assert pii.redacted("a bb c", [("ip", 2, 4)]) == "a [IP] c"
    assert pii.redacted("abcdef", [("card", 1, 4), ("phone", 3, 5)]) == "a[CARD]f"
    out = pii.redact(hard)
    assert out.columns == hard.columns
    rows = out.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in HARD)
    for r in rows:
        assert not by_patterns(r["text"] or "")
        if r["doc_id"] == 4:
            assert r["text"] is None
    assert pii.redact(none).count() == 0


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000 + "@", "+1" * 50_000, "1.2." * 50_000])
def test_long_texts_take_linear_time(text):
    pii.plain_spans(text)
    pii.Graph(text)


def test_the_sample_is_bounded_whatever_the_keys(spark):
    """A third of the rows without a key, and all rows of one key and text."""
    rows = [(None if i % 3 == 0 else i, f"card {i:016}") for i in range(3000)]
    schema = "key long, text string"
    some = pii.examples(spark.createDataFrame(rows, schema), 100).count()
    assert 50 < some <= 100
    same = spark.createDataFrame([(None, f"call {i % 2}") for i in range(3000)], schema)
    assert pii.examples(same.union(spark.createDataFrame(rows, schema)), 100).count() <= 100
