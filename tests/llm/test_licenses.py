"""Operator 9 against all increasing pairs and longest common subsequences."""

import random
from itertools import combinations

from starmill.llm import licenses
from tests.llm.texts import HARD


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_longest_run_of_anchors():
    draw = random.Random(1)
    for _ in range(200):
        n = draw.randint(0, 8)
        pairs = list(zip(range(n), draw.sample(range(20), n)))
        best = max(
            len(c) for k in range(n + 1) for c in combinations(pairs, k)
            if all(x[1] < y[1] for x, y in zip(c, c[1:]))
        )
        run = licenses.increasing(pairs)
        assert len(run) == best and all(x[1] < y[1] for x, y in zip(run, run[1:]))


def test_alignment_is_a_common_subsequence():
    draw = random.Random(2)
    for _ in range(500):
        a, b = (draw.choices("abcdefgh", k=draw.randint(0, 12)) for _ in "xy")
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) <= lcs(a, b)


def test_planted_notices_are_found():
    """Each notice, whole or with some words changed, anywhere in a text, or twice in it."""
    draw = random.Random(3)
    templates = [licenses.Template(n, t, licenses.COVERAGE) for n, t in licenses.TEMPLATES.items()]
    vocabulary = frozenset(w for t in templates for w in t.words)
    for template in templates:
        for changed in range(0, len(template.words) - template.needed + 1, 3):
            notice = list(template.words)
            for i in draw.sample(range(len(notice)), changed):
                notice[i] = f"other{i}"
            around = [draw.choice(["the", "of", "license", "word", "any"]) for _ in range(200)]
            text = around[:90] + notice + around[90:] + notice
            n, found = licenses.scan(" ".join(text), templates, vocabulary)
            got = {name: (cover, first) for name, cover, first, _ in found}
            assert n == len(text) and template.name in got, (template.name, changed)
            cover, first = got[template.name]
            assert cover >= (len(notice) - changed) / len(notice) - 0.05


def test_documents(small, texts):
    marks = {"gnu general public license": "gpl-line", "mit license": "mit-line",
             "apache license": "apache-2.0-line", "cc by-nc": "cc-by-nc-4.0-line"}
    for r in licenses.license_notices(small).collect():
        text = texts[r["doc_id"]].lower()
        want = {name for mark, name in marks.items() if mark in text}
        assert {n["name"] for n in r["notices"]} == want
        assert r["n_words"] == len(licenses.words(texts[r["doc_id"]]))


def test_hard_documents(hard, none):
    rows = licenses.license_notices(hard).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in HARD)
    assert all(r["notices"] == [] for r in rows)
    assert licenses.license_notices(none).count() == 0
    assert licenses.license_notices(hard, templates={"x": "..."}).count() == len(HARD)


def found_in(text, names=None):
    given = licenses.TEMPLATES | licenses.whole_texts()
    templates = [licenses.Template(n, t, licenses.COVERAGE) for n, t in given.items()]
    vocabulary = frozenset(w for t in templates for w in t.words)
    return licenses.scan(" ".join(text), templates, vocabulary)[1]


def filler(n, seed=4):
    draw = random.Random(seed)
    return [draw.choice(["the", "of", "river", "word", "any", "and"]) for _ in range(n)]


def test_every_place_of_a_notice_is_listed():
    for name in ("mit", "isc", "mpl-2.0", "gpl-line"):
        notice = licenses.words(licenses.TEMPLATES[name])
        n = len(notice)
        text = filler(50) + notice + filler(70) + notice + notice + filler(30)
        starts = [50, 120 + n, 120 + 2 * n]
        assert sorted(found_in(text), key=lambda x: x[2]) == [(name, 1.0, s, s + n) for s in starts]


def test_whole_texts_and_kindred_licences_are_named():
    for name, text in (licenses.TEMPLATES | licenses.whole_texts()).items():
        own = licenses.words(text)
        found = found_in(filler(40) + own + filler(40))
        assert (name, 1.0, 40, 40 + len(own)) in found, (name, found)
        assert len(found) == 1, (name, found)


def test_interrupted_notices():
    """By more words than the template has, at either side of the rarest words."""
    for name in ("apache-2.0", "mit", "bsd-2-clause", "agpl"):
        own = licenses.words(licenses.TEMPLATES[name])
        for at in (len(own) // 4, len(own) // 2, 3 * len(own) // 4):
            gap = len(own) + 10
            text = filler(60) + own[:at] + ["other"] * gap + own[at:] + filler(60)
            found = found_in(text)
            assert [(x[0], x[2], x[3]) for x in found] == [(name, 60, 60 + len(own) + gap)], (name, at)
