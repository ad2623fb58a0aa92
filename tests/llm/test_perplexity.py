"""Operator 4: plain counts by their definition, and the model by Kneser-Ney's in plain Python."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starmill.llm import perplexity
from starmill.llm.common import read_table
from tests.llm.texts import HARD

WHITE = " \t\n\x0b\x0c\r"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    inside = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(5)}
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(inside),
    )


def grams(word):
    line = perplexity.START * (perplexity.ORDER - 1) + word + perplexity.END
    return [line[i : i + perplexity.ORDER] for i in range(len(word) + 1)]


class Plain:
    """The model of one language with one occurrence of an n-gram left out, by dictionaries."""

    def __init__(self, words):
        counts = Counter()
        for word, n in words.items():
            for gram in grams(word):
                counts[gram] += n
        self.counts = counts
        self.give = {}
        for order, table in self.tables(counts).items():
            n = Counter(table.values())
            self.give[order] = [0.5, 1.0, 1.5]
            if n[1] and n[2] and n[3]:
                y = n[1] / (n[1] + 2 * n[2])
                d = [k - (k + 1) * y * n[k + 1] / n[k] for k in (1, 2, 3)]
                self.give[order] = [max(0.1, min(k, x)) for k, x in zip((1, 2, 3), d)]

    @staticmethod
    def tables(counts):
        found = {perplexity.ORDER: counts}
        for order in range(perplexity.ORDER - 1, 0, -1):
            found[order] = Counter(g[1:] for g in found[order + 1])
        return found

    def p_out(self, gram):
        """Counted anew without one of the n-gram's occurrences."""
        left = Counter(self.counts)
        left[gram] -= 1
        return self.p(gram, self.tables(+left))

    def p(self, gram, tables):
        if not gram:
            return perplexity.UNIFORM
        table = tables[len(gram)]
        same = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
        total = sum(same.values())
        if not total:
            return self.p(gram[1:], tables)
        give = lambda n: self.give[len(gram)][min(n, 3) - 1]
        rest = sum(map(give, same.values())) / total
        n = same.get(gram, 0)
        return ((n - give(n)) / total if n else 0) + rest * self.p(gram[1:], tables)


def test_plain_counts(texts):
    for text in [*texts.values(), *[r[1] or "" for r in HARD]]:
        assert tuple(perplexity.base_counts(text)[c] for c in perplexity.COUNTS) == plain_counts(text)


LINES = [
    "the cat sat on the mat the end",
    "a cat and a hat on that mat",
    "then the rat ran \u00e9t\u00e9 \u00e9t\u00e9 \u732b\u732b \U0001f600",
]


def table(spark, lines):
    return spark.createDataFrame(lines, "lang string, text string")


def brute_scores(texts):
    """Score of each (lang, text), with words, by the definition."""
    words = defaultdict(Counter)
    for lang, text in texts:
        words[lang].update(text.split())
    models = {lang: Plain(own) for lang, own in words.items()}
    return [
        sum(-math.log(models[lang].p_out(g)) for w in text.split() for g in grams(w))
        / len(text.split())
        for lang, text in texts
    ]


@pytest.mark.parametrize("frequent", [0, 8, 1 << 20])
def test_scores_equal_the_definition(spark, frequent):
    """Also where n-grams are too many to be handed to every task."""
    texts = [*[("en", x) for x in LINES], ("fr", "le chat et le rat"), ("fr", "un chat"), ("xx", "q")]
    docs = table(spark, texts).selectExpr("text AS key", "lang", "text")
    got = {(r["lang"], r["key"]): r["score"] for r in perplexity.scored(docs, frequent).collect()}
    for line, want in zip(texts, brute_scores(texts)):
        assert got[line] == pytest.approx(want, abs=1e-4)


def test_probabilities_add_up(spark):
    """With nothing left out, over all characters that follow a context and all others."""
    tables = [perplexity.gram_counts(table(spark, [("en", " ".join(LINES))]))]
    for order in range(perplexity.ORDER - 1, 0, -1):
        rest = F.substring("gram", 2, order).alias("gram")
        tables.insert(0, tables[0].groupBy("lang", rest).agg(F.count("*").alias("n")))
    one = perplexity.order_table(tables[0], None, 1)
    kinds = one.count()
    seen = one.agg(F.sum("p")).first()[0]
    two = perplexity.order_table(tables[1], one, 2)
    p1 = {r["gram"]: r["p"] for r in one.collect()}
    p2 = defaultdict(dict)
    for r in two.collect():
        p2[r["gram"][0]][r["gram"][1]] = r["p"]
    plain = Plain(Counter(" ".join(LINES).split()))
    tables = plain.tables(plain.counts)
    # What is left belongs to the code points that no word has.
    assert seen + (1 / perplexity.UNIFORM - kinds) * plain.p("\u2603", tables) == pytest.approx(1)
    for context, own in p2.items():
        others = [c for c in p1 if c not in own]
        total = sum(own.values()) + sum(plain.p(context + c, tables) for c in others)
        unseen = (1 / perplexity.UNIFORM - kinds) * plain.p(context + "\u2603", tables)
        assert total + unseen == pytest.approx(1)


def test_model_is_sorted_arrays_that_grow(spark):
    def size(lines):
        model = perplexity.train(table(spark, lines)).collect()
        for r in model:
            assert r["hashes"] == sorted(set(r["hashes"])) and len(r["scores"]) == len(r["hashes"])
        return sum(len(r["hashes"]) for r in model)

    some = [("en", x) for x in LINES]
    assert size(some) < size([*some, ("en", "other words make more of them")])
    assert size([*some, *[("l" + str(i), LINES[0]) for i in range(80)]]) > 80 * 20


def test_a_word_seen_once_is_judged_by_others(spark):
    """It doesn't vouch for itself, in any script."""
    lines = [("ru", "\u043a\u043e\u0442 \u043a\u043e\u0442\u044b \u043a\u043e\u0442\u0430 \u043a\u043e\u0442\u0443")] * 5
    odd = "\u0449\u044a\u044b\u0444"
    docs = table(spark, [*lines, ("ru", odd), ("ru", "\u043a\u043e\u0442")])
    rows = perplexity.scored(docs.selectExpr("text AS key", "lang", "text")).collect()
    score = {r["key"]: r["score"] for r in rows}
    assert score[odd] > 5 * score["\u043a\u043e\u0442"]


def test_long_words_and_repeated_characters(spark):
    docs = table(spark, [("en", "a" * 300_000 + " word"), ("en", "word " * 40_000)])
    rows = perplexity.scored(docs.selectExpr("length(text) AS key", "lang", "text")).collect()
    assert all(r["score"] > 0 for r in rows) and {r["n_words"] for r in rows} == {2, 40_000}


def test_hard_documents(hard, none):
    rows = perplexity.quality(hard).collect()
    got = sorted(((r["doc_id"], *[r[c] for c in perplexity.COUNTS]) for r in rows), key=str)
    assert got == sorted(((r[0], *plain_counts(r[1])) for r in HARD), key=str)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        inside = r["perplexity"] is not None and r["low"] <= r["perplexity"] <= r["high"]
        assert r["kept"] == (not r["base_failed"] and inside)
    assert perplexity.quality(none).count() == 0


def test_other_columns_stay(spark):
    """Whatever their names."""
    row = (1, "en", "one two three four five six seven eight nine ten", "x")
    docs = spark.createDataFrame([row], ["doc_id", "lang", "text", "first_hash"])
    docs = docs.withColumnRenamed("doc_id", "a.b")
    kept = perplexity.good_documents(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [row]


def test_kept_rows_are_those_of_the_query(small, hard, none):
    for docs in (small, hard):
        kept = perplexity.good_documents(docs)
        assert kept.columns == docs.columns
        want = sorted(str(r["doc_id"]) for r in perplexity.quality(docs).where("kept").collect())
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == want
    assert perplexity.good_documents(none).count() == 0


def test_junk_goes_and_prose_stays(spark):
    """On a table with enough text of each language for its model."""
    small = read_table(spark, "/root/testdata/sf0.01", "documents")
    rows = {r["doc_id"]: r["kept"] for r in perplexity.quality(small).collect()}
    clean, junk = [], []
    for r in small.collect():
        text = r["text"]
        if len(text.split()) >= 40:
            marked = len(re.findall(r"[#*$%&]{3}(?= |$)", text)) > len(text.split()) / 3
            if marked:
                junk.append(rows[r["doc_id"]])
            elif not re.search(r"[#*$%&!]{2}| \| |\d", text) and plain_counts(text)[4] == 0:
                clean.append(rows[r["doc_id"]])
    assert sum(clean) >= 0.98 * len(clean) and len(clean) > 50
    assert len(junk) > 20 and sum(junk) <= 0.2 * len(junk)
