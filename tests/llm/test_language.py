"""Operator 2: the sum over segmentations by listing them, and accuracy on held-out documents."""

import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest

from starmill.llm import language
from tests.llm.texts import HARD

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def own():
    return language.vocabulary(PATH)


def test_forward_sums_all_segmentations(own):
    draw = np.random.default_rng(4)
    p = np.vstack([draw.random((own.size, 2)) / 50, np.zeros((1, 2))])
    index = {int(c): i for i, c in enumerate(own.codes)}
    for word in ("river", "Sky,", "été", "a", "tionlyre"):
        data = b" " + word.encode()
        total = np.zeros(2)
        for n in range(len(data)):
            for cuts in combinations(range(1, len(data)), n):
                edges = [0, *cuts, len(data)]
                parts = [data[a:b] for a, b in zip(edges, edges[1:])]
                places = [index.get(language.packed(x)) for x in parts if len(x) <= 8]
                if len(places) == len(parts) and None not in places:
                    total += np.prod(p[places], axis=0)
        got = language.log_likelihoods([word.encode()], own, p)[0]
        assert np.allclose(np.exp(got), total, rtol=1e-9)
        found = own.find(np.frombuffer(data, np.uint8)[None])
        assert np.allclose(language.backward(found, p)[0, 0], total, rtol=1e-9)


def test_held_out_accuracy(small):
    truth = {r["doc_id"]: r["lang"] for r in small.collect()}
    rows = language.identify(small, PATH, sample=60).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {*truth.values(), "und"}
    apart = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in apart) / len(apart) >= 0.95


def test_hard_documents(hard, none):
    rows = language.identify(hard, PATH).collect()
    assert len(rows) == len(HARD)
    und = sum(r["lang_pred"] == "und" for r in rows)
    assert und == sum(not any(map(str.isalpha, r[1] or "")) for r in HARD)
    assert all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert language.identify(none, PATH).count() == 0
    unlabelled = language.identify(hard.where("lang IS NULL"), PATH).collect()
    assert {r["lang_pred"] for r in unlabelled} == {"und"}


def plain_log(own, word, q):
    """Log of the sum over segmentations into pieces of any length, place by place in Python."""
    index = {int(c): i for i, c in enumerate(own.codes)}
    data = b" " + word.encode()
    total = [0.0] + [-np.inf] * len(data)
    for end in range(1, len(data) + 1):
        ways = [
            total[start] + np.log(q[index[code]])
            for start in range(max(0, end - own.longest), end)
            if (code := language.packed(data[start:end])) in index
        ]
        total[end] = np.logaddexp.reduce(ways)
    return total[-1]


def test_every_text_piece_takes_part(own):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    codes = set(map(int, own.codes))
    text = [
        model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    ]
    assert sum(len(w) > 8 for w in text) > 1000
    assert all(language.packed(w) in codes for w in text if 0 not in w)


def test_long_pieces_and_long_words(own):
    """Sums and expected counts, for words of many blocks too; no segmentation is lost."""
    draw = np.random.default_rng(5)
    p = np.vstack([draw.random((own.size, 2)) / 50, np.zeros((1, 2))])
    words = ["international", "x" + "international" * 9, "Übersetzungen", "日本語の文章" * 40, "q" * 5000]
    got = language.log_likelihoods([w.encode() for w in words], own, p)
    for word, row in zip(words, got):
        assert row == pytest.approx([plain_log(own, word, p[:, k]) for k in (0, 1)], rel=1e-9)
    assert own.longest > 8
    for word in words[:4]:
        data = np.frombuffer(language.framed(word.encode()), np.uint8)[None]
        sums = np.zeros(own.size + 1)
        language.add_expected(own, data, p[:, [0]], np.array([1]), sums)
        # The pieces cover each byte once, and a piece's count is the slope of the log sum.
        assert (sums[:-1] * own.lengths).sum() == pytest.approx(data.shape[1], rel=1e-9)
        for piece in np.argsort(sums)[-3:]:
            more = p[:, 0].copy()
            more[piece] *= 1.0001
            slope = (plain_log(own, word, more) - plain_log(own, word, p[:, 0])) / np.log(1.0001)
            assert sums[piece] == pytest.approx(slope, rel=1e-3)


def test_every_labelled_language_is_learned(spark):
    rows = [(i, f"word{i % 300} text", f"l{i % 300:03}") for i in range(1200)]
    rows += [(2000 + i, f"word{i} text", f"l{i:03}") for i in range(299)]  # l299 is the rarest
    df = spark.createDataFrame(rows, "key long, text string, lang string")
    names, p = language.learn(df.select("key", "lang", "text"), PATH, rounds=1)
    assert names == sorted({r[2] for r in rows}) and p.shape[1] == 300
