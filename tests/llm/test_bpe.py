"""Operators 3 and 5 against the library."""

import hashlib
import random
import string
import struct
import subprocess
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starmill.llm.bpe import ByteBPE
from starmill.llm.bpe_codec import Codec, TrieEncoder, bpe_digest, bpe_documents
from starmill.llm.token_counts import count_tokens
from tests.llm.texts import HARD

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return Codec(PATH)


def ids(data: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def same(codec, library, texts):
    for text, own, ref in zip(
        texts, codec.encode(texts), library.encode_batch(texts, add_special_tokens=False)
    ):
        assert ids(own) == ref.ids, ascii(text)
        assert codec.decode(own) == library.decode(ref.ids, skip_special_tokens=False)


def test_characters_in_context(codec, library):
    points = [*range(0, 0x3000), *range(0xA000, 0xD800, 7), *range(0xE000, 0x20000, 11)]
    same(codec, library, [f"a{c}b {c} 1{c}2  {c}{c}.'s{c}\n{c}" for c in map(chr, points)])


def test_random_texts(codec, library):
    draw = random.Random(5)
    parts = [*"ab \n\t'stre.,1é", "  ", "ing", "tion", " the", "<|endoftext|>", "日", "🙂", "\u00a0"]
    same(
        codec,
        library,
        ["".join(draw.choices(parts, k=draw.randint(0, 40))) for _ in range(5000)],
    )


def test_words_are_merged_as_defined(codec):
    draw = random.Random(6)
    words = {bytes(draw.choices(b"aeinorst", k=draw.randint(1, 14))) for _ in range(3000)}
    parts = codec.bpe.parts
    for word, tokens in codec.trie.walk(words):
        assert [parts[i] for i in tokens] == codec.bpe.merge(word)


def test_forgetting_changes_nothing(codec, library, texts, monkeypatch):
    monkeypatch.setattr("starmill.llm.bpe_codec.REMEMBERED", 50)
    same(Codec(PATH), library, list(texts.values())[:50])


def expected(library, text):
    found = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(found, skip_special_tokens=False)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return len(found), sha(struct.pack(f"<{len(found)}I", *found)), sha(decoded.encode())


def test_digest_of_hard_documents(hard, none, library):
    got = sorted(map(tuple, bpe_digest(hard, PATH).collect()), key=str)
    assert got == sorted(((r[0], *expected(library, r[1])) for r in HARD), key=str)
    assert bpe_digest(none, PATH).count() == 0


def test_round_trip(small, texts):
    for r in bpe_documents(small, PATH).collect():
        assert r["decoded"] == texts[r["key"]]


@pytest.mark.parametrize("frequent", [0, 20, 1 << 17])
def test_counts(hard, small, none, texts, library, frequent):
    count = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    got = sorted(map(tuple, count_tokens(hard, PATH, frequent=frequent).collect()), key=str)
    want = [(r[0], len((r[1] or "").encode()), count(r[1])) for r in HARD]
    assert got == sorted(want, key=str)
    assert count_tokens(none, PATH).count() == 0
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(small, PATH, frequent=frequent).collect()}
    assert got == {i: count(t) for i, t in texts.items()}


def test_words_of_plain_runs(library):
    """Letters behind a space, and one mark after them, as the library splits them."""
    bpe = ByteBPE(PATH)
    for body in ["a", "Word", "naïve", "ª", "x1", "don't", "it's", "a'", "'s", "²", "é2", "_", "a_b", ""]:
        for mark in ["", *string.punctuation, "..", "\x00", "·", "s"]:
            for run in (body + mark, " " + body + mark):
                if run:
                    want = library.pre_tokenizer.pre_tokenize_str(run)
                    assert bpe.words(run) == [run[a:b].encode() for _, (a, b) in want], run


ENCODING = """
import os, sys
import pyarrow as pa
from starmill.llm import token_counts as tc
words = [f" word{i}".encode() for i in range(20000)]
batch = pa.RecordBatch.from_pydict({"piece": pa.array(words, pa.binary())})
tc.library(sys.argv[1]).encode("a")
threads = len(os.listdir("/proc/self/task"))
assert sum(b.num_rows for b in tc.piece_counts(sys.argv[1])(iter([batch]))) == len(words)
print(len(os.listdir("/proc/self/task")) - threads)
"""


def test_encoding_pieces_starts_no_threads():
    """The library's own threads each take a heap that a worker keeps."""
    done = subprocess.run([sys.executable, "-c", ENCODING, PATH], capture_output=True, text=True, check=True)
    assert done.stdout.strip() == "0"


def test_states_are_settled_on_demand(codec):
    """A word that is one token asks for the state at its end alone, a long one for each once."""
    asked = []
    trie = TrieEncoder(codec.bpe)
    candidates = trie._candidates
    trie._candidates = lambda ends, word, end: asked.append(end) or candidates(ends, word, end)
    assert list(trie.walk([b" information"])) == [(b" information", [codec.bpe.ids[b" information"]])]
    assert asked == [len(b" information")]
    asked.clear()
    word = bytes(random.Random(5).choices(b"ab=/xyz", k=5000))
    ((_, ids),) = trie.walk([word])
    assert b"".join(codec.bpe.parts[i] for i in ids) == word
    assert len(asked) == len(set(asked))


def test_tokens_at_an_end_come_from_one_step_a_byte(codec):
    """The automaton names every token that ends at a place, the longest first."""
    draw = random.Random(7)
    trie, ids = codec.trie, codec.bpe.ids
    for _ in range(300):
        word = bytes(draw.choices(b" aeinorst\xc3\xa9", k=draw.randint(1, 14)))
        nodes = [0]
        for byte in word:
            nodes.append(trie._fallen(nodes[-1], byte))
        for end in range(1, len(word) + 1):
            found, token = [], trie._candidates(nodes, word, end)
            while token >= 0:
                found.append(token)
                token = trie.shorter[token]
            assert found == [ids[word[i:end]] for i in range(end) if word[i:end] in ids]
