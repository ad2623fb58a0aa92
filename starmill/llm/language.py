"""Operator 2: language by unigrams of vocabulary pieces, summed over all segmentations.

A language gives each piece of a fixed public vocabulary a probability. A word's probability is
the sum over all ways to cut it into pieces, by the forward algorithm, so no segmentation has to
be chosen; a text's is the product over its words. The pieces are all those of a SentencePiece file
that hold text, found by 64-bit hashes, and all single bytes, so that every word can be cut.

Learning: expected piece counts (forward-backward) of the words of a sample, summed by Spark, for
``rounds`` rounds from equal probabilities. The sample has about ``sample`` labelled documents per
language, those whose key hashes lowest; it bounds the work of fitting, and prediction reads every
document whole. Every labelled language is learned; only pieces times languages meet on the driver.

Words lie between ASCII white space and may be of any length: they are worked through in blocks of
places, of which each hands on the sums of the places that its pieces reach beyond it, scaled so
that they stay within floating point.

Cases: null texts and texts without a letter are ``und`` with score 0, as are all texts when
nothing is labelled; equally likely languages give the one first by name; equal rows, or rows with
equal or null keys, are predicted one by one; an empty table gives an empty one; other columns are
not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import cut, pieces

# Places at which pieces start that are worked on between two scalings.
BLOCK = 16
SAMPLE, ROUNDS = 1_000, 3
# An odd factor of which the hashes of pieces are polynomials.
FACTOR = 0x9E3779B97F4A7C15
# Of the expected counts of all languages, the share that each language is given.
SHARED = 0.01
# Words a task remembers the scores of.
HELD = 200_000


class Pieces:
    """The vocabulary: pieces by sorted hashes of their bytes, ``␣`` for a word's start."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        words = {
            model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        }
        words |= {bytes([b]) for b in range(1, 256)}
        by_code = {packed(w): w for w in words if w and 0 not in w}
        if len(by_code) < sum(1 for w in words if w and 0 not in w):
            raise ValueError("two pieces have the same hash")
        self.codes = np.array(sorted(by_code), np.uint64)
        self.lengths = np.array([len(by_code[c]) for c in sorted(by_code)])
        self.size, self.longest = len(self.codes), int(self.lengths.max())
        self.used = frozenset(self.lengths.tolist())

    def find(self, words: np.ndarray, starts: int | None = None) -> list[np.ndarray]:
        """For words of one length (bytes, [words, length]) and each piece length from one on:
        the index of the piece that starts at each of the first ``starts`` places, or ``size``."""
        width = words.shape[1]
        starts = width if starts is None else starts
        found, code = [], np.zeros((len(words), starts), np.uint64)
        wide = words.astype(np.uint64)
        for n in range(1, min(self.longest, width) + 1):
            places = min(starts, width - n + 1)
            code = code[:, :places] * np.uint64(FACTOR) + wide[:, n - 1 : n - 1 + places]
            if n in self.used:
                at = np.minimum(np.searchsorted(self.codes, code), self.size - 1)
                same = (self.codes[at] == code) & (self.lengths[at] == n)
                found.append(np.where(same, at, self.size))
            else:
                found.append(np.full(code.shape, self.size))
        return found


def packed(word: bytes) -> int:
    code = 0
    for byte in word:
        code = (code * FACTOR + byte) % (1 << 64)
    return code


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Pieces:
    return Pieces(path)


def framed(word: bytes) -> bytes:
    """A word as the pieces see it: a blank, then its bytes."""
    return b" " + word.replace(b"\0", b"\x01")


def reached(found: list[np.ndarray], size: int) -> list[list[int]]:
    """Per place the lengths of pieces that start there in any of the words."""
    lengths: list[list[int]] = [[] for _ in range(found[0].shape[1])]
    for n, places in enumerate(found, 1):
        for start in np.flatnonzero((places != size).any(axis=0)):
            lengths[start].append(n)
    return lengths


def forward(found: list[np.ndarray], p: np.ndarray, before: np.ndarray, width: int) -> np.ndarray:
    """Probabilities of all prefixes, [words, width + 1, languages]; those that end beyond the
    places of ``found`` by the pieces that start in them or before. ``before`` is what earlier
    blocks give to the first of them."""
    words = len(before)
    alpha = np.zeros((words, width + 1, p.shape[1]))
    alpha[:, : before.shape[1]] = before
    for start, lengths in enumerate(reached(found, len(p) - 1)):
        for n in lengths:
            alpha[:, start + n] += alpha[:, start] * p[found[n - 1][:, start]]
    return alpha


def backward(
    found: list[np.ndarray], p: np.ndarray, after: np.ndarray | None = None
) -> np.ndarray:
    """Probabilities of all suffixes from the places of ``found`` on, followed by ``after``, those
    of the places behind."""
    words, starts = found[0].shape
    if after is None:
        after = np.ones((words, 1, p.shape[1]))
    beta = np.concatenate([np.zeros((words, starts, p.shape[1])), after], axis=1)
    for start, lengths in reversed(list(enumerate(reached(found, len(p) - 1)))):
        for n in lengths:
            beta[:, start] += beta[:, start + n] * p[found[n - 1][:, start]]
    return beta


def blocks(own: Pieces, length: int) -> list[tuple[int, int, int]]:
    """Of words of a length the first place of each block, its number of places, and the number of
    bytes that its pieces may cover."""
    return [
        (at, min(BLOCK, length - at), min(BLOCK + own.longest - 1, length - at))
        for at in range(0, length, BLOCK)
    ]


def log_totals(own: Pieces, data: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Log probabilities of words of one length, [words, languages]."""
    before = np.ones((len(data), 1, p.shape[1]))
    total = np.zeros((len(data), p.shape[1]))
    for at, starts, width in blocks(own, data.shape[1]):
        found = own.find(data[:, at : at + width], starts)
        before = forward(found, p, before, width)[:, starts:]
        most = before.max(axis=1, keepdims=True)
        before = before / most
        total += np.log(most[:, 0])
    return total


def add_expected(
    own: Pieces, data: np.ndarray, p: np.ndarray, n: np.ndarray, sums: np.ndarray
) -> None:
    """Adds to ``sums`` the expected pieces of words of one length, ``n`` times each, in the one
    language of ``p``."""
    given, parts = [np.ones((len(data), 1, 1))], blocks(own, data.shape[1])
    for at, starts, width in parts[:-1]:
        found = own.find(data[:, at : at + width], starts)
        before = forward(found, p, given[-1], width)[:, starts:]
        given.append(before / before.max(axis=1, keepdims=True))
    beta = np.ones((len(data), 1, 1))
    for (at, starts, width), before in zip(reversed(parts), reversed(given)):
        found = own.find(data[:, at : at + width], starts)
        alpha = forward(found, p, before, width)
        after = beta[:, : width - starts + 1]
        after = after / after.max(axis=1, keepdims=True)
        beta = backward(found, p, after)
        # Each way to cut a word has one piece that leaves the block.
        scale = n / (alpha[:, starts:] * after).sum(axis=(1, 2))
        for size, place in enumerate(found, 1):
            word, start = np.nonzero(place != own.size)
            if len(word):
                piece = place[word, start]
                used = alpha[word, start, 0] * beta[word, start + size, 0] * p[piece, 0]
                sums += np.bincount(piece, used * scale[word], len(p))


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of words of one length and their bytes, some thousand at a time, fewer long ones."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    edges = np.flatnonzero(np.diff(sizes[order])) + 1
    for group in np.split(order, edges):
        step = max(1, (1 << 16) // max(16, int(sizes[group[0]]))) if len(group) else 1
        for at in range(0, len(group), step):
            some = group[at : at + step]
            data = b"".join(words[i] for i in some)
            if data:
                yield some, np.frombuffer(data, np.uint8).reshape(len(some), -1)


def log_likelihoods(words: list[bytes], own: Pieces, p: np.ndarray) -> np.ndarray:
    """Of each word in each language, [words, languages]."""
    result = np.zeros((len(words), p.shape[1]))
    for index, data in by_length([framed(w) for w in words]):
        result[index] = log_totals(own, data, p)
    return result


# --- learning


def expected_counts(
    batches: Iterator[pa.RecordBatch], path: str, p: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: ``label`` (index of the language), ``word``, ``n`` to expected counts of
    pieces by language."""
    own, sums = vocabulary(path), np.zeros((p.shape[1], len(p)))
    for batch in batches:
        label, n = (np.asarray(batch.column(c).to_pylist(), np.int64) for c in ("label", "n"))
        words = [framed(w) for w in batch.column("word").to_pylist()]
        for index, data in by_length(words):
            lang = label[index]
            for one in np.unique(lang):
                rows = np.flatnonzero(lang == one)
                add_expected(own, data[rows], p[:, [one]], n[index[rows]], sums[one])
    label, piece = np.nonzero(sums)
    yield pa.RecordBatch.from_pydict(
        {"label": pa.array(label), "piece": pa.array(piece), "n": pa.array(sums[label, piece])}
    )


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: ``label`` and ``text`` to words with counts."""
    for batch in batches:
        for part in pieces(batch):
            held: dict[int, Counter] = {}
            for label, text in zip(part["label"], part["text"]):
                held.setdefault(label, Counter()).update((text or "").encode().split())
            for label, words in held.items():
                yield pa.RecordBatch.from_pydict(
                    {
                        "label": pa.array([label] * len(words), pa.int64()),
                        "word": pa.array(list(words), pa.binary()),
                        "n": pa.array(words.values(), pa.int64()),
                    }
                )


def learn(
    labelled: DataFrame, path: str, sample: int = SAMPLE, rounds: int = ROUNDS
) -> tuple[list[str], np.ndarray]:
    """Languages by name, and probabilities of pieces [pieces + 1, languages], from ``labelled``
    (``key``, ``lang``, ``text``). The last row, for what is no piece, is zero."""
    spark = labelled.sparkSession
    sizes = labelled.groupBy("lang").count()
    sizes = dict(sorted((r["lang"], r["count"]) for r in sizes.collect()))
    names, size = list(sizes), vocabulary(path).size
    if not names:
        return [], np.zeros((size + 1, 0))
    rows = [(lang, i, min(1.0, sample / n)) for i, (lang, n) in enumerate(sizes.items())]
    share = spark.createDataFrame(rows, "lang string, label long, share double")
    drawn = F.pmod(F.xxhash64("key"), F.lit(1_000_003)) < F.col("share") * 1_000_003
    words = cut(
        labelled.join(F.broadcast(share), "lang")
        .where(drawn)
        .select("label", "text")
        .mapInArrow(word_counts, "label long, word binary, n long")
        .groupBy("label", "word")
        .agg(F.sum("n").alias("n"))
    )
    p = np.full((size + 1, len(names)), 1.0 / size)
    p[size] = 0
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(p)
        summed = (
            words.mapInArrow(
                lambda batches, shared=shared: expected_counts(batches, path, shared.value),
                "label long, piece long, n double",
            )
            .groupBy("label", "piece")
            .agg(F.sum(F.col("n").cast("decimal(38,9)")).cast("double").alias("n"))
            .toPandas()  # pieces times languages at most
        )
        counts = np.zeros((size, len(names)))
        counts[summed["piece"], summed["label"]] = summed["n"]
        counts += SHARED * counts.mean(axis=1, keepdims=True) + 0.01
        p[:size] = counts / counts.sum(axis=0)
    return names, p


# --- prediction


def held_out(key: Column) -> Column:
    """Rows never learned from: the checksum of the key's text leaves 2 when divided by 4."""
    text = F.coalesce(key.cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % 4 == 2


def predict(texts: DataFrame, path: str, names: list[str], p: np.ndarray) -> DataFrame:
    """``texts`` (``key``, ``text``) as ``key``, ``lang_pred`` and ``score``, the probability of
    the language given the text."""
    shared = texts.sparkSession.sparkContext.broadcast(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, p = vocabulary(path), shared.value
        known: dict[bytes, int] = {}
        table = np.zeros((0, len(names)))
        for batch in batches:
            kind = batch.schema.field("key").type
            for part in pieces(batch):
                words = [(t or "").encode().split() for t in part["text"]]
                if len(known) > HELD:
                    known, table = {}, table[:0]
                new = list({w for ws in words for w in ws} - known.keys())
                if new and names:
                    known.update(zip(new, range(len(table), len(table) + len(new))))
                    table = np.concatenate([table, log_likelihoods(new, own, p)])
                langs, scores = [], []
                for text, ws in zip(part["text"], words):
                    if not names or not any(map(str.isalpha, text or "")):
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    index = np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))
                    total = table[index].sum(axis=0)
                    best = int(np.argmax(total))
                    langs.append(names[best])
                    scores.append(float(1.0 / np.exp(total - total[best]).sum()))
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(part["key"], kind),
                        "lang_pred": pa.array(langs, pa.string()),
                        "score": pa.array(scores, pa.float64()),
                    }
                )

    kind = texts.schema["key"].dataType.simpleString()
    return texts.mapInArrow(run, f"key {kind}, lang_pred string, score double")


def identify(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = SAMPLE,
) -> DataFrame:
    """Per document its key, ``held_out``, ``lang_pred`` and ``score``, learned from the labelled
    documents that aren't held out."""
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("string").alias("text"),
    )
    labelled = rows.where(~held_out(F.col("key")) & F.col("lang").isNotNull())
    names, p = learn(labelled, path, sample)
    return predict(rows.select("key", "text"), path, names, p).select(
        F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "lang_pred", "score"
    )
