"""Operator 4: quality rules by plain counts and by the perplexity of an n-gram model.

The model is an interpolated modified Kneser-Ney model over ``ORDER`` characters of words, as they
are, one per language, counted by Spark over all documents. Lower orders are counted from the
distinct n-grams of the order above (continuation counts). It grows with the text and is never
gathered: it is stored as Parquet, in blocks of sorted arrays of hashes and log probabilities.

As a document is scored by a model that has counted it, each probability leaves one occurrence of
its n-gram out: a count goes down by one, and where it was the only one the n-gram's continuation
goes too. So a word that stands once in the corpus is judged by the words that resemble it.

1. Tasks count words, and hand on the n-grams of the distinct ones.
2. Documents are read once more. The most frequent n-grams, ``FREQUENT`` at most, are handed to
   every task as one sorted array of hashes and one of log probabilities; all others are joined to
   the model by their hash.

A document's score is the log of its perplexity per word: the mean negative log probability of its
words, each with its end, in millionths, so that sums don't depend on their order. The scores of
all documents of a language give a median and a median distance from it; a document is rejected
outside ``median - lower * distance`` and ``median + upper * distance``, both widened by
``short / sqrt(words)`` as short documents scatter.

Cases: null texts and texts without words count as empty and fail the plain rules; documents
without a language share one; a language of one document has a band around that document; equal
rows, or rows with equal or null keys, are judged one by one; an empty table gives an empty one;
other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from starmill.llm.common import cut, fresh, pieces, returning

ORDER = 5
# Before and after a word; white space is in none.
START, END = " ", "\n"
# What no n-gram tells: every code point is as likely.
UNIFORM = 2.0**-21
# N-grams in a block of the stored model, about.
BLOCK = 1 << 14
# N-grams that are handed to every task, at 16 bytes each.
FREQUENT = 1 << 20
# Distinct words that a task counts before it hands on their n-grams, and that it remembers.
HELD = 100_000
MILLION = 1_000_000
LOWER, UPPER, SHORT, LEAST = 1.0, 10.0, 13.0, 0.1
OTHER = ""


# --- n-grams


def windows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the n-grams that end at each character of each word and at its end, and the
    index of the word."""
    apart = END + START * (ORDER - 1)
    line = START * (ORDER - 1) + apart.join(b"\0".join(words).decode("utf-8", "replace").split("\0"))
    points = np.frombuffer((line + END).encode("utf-32-le", "replace"), "<u4")
    found = np.lib.stride_tricks.sliding_window_view(points, ORDER)
    last = found[:, -1]
    found = found[last != ord(START)]
    ends = found[:, -1] == ord(END)
    return found, np.cumsum(ends) - ends


def hashes(points: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """A hash of 64 bits of each n-gram, from its code points and a seed for its language."""
    found = np.full(len(points), seed, np.uint64)
    for column in points.T:
        found = (found ^ column) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return found.view(np.int64)


def seed(lang: str) -> int:
    return xxh64_intdigest(lang.encode())


def plain_words(text: str | None) -> list[bytes]:
    """Runs between ASCII white space; the zero character counts as a replacement character."""
    return (text or "").replace("\0", "\ufffd").encode().split()


def gram_counts(texts: DataFrame) -> DataFrame:
    """``lang``, ``gram`` and its frequency ``n`` over all words of ``texts`` (``lang``, ``text``)."""

    @returning
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for part in pieces(batch):
                for lang, text in zip(part["lang"], part["text"]):
                    held[lang].update(plain_words(text))
                if sum(map(len, held.values())) >= HELD:
                    yield from emit(held)
                    held.clear()
        yield from emit(held)

    def emit(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, words in held.items():
            if words:
                points, word = windows(list(words))
                n = np.fromiter(words.values(), np.int64, len(words))[word]
                _, first, place = np.unique(
                    hashes(points, 0), return_index=True, return_inverse=True
                )
                total = np.bincount(place, weights=n).astype(np.int64)
                own = np.ascontiguousarray(points[first]).view(f"<U{ORDER}").ravel()
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(own), pa.string()),
                        "gram": pa.array(own.tolist(), pa.string()),
                        "n": pa.array(total),
                    }
                )

    counted = texts.select("lang", "text").mapInArrow(run, "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# --- the model


def discounts(table: DataFrame) -> DataFrame:
    """``lang`` and ``d1`` to ``d3``: what one, two, and three or more counts give away."""
    n = [F.sum(F.when(F.col("n") == k, 1).otherwise(0)).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = "n1 / (n1 + 2 * n2)"
    usable = "n1 > 0 AND n2 > 0 AND n3 > 0"
    d = [f"{k} - {k + 1} * {y} * n{k + 1} / n{k}" for k in (1, 2, 3)]
    # Where counts of counts are missing: half of each count up to three.
    return table.groupBy("lang").agg(*n).select(
        "lang",
        *[
            F.expr(
                f"CASE WHEN {usable} THEN greatest(0.1D, least({k}D, {x})) ELSE {k} / 2D END"
            ).alias(f"d{k}")
            for k, x in enumerate(d, 1)
        ],
    )


def given(n: str) -> str:
    """SQL for what a count gives away."""
    return f"CASE WHEN {n} < 1 THEN 0D WHEN {n} = 1 THEN d1 WHEN {n} = 2 THEN d2 ELSE d3 END"


def order_table(table: DataFrame, below: DataFrame | None, order: int) -> DataFrame:
    """``lang``, ``gram``, ``p`` (probability of its last character after the others) and ``p_out``
    (the same with one of its counts left out) of one order, from counts ``table`` and the table
    of the order below."""
    context = F.substring("gram", 1, order - 1)
    rows = table.join(discounts(table), "lang").withColumn("context", context)
    # Numbers of counts are summed, not discounts, so sums don't depend on their order.
    ones, twos = [F.sum(F.when(F.col("n") == k, 1).otherwise(0)) for k in (1, 2)]
    total = rows.groupBy("lang", "context").agg(
        F.sum("n").alias("total"), ones.alias("ones"), twos.alias("twos"), F.count("*").alias("kinds")
    )
    rows = rows.join(total, ["lang", "context"]).withColumn(
        "free", F.expr("ones * d1 + twos * d2 + (kinds - ones - twos) * d3")
    )
    if below is None:
        rows = rows.withColumn("q", F.lit(UNIFORM)).withColumn("q_out", F.lit(UNIFORM))
    else:
        lower = below.select(
            "lang", F.col("gram").alias("rest"), F.col("p").alias("q"), F.col("p_out").alias("q_out")
        )
        rows = rows.withColumn("rest", F.substring("gram", 2, order)).join(lower, ["lang", "rest"])
    seen = f"(n - ({given('n')})) / total + free / total * q"
    less = f"greatest(free - ({given('n')}) + ({given('n - 1')}), 0D)"
    out = (
        f"CASE WHEN total = 1 THEN q_out ELSE (n - 1 - ({given('n - 1')})) / (total - 1)"
        f" + {less} / (total - 1) * CASE WHEN n = 1 THEN q_out ELSE q END END"
    )
    return rows.select("lang", "gram", "n", F.expr(seen).alias("p"), F.expr(out).alias("p_out"))


def train(texts: DataFrame) -> DataFrame:
    """The models of all languages of ``texts`` (``lang``, ``text``) in blocks: sorted ``hashes`` of
    n-grams, their frequencies ``ns``, and ``scores``, the negative log probabilities with one
    occurrence left out, in millionths."""
    tables = [cut(gram_counts(texts))]
    for order in range(ORDER - 1, 0, -1):
        rest = F.substring("gram", 2, order).alias("gram")
        tables.insert(0, cut(tables[0].groupBy("lang", rest).agg(F.count("*").alias("n"))))
    below = None
    for order, table in enumerate(tables, 1):
        below = cut(order_table(table, below, order))

    @returning
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            line = "".join(batch.column("gram").to_pylist()).encode("utf-32-le")
            points = np.frombuffer(line, "<u4").reshape(-1, ORDER)
            lang = batch.column("lang").dictionary_encode()
            seeds = np.array([seed(x) for x in lang.dictionary.to_pylist()], np.uint64)
            found = hashes(points, seeds[lang.indices.to_numpy()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), *batch.columns[2:]], names=["hash", "n", "score"]
            )

    score = F.round(F.log("p_out") * -MILLION).cast("long").alias("score")
    rows = below.select("lang", "gram", "n", score)
    bits = (below.count() // BLOCK).bit_length()
    block = F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0).cast("long")
    return (
        rows.mapInArrow(run, "hash long, n long, score long")
        .groupBy(block.alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("hash", "n", "score"))).alias("x"))
        .select(
            "block",
            F.col("x.hash").alias("hashes"),
            F.col("x.n").alias("ns"),
            F.col("x.score").alias("scores"),
        )
    )


def entries(model: DataFrame) -> DataFrame:
    """``hash``, ``n`` and ``score`` of each n-gram."""
    rows = model.select(F.explode(F.arrays_zip("hashes", "ns", "scores")).alias("x"))
    return rows.select(
        F.col("x.hashes").alias("hash"), F.col("x.ns").alias("n"), F.col("x.scores").alias("score")
    )


def frequent_grams(model: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the most frequent n-grams, ``most`` at most, and their scores."""
    rows = entries(model)
    size = F.floor(F.log2("n")).cast("int")
    by_size = rows.groupBy(size.alias("size")).count().collect()  # 64 rows at most
    least, total = 63, 0
    for row in sorted(by_size, reverse=True):
        total += row["count"]
        if total > most:
            break
        least = row["size"]
    rows = rows.where(F.col("n") >= 2**least if least < 63 else F.lit(False))
    found = rows.select("hash", "score").toArrow().sort_by("hash")
    return found["hash"].to_numpy(), found["score"].to_numpy()


# --- documents


def base_counts(text: str) -> dict[str, int]:
    """Plain counts of a text; words are runs between ASCII white space."""
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) < len(windows):
        times, reached = Counter(windows), 0
        for i, window in enumerate(windows):
            if times[window] > 1:
                repeated += i + 5 - max(i, reached)
                reached = i + 5
    return {
        "n_words": len(words),
        "word_chars": len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")),
        "n_symbols": sum(map(text.count, "#*$%&|<>")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated,
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Scorer:
    """Plain counts of texts, the sums of their frequent n-grams' scores, and their other n-grams."""

    def __init__(self, frequent: np.ndarray, scores: np.ndarray):
        self.frequent, self.scores = frequent, scores
        self.known: dict[str, dict[bytes, int]] = defaultdict(dict)
        self.rare: dict[str, dict[bytes, list[int]]] = defaultdict(dict)

    def learn(self, lang: str, words: list[bytes]) -> None:
        """Sums of words' frequent n-grams, and hashes of their others."""
        points, word = windows(words)
        keys = hashes(points, seed(lang))
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, keys), len(self.frequent) - 1)
            found = self.frequent[at] == keys
            score = np.where(found, self.scores[at], 0)
        else:
            found, score = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        first = np.searchsorted(word, np.arange(len(words)))
        self.known[lang].update(zip(words, np.add.reduceat(score, first).tolist()))
        rare = self.rare[lang]
        for i, key in zip(word[~found].tolist(), keys[~found].tolist()):
            rare.setdefault(words[i], []).append(key)

    def rows(self, langs: list[str], texts: list[str | None]) -> list[dict]:
        words = [plain_words(t) for t in texts]
        if sum(map(len, self.known.values())) > HELD:
            self.known.clear()
            self.rare.clear()
        for lang in set(langs):
            new = {w for l, ws in zip(langs, words) if l == lang for w in ws}
            new = list(new - self.known[lang].keys())
            if new:
                self.learn(lang, new)
        found = []
        for lang, text, ws in zip(langs, texts, words):
            known, odd, rare = self.known[lang], self.rare[lang], Counter()
            if odd:
                for word in ws:
                    if word in odd:
                        rare.update(odd[word])
            rare = [{"hash": h, "times": n} for h, n in rare.items()]
            total = sum(map(known.__getitem__, ws))
            found.append(base_counts(text or "") | {"total": total, "rare": rare})
        return found


def scored(texts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``key``, ``lang``, the plain counts and ``score`` (null without words) of each of ``texts``
    (``key``, ``lang``, ``text``), by models of these texts."""
    model = cut(train(texts))
    shared = texts.sparkSession.sparkContext.broadcast(frequent_grams(model, frequent))
    rare = pa.list_(pa.struct([("hash", pa.int64()), ("times", pa.int64())]))

    @returning
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*shared.value)
        for batch in batches:
            kind = batch.schema.field("key").type
            for part in pieces(batch):
                rows = own.rows(part["lang"], part["text"])
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array(part["row"], pa.int64()),
                        "key": pa.array(part["key"], kind),
                        "lang": pa.array(part["lang"], pa.string()),
                        **{c: pa.array([x[c] for x in rows], pa.int64()) for c in COUNTS},
                        "total": pa.array([x["total"] for x in rows], pa.int64()),
                        "rare": pa.array([x["rare"] for x in rows], rare),
                    }
                )

    kind = texts.schema["key"].dataType.simpleString()
    numbers = "".join(f"{c} long, " for c in COUNTS)
    # Keys may repeat or be null, so rows are told apart by their place in the scan.
    parts = cut(
        texts.select(F.monotonically_increasing_id().alias("row"), "key", "lang", "text").mapInArrow(
            run,
            f"row long, key {kind}, lang string, {numbers}total long,"
            " rare array<struct<hash: long, times: long>>",
        )
    )
    further = (
        parts.select("row", F.explode("rare").alias("x"))
        .select("row", "x.*")
        .join(entries(model).select("hash", "score"), "hash")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("score")).alias("more"))
    )
    whole = F.col("total") + F.coalesce("more", F.lit(0))
    score = F.when(F.col("n_words") > 0, whole / F.col("n_words") / MILLION)
    return parts.drop("rare").join(further, "row", "left").select(
        "key", "lang", *COUNTS, score.alias("score")
    )


def bands(scores: DataFrame) -> DataFrame:
    """``lang``, ``median`` and ``distance`` of the scores, in steps of a hundredth, so that only
    counts per step meet."""
    step = F.round("score", 2)
    steps = scores.where("score IS NOT NULL").groupBy("lang", step.alias("x")).count()
    middle = steps.groupBy("lang").agg(F.percentile("x", F.lit(0.5), F.col("count")).alias("median"))
    return (
        steps.join(middle, "lang")
        .groupBy("lang", "median")
        .agg(F.percentile(F.abs(F.col("x") - F.col("median")), F.lit(0.5), F.col("count")).alias("distance"))
    )


class Rules:
    """How far from the median a score may lie, and what plain counts fail."""

    def __init__(self, lower: float = LOWER, upper: float = UPPER, short: float = SHORT):
        self.lower, self.upper, self.short = lower, upper, short

    def judged(self, rows: DataFrame) -> DataFrame:
        """``rows`` (counts, ``score``, ``median``, ``distance``) with ``base_failed``, the logs
        ``low`` and ``high`` of the band, and ``kept``."""
        width = F.greatest("distance", F.lit(LEAST))
        slack = F.lit(self.short) / F.sqrt(F.greatest("n_words", F.lit(1)))
        failed = F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
        return (
            rows.withColumn("low", F.col("median") - self.lower * width - slack)
            .withColumn("high", F.col("median") + self.upper * width + slack)
            .withColumn("base_failed", failed)
            .withColumn(
                "kept", ~failed & F.col("score").between(F.col("low"), F.col("high"))
            )
        )


def judged(texts: DataFrame, rules: Rules | None = None) -> DataFrame:
    """``texts`` (``key``, ``lang``, ``text``) without the text, with counts, score and verdict."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(OTHER)).alias("lang")
    scores = cut(scored(texts.select("key", lang, F.col("text").cast("string"))))
    return (rules or Rules()).judged(scores.join(bands(scores), "lang", "left"))


def quality(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rules: Rules | None = None,
) -> DataFrame:
    """Per document its key, the plain counts, ``base_failed``, ``perplexity`` (null without
    words), ``low`` and ``high`` (its band) and ``kept``."""
    texts = docs.select(
        F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    return judged(texts, rules).select(
        F.col("key").alias(key),
        *COUNTS,
        "base_failed",
        F.exp("score").alias("perplexity"),
        F.exp("low").alias("low"),
        F.exp("high").alias("high"),
        "kept",
    )


def good_documents(
    docs: DataFrame, text: str = "text", lang: str = "lang", rules: Rules | None = None
) -> DataFrame:
    """The rows and columns of ``docs`` that are kept.

    A verdict follows from language and text, so two hashes of both name what is rejected; rows
    need no key, and texts are not copied to be numbered.
    """
    own = F.coalesce(F.col(lang).cast("string"), F.lit(OTHER))
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    hashes = [F.xxhash64(F.lit(seed), own, whole) for seed in (1, 2)]
    texts = docs.select(F.struct(*hashes).alias("key"), own.alias("lang"), whole.alias("text"))
    names = [fresh(docs, "first_hash"), fresh(docs, "second_hash")]
    bad = judged(texts, rules).where("NOT coalesce(kept, false)")
    bad = cut(bad.select("key.*").toDF(*names).distinct())
    marked = docs.select("*", *[h.alias(n) for h, n in zip(hashes, names)])
    return marked.join(bad, names, "left_anti").drop(*names)
