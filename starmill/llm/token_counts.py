"""Operator 3: token counts of documents by counting each distinct pre-token once.

1. Every text is split into pre-tokens; Spark sums their frequencies over all documents.
2. The library encodes each distinct pre-token once; only the number of its pieces is kept.
3. Documents join these numbers to their own pre-token frequencies, and the products are summed.

The join has two sides by frequency. The most frequent pre-tokens, ``frequent`` at most and none
longer than ``LONGEST`` bytes, are handed to every task, which bounds the broadcast whatever the
corpus; a task sums them where it reads the text. All others are joined by Spark; none of them is
frequent, so no key is hot. Token ids are never kept for a document.

Cases: a null text counts as empty, an empty text has no tokens; strings of added tokens inside
texts count as one each, as the library does by default; equal rows, and rows with equal or null
keys, are counted on their own; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starmill.llm.bpe import RUN, ByteBPE
from starmill.llm.common import cut, pieces

FREQUENT = 1 << 17
LONGEST = 64
# Distinct runs of text a task counts before it hands them on.
HELD = 200_000


@lru_cache(maxsize=2)
def splitter(path: str) -> ByteBPE:
    return ByteBPE(path)


@lru_cache(maxsize=2)
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def count_runs(bpe: ByteBPE, text: str) -> tuple[Counter, int]:
    """Frequencies of a text's runs between white space, and its number of added tokens."""
    runs, special = Counter(), 0
    for stretch, number in bpe.split_special(text):
        if number is None:
            runs.update(RUN.findall(stretch))
        else:
            special += 1
    return runs, special


def frequencies(path: str) -> Callable:
    """For ``mapInArrow``: texts to pre-tokens with their frequency in a stretch of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, held = splitter(path), Counter()
        for batch in batches:
            for part in pieces(batch):
                for text in part["text"]:
                    for stretch, number in bpe.split_special(text or ""):
                        if number is None:
                            held.update(RUN.findall(stretch))
                    if len(held) >= HELD:
                        yield emit(bpe, held)
                        held = Counter()
        yield emit(bpe, held)

    def emit(bpe: ByteBPE, runs: Counter) -> pa.RecordBatch:
        found = Counter()
        for text, n in runs.items():
            for word in bpe.words(text):
                found[word] += n
        return pa.RecordBatch.from_pydict(
            {"piece": pa.array(list(found), pa.binary()), "n": pa.array(found.values(), pa.int64())}
        )

    return run


def piece_counts(path: str) -> Callable:
    """For ``mapInArrow``: adds the number of tokens of each pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = library(path)
        for batch in batches:
            # One by one: a batch's encodings, and the threads and heaps the library takes for them,
            # are more than all else that a task holds.
            words = batch.column("piece").to_pylist()
            tokens = [len(own.encode(w.decode(), add_special_tokens=False).ids) for w in words]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tokens, pa.int64())],
                names=[*batch.schema.names, "tokens"],
            )

    return run


def piece_table(texts: DataFrame, path: str) -> DataFrame:
    """All distinct pre-tokens: ``piece`` (UTF-8), frequency ``n``, number of ``tokens``."""
    return (
        texts.select(F.col("text"))
        .mapInArrow(frequencies(path), "piece binary, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .mapInArrow(piece_counts(path), "piece binary, n long, tokens long")
    )


def frequent_pieces(pieces_: DataFrame, most: int) -> tuple[dict[bytes, int], int]:
    """Tokens by piece for pieces of at least the returned frequency, ``most`` at most."""
    short = pieces_.where(F.octet_length("piece") <= LONGEST)
    size = F.floor(F.log2("n")).cast("int")
    by_size = short.groupBy(size.alias("size")).count().collect()  # 64 rows at most
    least, total = 64, 0
    for row in sorted(by_size, reverse=True):
        total += row["count"]
        if total > most:
            break
        least = row["size"]
    rows = short.where(F.col("n") >= 2**least if least < 63 else F.lit(False)).collect()
    return {bytes(r["piece"]): r["tokens"] for r in rows}, 2**least


def count_tokens(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """Per document its key, ``n_bytes`` and ``n_tokens``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    table = cut(piece_table(texts, path))
    known, least = frequent_pieces(table, frequent)
    shared = spark.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known = splitter(path), shared.value
        seen: dict[str, tuple[int, tuple[bytes, ...]]] = {}
        for batch in batches:
            kind = batch.schema.field("key").type
            for part in pieces(batch):
                rows, keys, sizes, words, counts = [], [], [], [], []
                for row, key_, text_ in zip(part["row"], part["key"], part["text"]):
                    runs, total = count_runs(bpe, text_ or "")
                    rare = Counter()
                    for r, n in runs.items():
                        found = seen.get(r)
                        if found is None:
                            split = [(known.get(w), w) for w in bpe.words(r)]
                            found = (
                                sum(tokens for tokens, _ in split if tokens is not None),
                                tuple(w for tokens, w in split if tokens is None),
                            )
                            if len(seen) >= HELD:
                                seen.clear()
                            seen[r] = found
                        total += n * found[0]
                        for w in found[1]:
                            rare[w] += n
                    rows += [row] * (1 + len(rare))
                    keys += [key_] + [None] * len(rare)
                    sizes += [len((text_ or "").encode())] + [None] * len(rare)
                    words += [None, *rare]
                    counts += [total, *rare.values()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array(rows, pa.int64()),
                        "key": pa.array(keys, kind),
                        "n_bytes": pa.array(sizes, pa.int64()),
                        "piece": pa.array(words, pa.binary()),
                        "n": pa.array(counts, pa.int64()),
                    }
                )

    kind = texts.schema["key"].dataType.simpleString()
    # Keys may repeat or be null, so rows are told apart by their place in the scan.
    parts = texts.select(F.monotonically_increasing_id().alias("row"), "key", "text").mapInArrow(
        run, f"row long, key {kind}, n_bytes long, piece binary, n long"
    )
    parts = cut(parts)
    own = parts.where(F.col("piece").isNull()).select("row", "key", "n_bytes", "n")
    rare = (
        parts.where(F.col("piece").isNotNull())
        .select("row", "piece", "n")
        .join(table.select("piece", "tokens"), "piece")
        .select(
            "row",
            F.lit(None).cast(kind).alias("key"),
            F.lit(None).cast("long").alias("n_bytes"),
            (F.col("n") * F.col("tokens")).alias("n"),
        )
    )
    return (
        own.unionAll(rare)
        .groupBy("row")
        .agg(
            F.max("key").alias(key),
            F.max("n_bytes").alias("n_bytes"),
            F.sum("n").alias("n_tokens"),
        )
        .drop("row")
    )
