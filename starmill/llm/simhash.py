"""Operator 1: SimHash near-duplicates by bit-sliced comparison.

1. A 64-bit fingerprint per document; copies share one, so only distinct ones are compared.
2. Two fingerprints at most ``radius`` bits apart agree in two of ``radius + 2`` blocks of bits.
   Each fingerprint goes to one bucket per two blocks. A bucket of more than ``most`` is dealt
   out again by the bits it does not fix yet, and so on until so few bits are left that no bucket
   can be larger; so no task gets an unbounded bucket and no pair is lost.
3. In a bucket the bits are stored vertically: 64 fingerprints per word, one word per bit. The
   distances of one fingerprint to 64 others are counted together, by a carry-save counter of a
   few words that starts so that it overflows beyond the radius. A block of 64 whose members have
   all overflowed is left out of the remaining bits.
4. A bucket gives a star per connected group, never its pairs; Spark joins stars to components.

Cases: a text without words (null and empty ones too) has fingerprint zero and links like any
other; fewer words than a shingle give one shingle of them all; rows with equal or null keys keep
their rows, and a null key never becomes a component's id unless all its keys are null; an empty
table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import cut, fresh, numbered, pieces
from starmill.llm.components import components

SHINGLE, RADIUS, SEED = 3, 3, 42
# Fingerprints of one bucket that a task compares.
BUCKET = 4096
# Words of 64 comparisons held at a time.
HELD = 1 << 18
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bits that are one in over half the hashes of the word shingles, as a signed integer."""
    words = text.encode().lower().split()  # ASCII letters and white space alone
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:n].tolist()
    ends = ends[-n:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        some = [line[a:b] for a, b in zip(starts[at : at + (1 << 14)], ends[at : at + (1 << 14)])]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, some, repeat(SEED)), ">u8", len(some))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n).view(">u8")[0].astype(np.uint64).view(np.int64))


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``key`` and its fingerprint ``fp`` (long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("key").type
            for part in pieces(batch):
                found = [fingerprint(t or "", shingle) for t in part["text"]]
                yield pa.RecordBatch.from_pydict(
                    {"key": pa.array(part["key"], kind), "fp": pa.array(found, pa.int64())}
                )

    two = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return two.mapInArrow(run, f"key {two.schema['key'].dataType.simpleString()}, fp long")


# --- buckets


def refinements(mask: int, radius: int) -> list[int]:
    """``mask`` with two more blocks of the bits it leaves free, in all ways to choose two."""
    free = [b for b in range(64) if not mask >> b & 1]
    blocks = [sum(1 << b for b in part) for part in np.array_split(free, radius + 2)]
    return [mask | a | b for a, b in combinations(blocks, 2)]


def bucketed(fps: DataFrame, level: list[tuple[int, list[int]]]) -> DataFrame:
    """``fps`` (``mask``, ``fp``) once per refinement of its mask: ``mask``, ``value``, ``fp``."""
    spark = fps.sparkSession
    signed = lambda m: int(np.uint64(m).view(np.int64))
    rows = [(signed(m), [signed(x) for x in finer]) for m, finer in level]
    finer = spark.createDataFrame(rows, "mask long, finer array<long>")  # at most 100 rows
    return fps.join(F.broadcast(finer), "mask").select(
        F.explode("finer").alias("mask"), "fp"
    ).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")


def near_links(fps: DataFrame, radius: int = RADIUS, most: int = BUCKET) -> DataFrame:
    """``a`` and ``b``: links that connect all distinct ``fp`` at most ``radius`` bits apart."""
    rows = fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    masks, links = [0], None
    while True:
        level = [(m, refinements(m, radius)) for m in masks]
        masks = sorted({x for _, finer in level for x in finer})
        buckets = bucketed(rows, level)
        last = 64 - min(m.bit_count() for m in masks) <= 16
        if not last:
            large = cut(buckets.groupBy("mask", "value").count().where(F.col("count") > most))
            last = large.isEmpty()
        if last:
            some = compared(buckets, radius)
            return links.unionAll(some) if links else some
        large = large.select("mask", "value")
        small = buckets.join(large, ["mask", "value"], "left_anti")
        some = cut(compared(small, radius))
        links = links.unionAll(some) if links else some
        rows = cut(buckets.join(large, ["mask", "value"]).select("mask", "fp").distinct())


def compared(buckets: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = (np.empty(0, np.int64),) * 3
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)]
            mask, value, fp = (np.concatenate(x) for x in zip(left, new))
            edges = np.flatnonzero((np.diff(mask) != 0) | (np.diff(value) != 0)) + 1
            # The last bucket may go on in the next batch.
            done = edges[-1] if len(edges) else 0
            left = mask[done:], value[done:], fp[done:]
            yield stars(fp[:done], edges[edges < done], radius)
        yield stars(left[2], np.empty(0, np.int64), radius)

    placed = buckets.repartition("mask", "value").sortWithinPartitions("mask", "value")
    return placed.mapInArrow(run, "a long, b long")


# --- comparison


def stars(fp: np.ndarray, edges: np.ndarray, radius: int) -> pa.RecordBatch:
    """Links from each member to the least of its group, for buckets that start at ``edges``."""
    starts = np.concatenate([[0], edges]).astype(np.int64)
    sizes = np.diff(np.concatenate([starts, [len(fp)]]))
    starts, sizes = starts[sizes > 1], sizes[sizes > 1]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    words = -(-sizes // 64)
    costs = np.cumsum(sizes * words)
    at = 0
    while at < len(sizes):
        spent = costs[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(costs, spent + HELD, "right")))
        members = [np.unique(fp[s : s + n]) for s, n in zip(starts[at:end], sizes[at:end])]
        members = [m for m in members if len(m) > 1]
        if members:
            found += linked(members, radius)
        at = end
    a = np.concatenate([x for x, _ in found]) if found else np.empty(0, np.int64)
    b = np.concatenate([x for _, x in found]) if found else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def linked(buckets: list[np.ndarray], radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per connected group of a bucket: its members but the least, and the least repeated."""
    words = np.array([-(-len(m) // 64) for m in buckets])
    first = np.concatenate([[0], np.cumsum(words)])
    sliced = planes(buckets, words)
    members = np.concatenate(buckets).view(np.uint64)
    sizes = np.array([len(m) for m in buckets])
    # Each member with each word of its own bucket.
    each = np.repeat(words, sizes)
    member = np.repeat(np.arange(len(members)), each)
    step = np.arange(len(member)) - np.repeat(np.cumsum(each) - each, each)
    word = np.repeat(np.repeat(first[:-1], sizes), each) + step
    near = within(sliced, members, member, word, radius)
    # Padding repeats a bucket's first member; it is masked off here.
    valid = np.full(first[-1], FULL)
    tail = sizes % 64
    valid[first[1:][tail > 0] - 1] = (np.uint64(1) << tail[tail > 0].astype(np.uint64)) - np.uint64(1)
    near &= valid[word]
    found, row = [], 0
    for bucket, n, w in zip(buckets, sizes.tolist(), words.tolist()):
        matrix = near[row : row + n * w].reshape(n, w)
        row += n * w
        if int(np.bitwise_count(matrix).sum()) > n:  # more than each with itself
            found += groups(bucket, matrix)
    return found


def planes(buckets: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    """Bit b of 64 members as one word: array [64, words]."""
    padded = np.concatenate(
        [np.concatenate([m, np.repeat(m[:1], w * 64 - len(m))]) for m, w in zip(buckets, words)]
    )
    as_bytes = padded.astype("<i8").view(np.uint8).reshape(-1, 64, 8)
    bits = np.unpackbits(as_bytes, axis=2, bitorder="little")  # [words, member, bit]
    packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8")[:, :, 0].astype(np.uint64)


def within(
    sliced: np.ndarray, members: np.ndarray, member: np.ndarray, word: np.ndarray, radius: int
) -> np.ndarray:
    """For each (member, word): the bits of those of the word's 64 that are near the member."""
    digits = max(1, int(radius).bit_length())
    start = (1 << digits) - 1 - radius  # so that the count overflows at radius + 1
    counter = [np.full(len(member), FULL if start >> d & 1 else np.uint64(0)) for d in range(digits)]
    over = np.zeros(len(member), np.uint64)
    near = np.zeros(len(member), np.uint64)
    active = np.arange(len(member))
    own, at = members[member], word
    for bit in range(64):
        sign = np.uint64(0) - (own >> np.uint64(bit) & np.uint64(1))
        carry = sliced[bit][at] ^ sign
        for d in range(digits):
            counter[d], carry = counter[d] ^ carry, counter[d] & carry
        over |= carry
        if bit % 8 == 7:
            keep = over != FULL
            if not keep.all():
                active, own, at, over = active[keep], own[keep], at[keep], over[keep]
                counter = [c[keep] for c in counter]
    near[active] = ~over
    return near


def groups(bucket: np.ndarray, matrix: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Connected groups of a bucket by its matrix of near members, each member opened once."""
    found, left = [], np.ones(len(bucket), bool)
    alone = np.bitwise_count(matrix).sum(axis=1) == 1
    left[alone] = False
    while left.any():
        start = int(np.argmax(left))
        group = np.zeros(len(bucket), bool)
        edge = np.array([start])
        while len(edge):
            group[edge] = True
            reached = np.bitwise_or.reduce(matrix[edge], axis=0)
            bits = np.unpackbits(reached.astype("<u8").view(np.uint8), bitorder="little")
            edge = np.flatnonzero(bits[: len(bucket)].astype(bool) & ~group)
        left &= ~group
        ids = bucket[group]  # in order, the least first
        found.append((ids[1:], np.repeat(ids[:1], len(ids) - 1)))
    return found


# --- documents


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    most: int = BUCKET,
) -> DataFrame:
    """``key``, ``fp`` (long) and ``component_id``, the least key of the connected component."""
    each = cut(fingerprints(docs, key, text, shingle))
    classes = cut(each.groupBy("fp").agg(F.min("key").alias("first")))
    roots = components(near_links(classes.select("fp"), radius, most))
    tied = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp")
    least = tied.groupBy("root").agg(F.min("first").alias("least"))
    own = tied.join(least, "root").select("fp", "least")
    ids = classes.join(own, "fp", "left").select(
        "fp", F.coalesce("least", "first").alias("component_id")
    )
    return each.join(ids, "fp").select(F.col("key").alias(key), "fp", "component_id")


def without_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """The rows and columns of ``docs``, one of each component: that of the least key, a row with
    a null key last, and of equal keys any one."""
    row = fresh(docs, "row_number")
    rows = numbered(docs, row)
    rank = F.struct(F.col(key).isNull(), F.col(key), F.col(row))
    each = rows.select(rank.alias("key"), F.col(text).alias("text"))
    found = near_duplicates(each, "key", "text", shingle, radius)
    number = found.schema["key"].dataType.names[-1]
    copies = found.where(F.col("key") != F.col("component_id"))
    return rows.join(
        copies.select(F.col("key").getField(number).alias(row)), row, "left_anti"
    ).select(*docs.columns)


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
