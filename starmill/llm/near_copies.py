"""Near copies at a similarity, by wide SimHash fingerprints: for stages that need more than the
few bits of :mod:`starmill.llm.simhash`.

At a Jaccard similarity of 0.8 two documents differ in some 15 % of the bits of their SimHash
fingerprints, too many to agree in blocks of bits. So buckets come from the shingles instead, and
bits only compare:

1. A document's fingerprint has 256 bits, over the set of its shingles of five words. Its shingles
   also give ``BANDS`` keys, each of the least hashes under ``ROWS`` functions. Documents with a
   similarity of 0.8 share one of the keys with a probability of 0.99.
2. Documents with one fingerprint are one class. Classes that share a key are compared bit-sliced:
   64 fingerprints a word, one word a bit, distances counted by carry-save counters, blocks of 64
   left out once all are beyond the radius. Stars of links become components by Spark joins.
3. Buckets of more than ``BUCKET`` classes are cut into blocks of half as many, and tasks compare
   two blocks at a time: first one block with all, then whatever that left out of the bucket's
   largest component with the whole bucket. So every two classes that share a key are compared or
   tied already, however large the bucket; the work is the square of what isn't alike.

The fingerprints decide: a pair that shares a key counts as near within ``RADIUS`` bits, which tells similarities of
0.8 from those below 0.65 or so with few errors; README gives recall and precision.

Cases: texts without words (null and empty ones too) are one class; fewer words than a shingle give
one shingle of them all; rows with equal or null keys are rows; an empty table gives an empty one;
other columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import cut, freed, fresh, numbered, pieces, returning
from starmill.llm.components import components
from starmill.llm.simhash import FULL, HELD, groups

SHINGLE, RADIUS = 5, 40
BITS = 256
BANDS, ROWS = 12, 5
BUCKET = 4096
# Shingles whose bits a task holds unpacked at a time.
STEP = 1 << 12


def salts(*numbers: int) -> np.ndarray:
    return np.array([(n + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF for n in numbers], np.uint64)


WIDE, LEAST = salts(*range(100, 100 + BITS // 64)), salts(*range(BANDS * ROWS))


def mixed(x: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Another hash of every hash, per salt."""
    with np.errstate(over="ignore"):
        x = x + salt
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the word shingles."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[:n].tolist(), ends[-n:].tolist()
    found = (xxhash.xxh64_intdigest(line[a:b]) for a, b in zip(starts, ends))
    return np.unique(np.fromiter(found, np.uint64, n))


def sketch(hashes: np.ndarray) -> tuple[bytes, list[int]]:
    """The fingerprint of a set of shingles, and its keys."""
    if not len(hashes):
        return bytes(BITS // 8), [0] * BANDS
    ones, least = np.zeros(BITS, np.int64), np.full(BANDS * ROWS, FULL)
    for at in range(0, len(hashes), STEP):
        part = hashes[at : at + STEP]
        least = np.minimum(least, mixed(part[None, :], LEAST[:, None]).min(axis=1))
        wide = mixed(part[:, None], WIDE[None, :])
        bits = np.unpackbits(wide.view(np.uint8).reshape(len(part), BITS // 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    print_ = np.packbits(2 * ones > len(hashes)).tobytes()
    keys = np.arange(BANDS, dtype=np.uint64)  # so that no two bands share a key
    for column in least.reshape(BANDS, ROWS).T:
        keys = mixed(keys ^ column, LEAST[0])
    return print_, keys.view(np.int64).tolist()


def sketches(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """``key`` (long), ``fp`` (binary) and ``bands`` of every document."""

    @returning
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                found = [sketch(shingles(t or "", shingle)) for t in part["text"]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(part["key"], pa.int64()),
                        "fp": pa.array([f for f, _ in found], pa.binary()),
                        "bands": pa.array([b for _, b in found], pa.list_(pa.int64())),
                    }
                )

    two = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return two.mapInArrow(run, "key long, fp binary, bands array<long>")


def near_links(classes: DataFrame, radius: int, most: int) -> DataFrame:
    """``a`` and ``b``: links that connect the near ones of ``classes`` (first, fp, bands)."""
    bucket = F.explode(F.array_distinct("bands")).alias("bucket")
    buckets = classes.select(bucket, "first", "fp")
    large = cut(buckets.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > most))
    small = buckets.join(large.select("bucket"), "bucket", "left_anti")
    links = cut(compared(small, radius))
    if large.isEmpty():
        return links
    # Large buckets go in blocks, two of which a task compares at a time. The first block meets all
    # others, which ties most of what is alike.
    each = max(1, most // 2)
    members = cut(buckets.join(large, "bucket").withColumn("place", F.xxhash64("first", "bucket")))
    blocks = F.ceil(F.col("n") / each)
    block = F.pmod("place", blocks)
    first = members.select("bucket", "first", "fp", block.alias("block"), blocks.alias("blocks"))
    first = first.withColumn("open", F.when(F.col("block") == 0, 1).otherwise(0))
    tied = cut(compared(tiles(first.withColumn("opens", F.lit(1))), radius))
    links = links.unionAll(tied)
    # Members already tied to each other need no look. Of each bucket the largest component is left
    # as it is, and every member out of it meets all of the bucket.
    roots = cut(components(links))
    of = members.join(roots.withColumnRenamed("node", "first"), "first", "left")
    of = cut(of.withColumn("root", F.coalesce("root", "first")))
    sizes = of.groupBy("bucket", "root").agg(F.count("*").alias("members"))
    main = sizes.groupBy("bucket").agg(
        F.max(F.struct("members", "root")).alias("main"), F.sum("members").alias("n")
    )
    main = main.select(
        "bucket",
        F.col("main.root").alias("main"),
        F.ceil((F.col("n") - F.col("main.members")) / each).alias("opens"),
        F.ceil(F.col("main.members") / each).alias("rest"),
    ).where("opens > 0")
    of = of.drop("n").join(main, "bucket")
    is_open = F.col("root") != F.col("main")
    block = F.when(is_open, F.pmod("place", "opens")).otherwise(
        F.col("opens") + F.pmod("place", "rest")
    )
    rest = of.select(
        "bucket",
        "first",
        "fp",
        block.alias("block"),
        (F.col("opens") + F.col("rest")).alias("blocks"),
        is_open.cast("int").alias("open"),
        "opens",
    )
    return links.unionAll(cut(compared(tiles(rest), radius)))


def tiles(members: DataFrame) -> DataFrame:
    """Members of buckets in ``blocks`` blocks, of which the first ``opens`` are open, once per tile
    of two blocks with an open one: ``bucket``, ``first``, ``fp``."""
    other = F.sequence(
        F.lit(0).cast("long"), F.when(F.col("open") == 1, F.col("blocks")).otherwise(F.col("opens")) - 1
    )
    tile = F.transform(
        other, lambda o: F.xxhash64("bucket", F.least("block", o), F.greatest("block", o))
    )
    return members.select(F.explode(tile).alias("bucket"), "first", "fp")


def compared(buckets: DataFrame, radius: int) -> DataFrame:
    """Stars of near classes, bucket by bucket."""

    @returning
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, BITS // 64), np.uint64))
        for batch in batches:
            bucket, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(2))
            fp = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64).reshape(-1, BITS // 64)
            bucket, first, fp = (np.concatenate(x) for x in zip(left, (bucket, first, fp)))
            edges = np.flatnonzero(np.diff(bucket) != 0) + 1
            done = edges[-1] if len(edges) else 0  # the last bucket may go on
            left = bucket[done:], first[done:], fp[done:]
            yield stars(first[:done], fp[:done], edges[edges < done], radius)
        yield stars(left[1], left[2], np.empty(0, np.int64), radius)

    placed = buckets.select("bucket", "first", "fp").repartition("bucket")
    return placed.sortWithinPartitions("bucket", "first").mapInArrow(run, "a long, b long")


def stars(first: np.ndarray, fp: np.ndarray, edges: np.ndarray, radius: int) -> pa.RecordBatch:
    starts = np.concatenate([[0], edges]).astype(np.int64)
    sizes = np.diff(np.append(starts, len(first)))
    starts, sizes = starts[sizes > 1], sizes[sizes > 1]
    found, at = [], 0
    # A word's 64 fingerprints are unpacked to bits, however few of them its bucket has.
    costs = np.cumsum(-(-sizes // 64) * np.maximum(sizes, 32))
    while at < len(sizes):
        spent = costs[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(costs, spent + HELD // 4, "right")))
        found += linked(first, fp, starts[at:end], sizes[at:end], radius)
        at = end
    a = np.concatenate([x for x, _ in found]) if found else np.empty(0, np.int64)
    b = np.concatenate([x for _, x in found]) if found else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def linked(first, fp, starts, sizes, radius) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per connected group of a bucket: its members but the least, and the least repeated."""
    words = -(-sizes // 64)
    edge = np.append(0, np.cumsum(words))
    # Each bucket padded with its first member to whole words.
    padded = np.concatenate(
        [np.append(np.arange(s, s + n), np.full(w * 64 - n, s)) for s, n, w in zip(starts, sizes, words)]
    )
    bits = np.unpackbits(fp[padded].view(np.uint8).reshape(-1, 64, BITS // 8), axis=2, bitorder="little")
    planes = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    planes = np.ascontiguousarray(planes).view("<u8")[:, :, 0].astype(np.uint64)

    own = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, sizes)])
    each = np.repeat(words, sizes)
    member = np.repeat(own, each)
    step = np.arange(len(member)) - np.repeat(np.cumsum(each) - each, each)
    word = np.repeat(np.repeat(edge[:-1], sizes), each) + step
    near = within(planes, fp, member, word, radius)
    valid = np.full(edge[-1], FULL)
    tail = sizes % 64
    valid[edge[1:][tail > 0] - 1] = (np.uint64(1) << tail[tail > 0].astype(np.uint64)) - np.uint64(1)
    near &= valid[word]
    found, row = [], 0
    for s, n, w in zip(starts.tolist(), sizes.tolist(), words.tolist()):
        matrix = near[row : row + n * w].reshape(n, w)
        row += n * w
        if int(np.bitwise_count(matrix).sum()) > n:  # more than each with itself
            found += groups(first[s : s + n], matrix)
    return found


def within(planes, fp, member, word, radius) -> np.ndarray:
    """For each (member, word): the bits of those of the word's 64 that are near the member."""
    digits = int(radius).bit_length()
    start = (1 << digits) - 1 - radius  # so that the count overflows at radius + 1
    counter = [np.full(len(member), FULL if start >> d & 1 else np.uint64(0)) for d in range(digits)]
    over = np.zeros(len(member), np.uint64)
    near = np.zeros(len(member), np.uint64)
    active, own, at = np.arange(len(member)), member, word
    for bit in range(BITS):
        sign = np.uint64(0) - (fp[own, bit >> 6] >> np.uint64(bit & 63) & np.uint64(1))
        carry = planes[bit][at] ^ sign
        for d in range(digits):
            counter[d], carry = counter[d] ^ carry, counter[d] & carry
        over |= carry
        if bit % 32 == 31:
            keep = over != FULL
            if not keep.all():
                active, own, at, over = active[keep], own[keep], at[keep], over[keep]
                counter = [c[keep] for c in counter]
    near[active] = ~over
    return near


def near_copies(
    docs: DataFrame,
    key: str,
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    most: int = BUCKET,
) -> DataFrame:
    """``key`` (long, unique) and ``component_id``, the least key of its near copies' component."""
    each = cut(sketches(docs, key, text, shingle))
    # Of one fingerprint any one's bands will do; those of the least key are the same on every run.
    classes = cut(
        each.groupBy("fp").agg(F.min(F.struct("key", "bands")).alias("least")).select(
            "fp", F.col("least.key").alias("first"), F.col("least.bands").alias("bands")
        )
    )
    roots = components(near_links(classes, radius, most))
    ids = classes.join(roots.select(F.col("node").alias("first"), "root"), "first", "left").select(
        "fp", "first", F.coalesce("root", "first").alias("component_id")
    )
    ids = cut(ids)
    freed(docs.sparkSession)
    # Most documents are alone with their fingerprint; only others look for their class.
    alone = ids.select(F.col("first").alias("key"), "component_id")
    known = each.select("key", "fp").join(alone, "key", "left")
    own = known.where("component_id is not null").select("key", "component_id")
    rest = known.where("component_id is null").select("key", "fp")
    return own.unionAll(rest.join(ids.select("fp", "component_id"), "fp").select("key", "component_id"))


def without_near_copies(
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
    found = cut(near_copies(rows, row, text, shingle, radius))
    by_key = F.struct(F.col(f"`{key}`").isNull(), F.col(f"`{key}`"), F.col(row))
    groups_ = found.groupBy("component_id").count().where("count > 1").select("component_id")
    tied = found.join(groups_, "component_id").withColumnRenamed("key", row)
    ranked = rows.select(row, by_key.alias("rank")).join(tied, row)
    kept = ranked.groupBy("component_id").agg(F.min("rank").alias("rank"))
    number = ranked.schema["rank"].dataType.names[-1]
    kept = kept.select(F.col("rank").getField(number).alias(row))
    gone = cut(tied.select(row).join(kept, row, "left_anti"))
    freed(docs.sparkSession)
    return rows.join(gone, row, "left_anti").drop(row)
