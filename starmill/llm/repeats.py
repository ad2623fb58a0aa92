"""Operator 13: bytes that repeat from documents with smaller ids, found by suffix arrays.

A byte goes if a string of ``LENGTH`` bytes over it also starts in a document with a smaller id.

1. Documents are packed into shards of about ``SHARD_BYTES``. Each string of LENGTH bytes (a window)
   has an anchor: of the hashes of its substrings of ``ANCHOR`` bytes the least. Equal windows have
   equal anchors, wherever they are. A shard sends each of its anchors once, with the number of its
   documents that have it; anchors of one document only can't lie in a repeat, and go.
2. Neighbouring windows with one anchor are a stretch. A shard cuts out the stretches of the anchors
   that are left, equal ones once, and Spark deals them by anchor. So all occurrences of a window
   meet, and a text costs some times its repeated part, not its square. An anchor of more than
   ``HOT`` documents, of a line that a third of all pages have, say, may have as many different
   stretches: its windows are dealt one by one instead, by their own hash.
3. A task takes the stretches of as many anchors as ``CHUNK_BYTES`` hold, builds the suffix array of
   them by induced sorting and its permuted common prefixes (``suffix_array.py``). Suffixes next to
   each other that share LENGTH bytes are one window; the least id among its stretches owns it, and
   occurrences in documents with a larger id go.
4. The spans found return to their shards, which cut them from the documents.

The anchors only deal out what is compared. What is equal is decided on the bytes by the suffix
arrays, so a clash of hashes costs work and never a byte.

Cases: a null text is empty; texts of fewer bytes than LENGTH keep all; a document with a null id
keeps all and removes nothing elsewhere; rows with one id don't remove from each other; of
identical texts the one with the smallest id stays whole; a removed span may end inside a
character, so what is kept is bytes; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import cut, freed
from starmill.llm.suffix_array import permuted_common_prefixes, suffix_array
from starmill.sources.store import LayerStore

LENGTH = 50
ANCHOR = 20
SHARD_BYTES = 2_000_000
CHUNK_BYTES = 2_000_000
HOT = 2_000
# Bytes whose hashes a task has at a time; so few stay in a core's cache.
GROUP_BYTES = 1 << 17

SHARDS = "shard long, ids binary, known binary, sizes binary, text binary"
ANCHORS = "anchor long, shard long, docs int"
STRETCHES = "deal long, shard long, stretch binary, places binary"
SPANS = "shard long, spans binary"
KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
# Where a stretch occurs: its document's id, number in the shard and place in the document.
PLACE = np.dtype([("id", np.int64), ("doc", np.int32), ("start", np.int32)])
SPAN = np.dtype([("doc", np.int32), ("start", np.int64), ("end", np.int64)])


def packed(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Documents as shards: ids, which of them are null, sizes and texts, one after the other."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    if id_type not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"doc_id is {id_type}, not an integer")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 33
        ids, texts, size = [], [], 0

        def row():
            sizes = np.array([len(t) for t in texts], np.int64)
            given = np.array([i is not None for i in ids], np.bool_)
            numbers = np.array([i or 0 for i in ids], np.int64)
            cells = shard, numbers.tobytes(), given.tobytes(), sizes.tobytes(), b"".join(texts)
            return pa.RecordBatch.from_arrays([pa.array([c]) for c in cells], names=names)

        names = ["shard", "ids", "known", "sizes", "text"]
        for batch in batches:
            text = batch.column("text")
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                ids.append(doc)
                texts.append(text[i].as_py() or b"")
                size += len(texts[-1])
                if size >= shard_bytes:
                    yield row()
                    ids, texts, size, shard = [], [], 0, shard + 1
        if ids:
            yield row()

    text = F.col("text").cast("string").cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(pack, SHARDS)


class Shard:
    """The windows of a packed row and their anchors."""

    def __init__(self, ids: bytes, known: bytes, sizes: bytes, text: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.known = np.frombuffer(known, np.bool_)
        self.sizes = np.frombuffer(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.text = np.frombuffer(text, np.uint8)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each run of windows with one anchor: anchor, document, first window, windows."""
        anchors, docs, firsts, counts = [], [], [], []
        # Documents apart in groups of some size, so that hashes take bounded memory.
        for low, high in self.groups():
            a = self.starts[low]
            b = self.starts[high - 1] + self.sizes[high - 1]
            least = window_anchors(self.text[a:b])
            room = np.maximum(self.sizes[low:high] - LENGTH + 1, 0) * self.known[low:high]
            doc = np.repeat(np.arange(low, high), room)
            if not len(doc):
                continue
            within = np.arange(len(doc)) - np.repeat(np.cumsum(room) - room, room)
            at = within + self.starts[doc] - a
            key = least[at]
            new = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))
            first = np.flatnonzero(new)
            anchors.append(key[first])
            docs.append(doc[first])
            firsts.append(within[first])
            counts.append(np.diff(np.append(first, len(doc))))
        if not anchors:
            none = np.zeros(0, np.int64)
            return none, none, none, none
        return tuple(np.concatenate(x) for x in (anchors, docs, firsts, counts))

    def groups(self) -> Iterator[tuple[int, int]]:
        low = size = 0
        for i, n in enumerate(self.sizes.tolist()):
            size += n
            if size >= GROUP_BYTES or i + 1 == len(self.sizes):
                yield low, i + 1
                low, size = i + 1, 0


def rolled(text: np.ndarray, length: int) -> np.ndarray:
    """A hash of every substring of that length, from those of substrings half as long."""
    base = 0x9E3779B97F4A7C15
    now, size = text.astype(np.uint64) + np.uint64(1), 1
    found, have = None, 0
    with np.errstate(over="ignore"):
        while True:
            if length & size:
                if found is None:
                    found, have = now, size
                else:
                    n = max(min(len(now), len(found) - size), 0)
                    shift = np.uint64(pow(base, have, 1 << 64))
                    found, have = now[:n] * shift + found[size:][:n], have + size
            if size * 2 > length:
                break
            n = max(len(now) - size, 0)
            now = now[:n] * np.uint64(pow(base, size, 1 << 64)) + now[size:][:n]
            size *= 2
        found = found ^ (found >> np.uint64(31))
        found = found * np.uint64(0xBF58476D1CE4E5B9)
        return found ^ (found >> np.uint64(29))


def window_anchors(text: np.ndarray) -> np.ndarray:
    """The least hash of ANCHOR bytes in every window of LENGTH bytes."""
    least, size, want = rolled(text, ANCHOR), 1, LENGTH - ANCHOR + 1
    while size * 2 <= want:
        least = np.minimum(least[: max(len(least) - size, 0)], least[size:])
        size *= 2
    n = max(len(least) - (want - size), 0)
    return np.minimum(least[:n], least[want - size :][:n]).view(np.int64)


def shard_rows(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            cells = [batch.column(c)[i].as_py() for c in ("ids", "known", "sizes", "text")]
            yield (batch.column("shard")[i].as_py(), Shard(*cells), *[batch.column(c)[i] for c in more])


def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, shard in shard_rows(batches):
        anchor, doc, _, _ = shard.runs()
        if not len(anchor):
            continue
        ids = shard.ids[doc]
        order = np.lexsort((ids, anchor))
        anchor, ids = anchor[order], ids[order]
        new = np.append(True, anchor[1:] != anchor[:-1])
        other = np.append(True, ids[1:] != ids[:-1]) | new
        first = np.flatnonzero(new)
        docs = np.add.reduceat(other.astype(np.int32), first)
        arrays = [anchor[first], np.full(len(first), number, np.int64), docs.astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["anchor", "shard", "docs"])


def shared_anchors(shards: DataFrame, hot_docs: int = HOT) -> DataFrame:
    """Per shard its anchors that other documents have too, and those that very many have.

    A frequent anchor has as many rows as shards here, not documents.
    """
    every = Window.partitionBy("anchor")
    rows = shards.mapInArrow(send_anchors, ANCHORS).withColumn("all", F.sum("docs").over(every))
    hot = F.col("all") > hot_docs
    return (
        rows.filter("all > 1")
        .groupBy("shard")
        .agg(
            F.collect_list(F.when(~hot, F.col("anchor"))).alias("usual"),
            F.collect_list(F.when(hot, F.col("anchor"))).alias("hot"),
        )
    )


def send_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, shard, usual, hot in shard_rows(batches, "usual", "hot"):
        anchor, doc, first, count = shard.runs()
        usual, hot = (np.sort(c.values.to_numpy(zero_copy_only=False)) for c in (usual, hot))
        in_hot = found_in(hot, anchor)
        keep = np.flatnonzero(found_in(usual, anchor))
        parts = [(anchor[keep], doc[keep], first[keep], count[keep])]
        split = np.flatnonzero(in_hot)
        # Hot anchors: every window of its own, dealt by the hash of its bytes.
        n = count[split]
        each = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        d, f = np.repeat(doc[split], n), np.repeat(first[split], n) + each
        parts.append((None, d, f, np.ones(len(d), np.int64)))
        for deal, d, f, n in parts:
            yield from stretch_rows(number, shard, deal, d, f, n)


def found_in(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def stretch_rows(number, shard, deal, doc, first, count) -> Iterator[pa.RecordBatch]:
    """Distinct stretches of a shard with the places where they occur."""
    if not len(doc):
        return
    text = shard.text.tobytes()
    at = (shard.starts[doc] + first).tolist()
    size = (count + LENGTH - 1).tolist()
    seen: dict[bytes, int] = {}
    which = np.fromiter(
        (seen.setdefault(text[a : a + n], len(seen)) for a, n in zip(at, size)), np.int64, len(at)
    )
    places = np.empty(len(doc), PLACE)
    places["id"], places["doc"], places["start"] = shard.ids[doc], doc, first
    order = np.argsort(which, kind="stable")
    places, edge = places[order], np.searchsorted(which[order], np.arange(len(seen) + 1))
    stretches = list(seen)
    if deal is None:
        # All of LENGTH bytes, one after the other.
        joined = np.frombuffer(b"".join(stretches), np.uint8).reshape(len(stretches), LENGTH)
        mixed = np.zeros(len(stretches), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(LENGTH):
                mixed = (mixed ^ joined[:, i]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
        keys = mixed.view(np.int64)
    else:
        keys = deal[order][edge[:-1]]
    for low in range(0, len(stretches), 20_000):
        part = range(low, min(low + 20_000, len(stretches)))
        here = edge[low : part.stop + 1]
        offsets = ((here - here[0]) * PLACE.itemsize).astype(np.int32)
        cells = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(places[here[0] : here[-1]].tobytes())]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys[part.start : part.stop]),
                pa.array(np.full(len(part), number, np.int64)),
                pa.array(stretches[part.start : part.stop], pa.binary()),
                pa.Array.from_buffers(pa.binary(), len(part), cells),
            ],
            names=["deal", "shard", "stretch", "places"],
        )


def find_spans(
    batches: Iterator[pa.RecordBatch], chunk_bytes: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Rows come in order of their deal; whole deals are taken until a chunk is full."""
    chunk, last = Chunk(), None
    for part in slices(batches, max(chunk_bytes // 4, 1)):
        deal = part.column("deal").to_numpy()
        if chunk.size() >= chunk_bytes and deal[-1] != last:
            n = int(np.argmax(deal != last))
            chunk.add(part.slice(0, n))
            yield judged(chunk)
            chunk, part = Chunk(), part.slice(n)
        chunk.add(part)
        last = deal[-1]
    if chunk.which:
        yield judged(chunk)


class Chunk:
    """The rows of some deals, equal stretches once."""

    def __init__(self):
        self.stretches = pa.array([], pa.binary())
        self.which, self.shard, self.places, self.n_places = [], [], [], []

    def add(self, rows: pa.RecordBatch) -> None:
        found = pa.concat_arrays([self.stretches, rows.column("stretch")]).dictionary_encode()
        self.which.append(found.indices.to_numpy()[len(self.stretches) :])
        self.stretches = found.dictionary
        places, sizes = joined(rows.column("places"))
        self.shard.append(rows.column("shard").to_numpy().copy())
        self.places.append(places.copy())
        self.n_places.append(sizes // PLACE.itemsize)

    def size(self) -> int:
        return len(joined(self.stretches)[0]) + 40 * sum(map(len, self.which))


def slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of one row at least, and about ``most`` bytes."""
    for batch in batches:
        at = np.cumsum(row_bytes(batch)) // most
        edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if a < b:
                yield batch.slice(a, b - a)


def row_bytes(rows: pa.RecordBatch) -> np.ndarray:
    return pc.binary_length(rows.column("stretch")).to_numpy().astype(np.int64) + 40


def joined(cells: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all cells, one after the other, and the length of each."""
    if not len(cells):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    _, offsets, data = cells.buffers()
    offsets = np.frombuffer(offsets, np.int32)[cells.offset :][: len(cells) + 1]
    lengths = np.diff(offsets).astype(np.int64)
    return np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]], lengths


def judged(chunk: Chunk) -> pa.RecordBatch:
    """The spans to remove, by the suffix array of the stretches, per shard."""
    n_places = np.concatenate(chunk.n_places)
    places = np.concatenate(chunk.places).view(PLACE)
    which = np.repeat(np.concatenate(chunk.which).astype(np.int64), n_places)
    shard = np.repeat(np.concatenate(chunk.shard), n_places)

    stretches, sizes = joined(chunk.stretches)
    # Every stretch ends in a mark, 1, the whole in 0; bytes are 2 to 257.
    text = np.ones(sizes.sum() + len(sizes) + 1, np.uint16)
    starts = np.cumsum(sizes + 1) - sizes - 1
    body = np.ones(len(text), bool)
    body[starts + sizes] = False
    body[-1] = False
    text[-1] = 0
    text[body] = stretches.astype(np.uint16) + 2

    order = suffix_array(text)
    windows = sizes - LENGTH + 1
    stretch = np.repeat(np.arange(len(sizes)), windows)
    within = np.arange(len(stretch)) - np.repeat(np.cumsum(windows) - windows, windows)
    number = np.full(len(text), -1, np.int64)
    number[starts[stretch] + within] = np.arange(len(stretch))
    # Suffixes that share LENGTH bytes with the one before are the same window.
    common = permuted_common_prefixes(text, order, LENGTH, number >= 0)
    same = np.cumsum(common[order] < LENGTH) - 1
    ranked = number[order]
    is_window = ranked >= 0
    group = np.empty(len(stretch), np.int64)
    group[ranked[is_window]] = same[is_window]

    first_id = np.full(len(sizes), np.iinfo(np.int64).max)
    np.minimum.at(first_id, which, places["id"])
    owner = np.full(same[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(owner, group, first_id[stretch])

    # Windows of every place of a stretch, and those that a smaller id owns.
    n = windows[which]
    place = np.repeat(np.arange(len(which)), n)
    at = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
    first_window = np.cumsum(windows) - windows
    gone = owner[group[first_window[which[place]] + at]] < places["id"][place]
    place, at = place[gone], at[gone]
    if not len(place):
        return spans_by_shard(np.zeros(0, np.int64), np.zeros(0, SPAN))
    new = np.append(True, (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1))
    a = np.flatnonzero(new)
    z = np.append(a[1:], len(place)) - 1
    spans = np.empty(len(a), SPAN)
    of = place[a]
    spans["doc"] = places["doc"][of]
    spans["start"] = places["start"][of] + at[a]
    spans["end"] = places["start"][of] + at[z] + LENGTH
    return spans_by_shard(shard[of], spans)


def spans_by_shard(shard: np.ndarray, spans: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(shard, kind="stable")
    shard, spans = shard[order], spans[order]
    first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
    edges = [*first, len(shard)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(shard[edges[:-1]] if len(shard) else [], pa.int64()),
            pa.array([spans[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
        ],
        names=["shard", "spans"],
    )


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans that overlap or touch as one, per document."""
    spans = np.sort(spans, order=["doc", "start"])
    if not len(spans):
        return spans
    base = spans["doc"].astype(np.int64) << 40
    reach = np.maximum.accumulate(base + spans["end"])
    new = np.append(True, base[1:] + spans["start"][1:] > reach[:-1])
    first = np.flatnonzero(new)
    found = spans[first]
    found["end"] = (reach - base)[np.append(first[1:], len(spans)) - 1]
    return found


def repeated(
    docs: DataFrame,
    shard_bytes: int = SHARD_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    hot_docs: int = HOT,
) -> DataFrame:
    """Packed documents with the spans to remove, in pieces, as found. The sizes change no result."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Texts are dealt to buckets by their shard once; what is found out of them goes back there.
    store = LayerStore(spark, f"starmill_repeats_{uuid.uuid4().hex}", parts)
    store.drop_at_exit()
    shards = store.write(packed(docs, shard_bytes), "shards", "shard")
    freed(spark)
    anchors = cut(shared_anchors(shards, hot_docs))
    freed(spark)
    stretches = shards.join(anchors.hint("merge"), "shard").mapInArrow(send_stretches, STRETCHES)
    dealt = stretches.repartition(parts, "deal").sortWithinPartitions("deal")
    spans = cut(dealt.mapInArrow(partial(find_spans, chunk_bytes=chunk_bytes), SPANS))
    freed(spark)
    per_shard = spans.groupBy("shard").agg(F.collect_list("spans").alias("spans"))
    return shards.join(per_shard.hint("merge"), "shard", "left")


def cut_out(rows: DataFrame, kept: str, schema: str) -> DataFrame:
    """Per document its sizes and what is left of it, as ``kept`` makes of the bytes."""
    digest = kept == "kept_sha256"

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, shard, found in shard_rows(batches, "spans"):
            spans = np.frombuffer(b"".join(found.as_py() or []), SPAN)
            spans = merged(spans)
            edge = np.searchsorted(spans["doc"], np.arange(len(shard.ids) + 1))
            text, out = shard.text.tobytes(), []
            for i, doc in enumerate(shard.ids.tolist()):
                start, size = int(shard.starts[i]), int(shard.sizes[i])
                mine = spans[edge[i] : edge[i + 1]]
                left, at = [], 0
                for a, b in zip(mine["start"].tolist(), mine["end"].tolist()):
                    left.append(text[start + at : start + a])
                    at = b
                left.append(text[start + at : start + size])
                body = b"".join(left)
                out.append((doc if shard.known[i] else None, size, size - len(body), len(mine),
                            hashlib.sha256(body).hexdigest() if digest else body))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", kept]
            kinds = [pa.int64()] * 4 + [pa.string() if digest else pa.binary()]
            columns = zip(*out)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(documents, schema)


def without_repeats(docs: DataFrame, **sizes: int) -> DataFrame:
    """Per document its sizes and the bytes that are left."""
    return cut_out(repeated(docs, **sizes), "kept", KEPT)


def repeat_digests(docs: DataFrame, **sizes: int) -> DataFrame:
    """Per document its sizes and the SHA-256 of the bytes that are left."""
    return cut_out(repeated(docs, **sizes), "kept_sha256", DIGESTS)
