"""Operator 6: personal data by patterns and a skip-chain conditional random field.

Patterns give the plain spans, which always stay. The field labels what the patterns miss: its
nodes are the tokens (between ASCII white space) that hold a digit or ``@``, all others are fixed
as no entity. A node's own potential comes from its shape, its length, its neighbours' shapes and
the two words before it. Neighbouring nodes share a chain potential; a node and the next similar
token of the document, however far, share a skip potential, so an entity has one label throughout.
Similar are tokens that are equal but for case and marks around them, that have the same five or
more digits in a row, whatever stands between these, or that have the same part before an ``@``.
Loopy message passing over both gives each node's probabilities; the number of rounds is fixed, so
a document's result does not depend on the others it is worked on with.

Learning is piecewise: node weights by logistic regression, edge potentials from how often labels
meet, on the plain spans of ``sample`` documents at most, those whose key and text hash lowest and
that are not longer than ``LONGEST`` characters. Each document is learned from twice, as it is and
with its telephone numbers written without a plus, so that words and shapes around count beside
the pattern. The sample bounds what meets on the driver; finding reads every document whole.

What the field adds must be able to be what it is called (``plausible``): a card has 13 to 19
digits and a right check digit, an address four numbers up to 255, a telephone number 7 to 15
digits and something between them or a known prefix, a mail address an ``@`` between two texts. So
an ordinary number isn't taken for a card by its shape.

Each ``@`` and run of digits is looked at once, so long texts take linear time, and each occurrence
is tied to the next alone, never to all others.

Cases: null texts count as empty and have no spans; equal rows, or rows with equal or null keys,
are worked on one by one; without anything to learn from only plain spans are found; an empty
table gives an empty one.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import lowest, pieces, plainly_named, returning

KINDS = ("email", "ip", "card", "phone")
# What the plain spans look like.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

MARK = re.compile(r"[0-9@][^ \t\n\x0b\x0c\r]*")
BLANK = " \t\n\x0b\x0c\r"
FEATURES, PER_TOKEN = 1 << 14, 10
# Digits from which on tokens with the same ones are similar.
SAME_DIGITS = 5
SAMPLE, LONGEST, ROUNDS, SURE = 20_000, 100_000, 8, 0.5

Span = tuple[str, int, int]


# --- plain spans


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """In the order of ``KINDS``, then of their starts."""
    found: list[Span] = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def joined(spans: list[Span]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in order)


# --- nodes and edges


class Graph:
    """Tokens of a document that may be entities (start, end), their features, and their edges:
    pairs of neighbours, and pairs of a token and the next one similar to it."""

    def __init__(self, text: str):
        self.spans: list[tuple[int, int]] = []
        done = 0
        for m in MARK.finditer(text):
            start = m.start()
            while start > done and text[start - 1] not in BLANK:
                start -= 1
            self.spans.append((start, m.end()))
            done = m.end()
        tokens = [text[a:b] for a, b in self.spans]
        shapes = [shape(t) for t in tokens]
        near = [
            b[0] - a[1] <= 2 and text[a[1] : b[0]].strip(BLANK) == ""
            for a, b in zip(self.spans, self.spans[1:])
        ]
        self.chain = [(i, i + 1) for i, close in enumerate(near) if close]
        last: dict[tuple[str, str], int] = {}
        pairs: dict[tuple[int, int], None] = {}
        for i, token in enumerate(tokens):
            for alike in similar(token):
                if alike in last:
                    pairs[last[alike], i] = None
                last[alike] = i
        self.skip = list(pairs)
        words = [words_before(text, a) for a, _ in self.spans]
        before = ["", *[s if close else "" for s, close in zip(shapes, near)]]
        after = [*[s if close else "" for s, close in zip(shapes[1:], near)], ""]
        self.features = [
            [
                feature("shape", s),
                feature("digits", min(sum(map(str.isdigit, t)), 20)),
                feature("length", min(len(t), 40)),
                feature("dots", min(t.count("."), 6)),
                feature("signs", "".join(c for c in "@+(-=/#" if c in t)),
                feature("before", b),
                feature("after", a),
                feature("around", f"{b} {s} {a}"),
                feature("word", w[-1]),
                feature("word before", w[-2]),
            ]
            for t, s, b, a, w in zip(tokens, shapes, before, after, words)
        ]

    def labels(self, spans: list[Span]) -> list[int]:
        """Per token 0, or one more than the kind of the last kind whose span it shares
        characters with."""
        found = [0] * len(self.spans)
        ends = [end for _, end in self.spans]
        for kind, start, end in spans:
            i = bisect_right(ends, start)
            while i < len(ends) and self.spans[i][0] < end:
                found[i] = KINDS.index(kind) + 1
                i += 1
        return found


def similar(token: str) -> list[tuple[str, str]]:
    """What a token has in common with those it is tied to."""
    bare = token.strip(".,;:!?\"'()").lower()
    found = [("token", bare)]
    digits = "".join(c for c in bare if c.isdigit())
    if len(digits) >= SAME_DIGITS:
        found.append(("digits", digits))
    name, at, _ = bare.partition("@")
    if at and name:
        found.append(("name", name))
    return found


def words_before(text: str, at: int) -> tuple[str, str]:
    """The two words of letters before a place, as far as they lie within 48 characters."""
    found = re.findall(r"[^\W\d_]+", text[max(0, at - 48) : at].lower())[-2:]
    return ("", "", *found)[-2:]


def plausible(kind: str, found: str) -> bool:
    """Whether an added span can be what it is called."""
    digits = "".join(c for c in found if c in "0123456789")
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "ip":
        parts = found.split(".")
        return len(parts) == 4 and all(p.isdigit() and int(p[-4:]) <= 255 for p in parts)
    if kind == "phone":
        return 7 <= len(digits) <= 15 and any(c in found for c in "+-.() /")
    name, at, rest = found.partition("@")
    return bool(at and name and rest)


def without_plus(text: str) -> tuple[str, list[Span]]:
    """``text`` with its telephone numbers written without the plus, and where all spans are."""
    spans = plain_spans(text)
    gone = sorted(start for kind, start, _ in spans if kind == "phone")
    moved = [
        (kind, start - bisect_left(gone, start), end - bisect_left(gone, end)) for kind, start, end in spans
    ]
    parts, at = [], 0
    for start in gone:
        parts.append(text[at:start])
        at = start + 1
    return "".join([*parts, text[at:]]), moved


def shape(token: str) -> str:
    """Runs of digits as 9, of letters as a, other characters as they are; runs up to four."""
    kinds = "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in token)
    return re.sub(r"(.)\1{4,}", r"\1\1\1\1", kinds, flags=re.DOTALL)


def feature(name: str, value) -> int:
    return zlib.crc32(f"{name}={value}".encode()) % FEATURES


# --- the field


class Field:
    """Node weights [features, labels] and log potentials of both kinds of edges."""

    def __init__(self, weights: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.weights, self.edges = weights, (chain, skip)

    def probabilities(self, graphs: list[Graph]) -> np.ndarray:
        """Of the labels of all tokens of the graphs, [tokens, labels]."""
        features = [f for g in graphs for f in g.features]
        own = self.weights[np.array(features, np.int64)].sum(axis=1)
        ends, pair, first = [], [], 0
        for g in graphs:
            for kind, edges in enumerate((g.chain, g.skip)):
                ends += [(first + a, first + b) for a, b in edges]
                pair += [kind] * len(edges)
            first += len(g.features)
        if not ends:
            return softmax(own)
        ends = np.array(ends)
        potentials = np.stack(self.edges)[np.array(pair)]
        # Both directions: from, to, potential [edge, label of from, label of to].
        start = np.concatenate([ends[:, 0], ends[:, 1]])
        end = np.concatenate([ends[:, 1], ends[:, 0]])
        table = np.concatenate([potentials, potentials.transpose(0, 2, 1)])
        back = np.roll(np.arange(len(start)), len(ends))
        messages = np.zeros((len(start), own.shape[1]))
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, end, messages)
            rest = belief[start] - messages[back]
            new = np.logaddexp.reduce(rest[:, :, None] + table, axis=1)
            messages = 0.5 * messages + 0.5 * (new - np.logaddexp.reduce(new, axis=1)[:, None])
        belief = own.copy()
        np.add.at(belief, end, messages)
        return softmax(belief)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def examples(texts: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Of a sample of ``texts`` (``key``, ``text``), ``sample`` rows at most: the labels of a
    document's nodes by its plain spans, their features, and the labels that meet."""

    @returning
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                rows = []
                for text, rank in zip(part["text"], part["rank"]):
                    labels, features, meet = [], [], []
                    for text, spans in {text: plain_spans(text), **dict([without_plus(text)])}.items():
                        graph = Graph(text)
                        own = graph.labels(spans)
                        labels += own
                        features += [x for f in graph.features for x in f]
                        meet += [
                            kind * 25 + own[a] * 5 + own[b]
                            for kind, edges in enumerate((graph.chain, graph.skip))
                            for a, b in edges
                        ]
                    if labels:
                        rows.append((labels, features, meet, rank))
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array([r[i] for r in rows], kind) for i in range(3)],
                        pa.array([r[3] for r in rows], pa.int64()),
                    ],
                    names=["labels", "features", "meet", "rank"],
                )

    number = texts.count()
    share = min(1.0, sample / max(1, number))
    # Of key and text, as many rows may have one key, or none.
    rank = F.xxhash64("key", "text")
    drawn = texts.select("text", rank.alias("rank")).where(
        (F.pmod("rank", F.lit(1_000_003)) < share * 1_000_003) & (F.length("text") <= LONGEST)
    )
    schema = "labels array<long>, features array<long>, meet array<long>, rank long"
    return lowest(drawn.mapInArrow(run, schema), "rank", sample)


def learn(texts: DataFrame, sample: int = SAMPLE) -> Field:
    """A field from the plain spans of a sample of ``texts`` (``key``, ``text``)."""
    rows = examples(texts, sample).collect()
    size = len(KINDS) + 1
    labels = np.array([x for r in rows for x in r["labels"]], np.int64)
    features = np.array([x for r in rows for x in r["features"]], np.int64)
    meet = np.array([x for r in rows for x in r["meet"]], np.int64)
    weights = regression(features.reshape(-1, PER_TOKEN), labels, size)
    tables = np.bincount(meet, minlength=2 * size * size).reshape(2, size, size) + 0.5
    tables = tables + tables.transpose(0, 2, 1)
    single = tables.sum(axis=2) / tables.sum(axis=(1, 2))[:, None]
    both = tables / tables.sum(axis=(1, 2))[:, None, None]
    edges = np.log(both / (single[:, :, None] * single[:, None, :]))
    return Field(weights, *edges)


def regression(features: np.ndarray, labels: np.ndarray, size: int) -> np.ndarray:
    """Weights [features, labels] by gradient steps over all tokens; a token's label is
    outnumbered by no prior but the data's. Without tokens all weight is on no entity."""
    weights = np.zeros((FEATURES, size))
    if not len(labels):
        weights[:, 0] = 1.0
        return weights
    wanted, seen = np.eye(size)[labels], np.full(FEATURES, 1e-9)
    for _ in range(150):
        error = wanted - softmax(weights[features].sum(axis=1))
        step = np.zeros_like(weights)
        for column in features.T:
            np.add.at(step, column, error)
        step = step - 0.1 * weights
        seen += (step**2).sum(axis=1)
        weights += 0.5 * step / np.sqrt(seen)[:, None]
    return weights


# --- documents


def all_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Per text its plain spans and those the field adds, apart from each other."""
    plain, graphs = [plain_spans(t) for t in texts], [Graph(t) for t in texts]
    if not any(g.spans for g in graphs):
        return [(p, []) for p in plain]
    chances = field.probabilities([g for g in graphs if g.spans])
    found, row = [], 0
    for text, spans, graph in zip(texts, plain, graphs):
        added: list[Span] = []
        mine = chances[row : row + len(graph.spans)]
        row += len(graph.spans)
        covered = graph.labels(spans) if graph.spans else []
        close = {b for _, b in graph.chain}
        previous = None
        for i, (a, b) in enumerate(graph.spans):
            label = int(mine[i].argmax())
            if label and not covered[i] and mine[i][label] > SURE:
                start, end = trimmed(text, a, b)
                if previous == label and i in close and added:
                    added[-1] = (KINDS[label - 1], added[-1][1], end)
                else:
                    added.append((KINDS[label - 1], start, end))
                previous = label
            else:
                previous = None
        found.append((spans, [s for s in added if plausible(s[0], text[s[1] : s[2]])]))
    return found


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A token without the marks around it."""
    own = lambda c: c.isalnum()
    while start < end and not (own(text[start]) or text[start] in "+("):
        start += 1
    while start < end and not own(text[end - 1]):
        end -= 1
    return start, end


def per_document(field: Field, make: Callable, schema: str) -> Callable:
    """A function for ``mapInArrow`` over ``key`` and ``text`` that adds ``make(text, plain,
    added)`` of each row as columns."""
    names = [part.split()[0] for part in schema.split(", ")]

    @returning
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("key").type
            for part in pieces(batch):
                texts = [t or "" for t in part["text"]]
                rows = [make(t, *s) for t, s in zip(texts, all_spans(texts, field))]
                yield pa.RecordBatch.from_pydict(
                    {"key": pa.array(part["key"], kind)}
                    | {name: [r[i] for r in rows] for i, name in enumerate(names)}
                )

    return run


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its key, ``plain`` and ``spans``: plain spans, and all, as
    ``kind:start:end`` by kind, then start, joined by commas; code points, ends exclusive."""
    texts = keyed(docs, key, text)
    field = learn(texts)
    kind = texts.schema["key"].dataType.simpleString()
    schema = "plain string, spans string"
    make = lambda text, plain, added: (joined(plain), joined(plain + added))
    return texts.mapInArrow(per_document(field, make, schema), f"key {kind}, {schema}").select(
        F.col("key").alias(key), "plain", "spans"
    )


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with its spans replaced by their kinds; spans that overlap become one."""
    merged: list[list] = []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], s[2])):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    parts, at = [], 0
    for kind, start, end in merged:
        parts += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with its columns, the spans in ``text`` replaced by their kinds; null stays."""
    columns, docs = docs.columns, plainly_named(docs)
    field = learn(keyed(docs, key, text))
    names = docs.columns

    @returning
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                texts = part[text]
                spans = all_spans([t or "" for t in texts], field)
                part[text] = [
                    None if t is None else redacted(t, plain + added)
                    for t, (plain, added) in zip(texts, spans)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[n], batch.schema.field(n).type) for n in names],
                    names=names,
                )

    return docs.mapInArrow(run, docs.schema).toDF(*columns)
