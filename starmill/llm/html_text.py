"""Operator 7: main text of web pages by a recurrent labeller of blocks.

A page is read into blocks: text between tags that end a line, with the tags it lies in. A block
becomes a vector: the mean of its words' hashed vectors, the mean of its tag path's, that of its
innermost tag, and a few numbers. A bidirectional LSTM in numpy reads a page's blocks in both
directions and labels each one with all others as context.

It is trained here, on blocks of ``sample`` pages at most, whose key, URL and html hash lowest and
that are not longer than ``LONGEST`` characters: pages that say by their tags which part is the
article teach what articles and their surroundings look like. Every second of them is learned from
with some runs of its article's blocks put into surroundings (comments, notices, menus, ...), as
these also lie inside articles. In training some pages lose their tag vectors, so words, lengths
and neighbours count as well. The sample bounds what meets on the driver; extraction reads every
page whole. What a browser doesn't show as text (``HIDDEN``) is never main text.

Cases: null or empty pages and pages without a main block give an empty text; broken markup is
read as far as it goes (a tag that never ends hides what follows; what isn't closed is closed by
the end); equal rows, or rows with equal or null keys, are read one by one; without pages to learn
from every block outside ``HIDDEN`` is main text; an empty table gives an empty one; other columns
are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import lowest, pieces

# How tags behave, and which names tell what a part of a page is.
RAW = frozenset("script style textarea title noscript template svg iframe".split())
HIDDEN = frozenset("script style noscript template svg iframe head title textarea".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
MAIN = frozenset("article main".split())
AROUND = frozenset("nav header footer aside form menu dialog".split()) | HIDDEN
HINTS = frozenset(
    "ad ads advert advertisement banner comment comments cookie footer header menu nav notice "
    "popup promo related share sidebar social sponsor subscribe".split()
)
# Tags that a new one of their kind ends.
CLOSES = {"p": "p", "li": "li", "tr": "tr", "td": "td", "th": "th", "option": "option"}

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
WORDS, TAGS = 1 << 12, 1 << 12
WIDTH, HIDDEN_SIZE = 16, 16
SAMPLE, EPOCHS, SEED = 400, 30, 7
# Characters of a page that can be learned from.
LONGEST = 200_000
# Blocks of pages labelled together.
HELD = 1 << 15


class Block:
    """Text between two ends of lines, its tags from the outside in, its characters in links."""

    def __init__(self, path: tuple[str, ...], text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked

    def hidden(self) -> bool:
        return any(t.split(".")[0] in HIDDEN for t in self.path)


def tag_end(html: str, start: int) -> int:
    """Place of the ``>`` that ends the tag at ``start``, or -1: not one inside quotes."""
    end = html.find(">", start)
    if end < 0 or "=" not in html[start:end]:
        return end
    at, quote = start, None
    while True:
        for i in range(at, end):
            c = html[i]
            if quote is None and c in "\"'" and html[i - 1] in "= \t\n":
                quote = c
            elif c == quote:
                quote = None
        if quote is None:
            return end
        close = html.find(quote, end)
        if close < 0:
            return end
        at, end, quote = close + 1, html.find(">", close), None
        if end < 0:
            return -1


def blocks(html: str) -> list[Block]:
    """The blocks of a page that hold text, in order."""
    found: list[Block] = []
    path: list[str] = []
    parts: list[str] = []
    state = {"linked": 0, "path": ()}

    def add(text: str) -> None:
        if text and not text.isspace():
            if not parts or all(p.isspace() for p in parts):
                state["path"] = tuple(path)
            if any(t.startswith("a.") or t == "a" for t in path):
                state["linked"] += len(text)
        if text:
            parts.append(text)

    def end_line() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                found.append(Block(state["path"], text, state["linked"]))
            parts.clear()
        state["linked"] = 0

    at, size = 0, len(html)
    while at < size:
        tag = html.find("<", at)
        if tag < 0:
            add(html[at:])
            break
        add(html[at:tag])
        if html.startswith("<!--", tag):
            close = html.find("-->", tag + 4)
            at = size if close < 0 else close + 3
            continue
        closing = html.startswith("/", tag + 1)
        m = NAME.match(html, tag + 1 + closing)
        if not m:
            if html[tag + 1 : tag + 2] in ("!", "?", "/"):
                close = html.find(">", tag)
                at = size if close < 0 else close + 1
            else:
                add("<")
                at = tag + 1
            continue
        name = m[0].lower()
        close = tag_end(html, m.end())
        if close < 0:
            break
        at = close + 1
        if name not in INLINE:
            end_line()
        if closing:
            for i in range(len(path) - 1, -1, -1):
                if path[i].split(".")[0] == name:
                    del path[i:]
                    break
            continue
        if name in VOID:
            continue
        if name in CLOSES:
            for i in range(len(path) - 1, max(-1, len(path) - 4), -1):
                if path[i].split(".")[0] == name:
                    del path[i:]
                    break
                if path[i].split(".")[0] not in INLINE:
                    break
        if html[close - 1] == "/":
            continue
        said = " ".join("".join(x) for x in ATTRIBUTE.findall(html[m.end() : close]))
        path.append(".".join([name, *re.findall(r"[a-z0-9]+", said.lower())]))
        if name in RAW:
            finish = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            if finish:
                if name not in ("script", "style"):
                    add(html[at : finish.start()])
                end_line()
                at = finish.end()
            else:
                at = size
            path.pop()
    end_line()
    return found


def weak_label(block: Block) -> int:
    """Whether a block's tags say that it is part of the article."""
    names = [t.split(".") for t in block.path]
    return int(
        any(n[0] in MAIN for n in names)
        and not any(n[0] in AROUND or HINTS & set(n[1:]) for n in names)
    )


def surrounded(page: list[Block]) -> list[Block]:
    """The page with some runs of its article's blocks inside surroundings, the same every time."""
    draw = np.random.default_rng(zlib.crc32(" ".join(b.text for b in page).encode()))
    tags, hints = sorted(AROUND - HIDDEN), sorted(HINTS)
    found, inside, left = [], "", 0
    for block in page:
        if not left:
            inside, left = "", int(draw.integers(1, 6))
            if draw.random() < 0.4:
                inside = str(draw.choice(tags))
                if draw.random() < 0.7:
                    inside = str(draw.choice(["div", "section", "ul", "p"])) + "." + str(draw.choice(hints))
        left -= 1
        if inside and weak_label(block):
            own = int(draw.integers(0, 2))  # around the block's own tag, or inside it
            path = (*block.path[: len(block.path) - own], inside, *block.path[len(block.path) - own :])
            block = Block(path, block.text, block.linked)
        found.append(block)
    return found


# --- vectors


def hashed(rows: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((rows, WIDTH)) / np.sqrt(WIDTH)


WORD_VECTORS, TAG_VECTORS = hashed(WORDS, 1), hashed(TAGS, 2)
# Two vectors of tags, and whether one of these names a surrounding.
TAG_INPUT = 2 * WIDTH + 1
INPUT = TAG_INPUT + WIDTH + 5


def mean_vector(table: np.ndarray, words: list[str]) -> np.ndarray:
    if not words:
        return np.zeros(WIDTH)
    index = [zlib.crc32(w.encode()) % len(table) for w in words]
    return table[index].mean(axis=0)


def vectors(page: list[Block]) -> np.ndarray:
    """[blocks, INPUT]"""
    rows = []
    tags: dict[tuple[str, ...], tuple[np.ndarray, ...]] = {}
    for i, block in enumerate(page):
        if block.path not in tags:
            names = [part for tag in block.path for part in tag.split(".")]
            own = block.path[-1].split(".") if block.path else []
            around = any(n in AROUND or n in HINTS for n in names)
            path = 4 * mean_vector(TAG_VECTORS, names), mean_vector(TAG_VECTORS, own)
            tags[block.path] = *path, np.array([2.0 * around])
        n = len(block.text)
        numbers = (
            np.log1p(n) / 6,
            min(1.0, block.linked / max(1, n)),
            min(5, sum(map(block.text.count, ".,;?!"))) / 5,
            i / len(page),
            1.0,
        )
        words = mean_vector(WORD_VECTORS, block.text.lower().split())
        rows.append(np.concatenate([*tags[block.path], words, numbers]))
    return np.array(rows).reshape(len(page), INPUT)


# --- the labeller


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Labeller:
    """A bidirectional LSTM with one output per block."""

    def __init__(self, seed: int = SEED):
        rng, h = np.random.default_rng(seed), HIDDEN_SIZE
        self.p = {}
        for d in "fb":
            self.p[d + "x"] = rng.standard_normal((INPUT, 4 * h)) / np.sqrt(INPUT)
            self.p[d + "h"] = rng.standard_normal((h, 4 * h)) / np.sqrt(h)
            self.p[d + "c"] = np.zeros(4 * h)
            self.p[d + "c"][h : 2 * h] = 1.0  # remember at first
        self.p["o"] = rng.standard_normal((2 * h, 1)) / np.sqrt(2 * h)
        self.p["oc"] = np.zeros(1)

    def run(self, x: np.ndarray, real: np.ndarray, d: str):
        """States [time, pages, h] of one direction, and what going back needs; ``real`` [time,
        pages] is 1 where there is a block. Padding keeps the state."""
        h = HIDDEN_SIZE
        time, pages, _ = x.shape
        gates = x @ self.p[d + "x"] + self.p[d + "c"]
        state, cell = np.zeros((pages, h)), np.zeros((pages, h))
        states, kept = np.zeros((time, pages, h)), []
        for t in range(time) if d == "f" else range(time - 1, -1, -1):
            a = gates[t] + state @ self.p[d + "h"]
            i, f, o = (sigmoid(a[:, k * h : (k + 1) * h]) for k in range(3))
            g = np.tanh(a[:, 3 * h :])
            new = f * cell + i * g
            out = o * np.tanh(new)
            m = real[t][:, None]
            kept.append((t, state, cell, i, f, o, g, new, m))
            cell, state = m * new + (1 - m) * cell, m * out + (1 - m) * state
            states[t] = state
        return states, kept

    def scores(self, x: np.ndarray, real: np.ndarray):
        fw, kept_f = self.run(x, real, "f")
        bw, kept_b = self.run(x, real, "b")
        both = np.concatenate([fw, bw], axis=2)
        return (both @ self.p["o"])[:, :, 0] + self.p["oc"], both, kept_f, kept_b

    def gradients(self, x: np.ndarray, real: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss of the blocks."""
        h = HIDDEN_SIZE
        s, both, kept_f, kept_b = self.scores(x, real)
        error = (sigmoid(s) - y) * real / real.sum()
        g = {"o": np.einsum("tbh,tb->h", both, error)[:, None], "oc": np.array([error.sum()])}
        back = error[:, :, None] * self.p["o"][:, 0]
        for d, kept, part in (("f", kept_f, back[:, :, :h]), ("b", kept_b, back[:, :, h:])):
            da = np.zeros((*real.shape, 4 * h))
            dh, dc = np.zeros((real.shape[1], h)), np.zeros((real.shape[1], h))
            gh = np.zeros_like(self.p[d + "h"])
            for t, state, cell, i, f, o, c, new, m in reversed(kept):
                dh = dh + part[t]
                up, carry = m * dh, (1 - m) * dh
                tan = np.tanh(new)
                dnew = m * dc + up * o * (1 - tan**2)
                da[t] = np.concatenate(
                    [
                        dnew * c * i * (1 - i),
                        dnew * cell * f * (1 - f),
                        up * tan * o * (1 - o),
                        dnew * i * (1 - c**2),
                    ],
                    axis=1,
                )
                gh += state.T @ da[t]
                dh = carry + da[t] @ self.p[d + "h"].T
                dc = dnew * f + (1 - m) * dc
            g[d + "h"] = gh
            g[d + "x"] = np.einsum("tbi,tbk->ik", x, da)
            g[d + "c"] = da.sum(axis=(0, 1))
        return g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> None:
        """Adam on batches of pages (vectors, labels)."""
        rng = np.random.default_rng(SEED)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), 16):
                some = [pages[i] for i in order[at : at + 16]]
                x, real = padded([v for v, _ in some])
                y = padded([label[:, None] for _, label in some])[0][:, :, 0]
                hide = rng.random(len(some)) < 0.15
                x[:, hide, :TAG_INPUT] = 0
                step += 1
                for k, grad in self.gradients(x, real, y).items():
                    grad = np.clip(grad, -1, 1)
                    mean[k] = 0.9 * mean[k] + 0.1 * grad
                    square[k] = 0.99 * square[k] + 0.01 * grad**2
                    unbiased = mean[k] / (1 - 0.9**step)
                    self.p[k] -= 0.01 * unbiased / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is main text. Pages of like length are read together."""
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        found: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(pages[order[end]]) <= HELD:
                end += 1
            some = [i for i in order[at:end] if len(pages[i])]
            if some:
                x, real = padded([pages[i] for i in some])
                s = self.scores(x, real)[0]
                for column, i in enumerate(some):
                    found[i] = s[: len(pages[i]), column] > 0
            at = end
        return found


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """[time, pages, width] and which of it is real [time, pages]."""
    time = max(map(len, pages))
    x = np.zeros((time, len(pages), pages[0].shape[1]))
    real = np.zeros((time, len(pages)))
    for i, page in enumerate(pages):
        x[: len(page), i], real[: len(page), i] = page, 1
    return x, real


# --- tables


def drawn(pages: DataFrame, html: str, sample: int = SAMPLE, ids: tuple[str, ...] = ()) -> DataFrame:
    """``html`` of ``sample`` pages at most, those whose ``ids`` and ``html`` hash lowest."""
    share = min(1.0, sample / max(1, pages.count()))
    text = F.col(html).cast("string")
    # Of the ids too, as many pages may hold the same.
    some = pages.select(text.alias("html"), F.xxhash64(*ids, text).alias("rank")).where(
        (F.pmod("rank", F.lit(1_000_003)) < share * 1_000_003) & (F.length("html") <= LONGEST)
    )
    return lowest(some, "rank", sample)


def learn(
    pages: DataFrame, html: str, sample: int = SAMPLE, ids: tuple[str, ...] = ()
) -> Labeller | None:
    """A labeller from the pages of a sample whose tags name an article; None without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "html"):
                rows = []
                for page in part["html"]:
                    found = blocks(page or "")
                    if zlib.crc32((page or "").encode()) % 2:
                        found = surrounded(found)
                    labels = [weak_label(b) for b in found]
                    if any(labels):
                        rows.append((vectors(found).ravel().tolist(), labels))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.list_(pa.float64())),
                        pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                    ],
                    names=["x", "y"],
                )

    some = drawn(pages, html, sample, ids)
    rows = some.mapInArrow(run, "x array<double>, y array<long>").collect()
    if not rows:
        return None
    own = Labeller()
    own.fit(
        sorted(
            ((np.array(r["x"]).reshape(-1, INPUT), np.array(r["y"], float)) for r in rows),
            key=lambda page: (len(page[1]), page[0].tobytes()),
        )
    )
    return own


def main_text(pages: list[str], own: Labeller | None) -> list[str]:
    read = [[b for b in blocks(p) if not b.hidden()] for p in pages]
    if own is None:
        return [" ".join(b.text for b in page) for page in read]
    main = own.label([vectors(page) for page in read])
    return [" ".join(b.text for b, keep in zip(p, m) if keep) for p, m in zip(read, main)]


def extract(
    pages_: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    sample: int = SAMPLE,
) -> DataFrame:
    """Per page its key, its URL and ``text``, the main text."""
    own = learn(pages_, html, sample, (key, url))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [batch.schema.field(n).type for n in ("key", "url")]
            for part in pieces(batch, "html"):
                texts = main_text([p or "" for p in part["html"]], own)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(part["key"], kinds[0]),
                        "url": pa.array(part["url"], kinds[1]),
                        "text": pa.array(texts, pa.string()),
                    }
                )

    three = pages_.select(
        F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).cast("string").alias("html")
    )
    kinds = [three.schema[n].dataType.simpleString() for n in ("key", "url")]
    return three.mapInArrow(run, f"key {kinds[0]}, url {kinds[1]}, text string").select(
        F.col("key").alias(key), F.col("url").alias(url), "text"
    )
