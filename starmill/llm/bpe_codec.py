"""Operator 5: byte-level BPE encoding and decoding by a walk over a trie of words.

The last token of a word's encoding is settled by the last tokens of its prefixes: ``t`` ends the
encoding of ``p + t`` exactly if the merges leave the last token of ``p`` and ``t`` apart. So a
depth-first walk over a trie of the distinct words carries one token per depth, and words that
share a prefix share its states. The sorted words are the walk: a word keeps as many states as it
has bytes in common with the word before. A state is settled when an encoding asks for it; most
depths lie inside a token and are never asked for.

Documents never leave their task: no shuffle. A task keeps the ids of words seen before in two
generations of bounded size.

Cases: a null text counts as empty; an empty text has no ids and both digests are of no bytes;
strings of added tokens inside texts become these tokens, as the library does by default; equal
rows give equal rows; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.bpe import RUN, ByteBPE
from starmill.llm.common import held, pieces, returning

# Runs of text whose ids a task remembers, per generation.
REMEMBERED = 200_000
# No state yet; -1 is the state of the empty prefix.
UNSETTLED = -2


class TrieEncoder:
    """Encodes words by their trie.

    A vocabulary's merges come in the order they were learned, so both sides of a merge are
    single bytes or come from earlier merges, and each token from one merge. Then the merges on
    the two sides of a border happen in the order of their ranks, and ``_apart`` only has to
    follow the part at the end of the left token and the part at the start of the right one while
    they grow: a merge across the border happens if it ranks before the next growth of both.

    The tokens that may end a prefix come from an automaton of the tokens' prefixes, one step a byte.
    """

    def __init__(self, bpe: ByteBPE):
        self.bpe = bpe
        self.sides, self.rank = {}, {}
        for pair, rank in bpe.ranks.items():
            token = pair[0] + pair[1]
            self.sides[token], self.rank[token] = pair, rank
        early = lambda part, rank: len(part) == 1 or self.rank.get(part, rank) < rank
        if len(self.sides) < len(bpe.ranks) or not all(
            early(left, rank) and early(right, rank) for (left, right), rank in bpe.ranks.items()
        ):
            raise ValueError("the merges aren't in the order they were learned")
        most = max(bpe.parts, default=0) + 1
        self.size = [len(bpe.parts.get(i, b"")) for i in range(most)]
        self.many = most
        self._prefixes(most)
        self.jumps: dict[int, int] = {}
        self.apart: dict[int, bool] = {}
        self.stable: dict[bytes, bool] = {}
        self.edges: dict[tuple[bytes, int], list[tuple[bytes, int]]] = {}

    def _prefixes(self, most: int) -> None:
        """The automaton of the tokens' prefixes, level by level. ``longest``: the longest token a
        prefix ends with; ``shorter``: the longest token that a token ends with besides itself."""
        self.children: dict[int, int] = {}  # by prefix << 8 | byte
        self.fails = [0]  # the longest other prefix that a prefix ends with
        self.longest, self.shorter = [-1], [-1] * most
        level = [(token, i, 0) for token, i in self.bpe.ids.items() if token]
        depth = 0
        while level:
            further = []
            for token, i, node in level:
                key = node << 8 | token[depth]
                child = self.children.get(key)
                if child is None:
                    child = len(self.fails)
                    fail = self._fallen(self.fails[node], token[depth]) if node else 0
                    self.children[key] = child
                    self.fails.append(fail)
                    self.longest.append(self.longest[fail])
                if len(token) == depth + 1:
                    self.longest[child], self.shorter[i] = i, self.longest[self.fails[child]]
                else:
                    further.append((token, i, child))
            level, depth = further, depth + 1

    def _fallen(self, node: int, byte: int) -> int:
        """The longest prefix that ``node`` and a further byte end with."""
        while True:
            child = self.children.get(node << 8 | byte)
            if child is not None or not node:
                return child or 0
            node = self.fails[node]

    def walk(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Each distinct word with its ids, in sorted order."""
        nodes: list[int] = [0]  # at i the longest prefix of a token that the first i bytes end with
        states: list[int] = [-1]  # at i the last token of the first i bytes, UNSETTLED before
        starts: list[int] = [0]  # where that token starts
        before = b""
        for word in sorted(set(words)):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del nodes[shared + 1 :], states[shared + 1 :], starts[shared + 1 :]
            if len(self.jumps) >= REMEMBERED:
                self.jumps = {}
            jumps, node = self.jumps, nodes[shared]
            for byte in word[shared:]:
                key = node << 8 | byte
                node = jumps.get(key)
                if node is None:
                    node = jumps[key] = self._fallen(key >> 8, byte)
                nodes.append(node)
            states += [UNSETTLED] * (len(word) - shared)
            starts += [0] * (len(word) - shared)
            ids, at = [], len(word)
            while at:
                if states[at] == UNSETTLED:
                    self._settle(word, at, nodes, states, starts)
                ids.append(states[at])
                at = starts[at]
            yield word, ids[::-1]
            before = word

    def _settle(
        self, word: bytes, end: int, nodes: list[int], states: list[int], starts: list[int]
    ) -> None:
        """Finds the last token of the first ``end`` bytes, and of those prefixes it depends on."""
        size, shorter, apart, many = self.size, self.shorter, self.apart, self.many
        waiting: list[tuple[int, int]] = []  # ends that wait for the state of a shorter prefix
        token = self._candidates(nodes, word, end)
        while True:
            at = end - size[token]
            less = shorter[token]
            # Some token ends the encoding, so the last candidate needs no look.
            if less >= 0:
                left = states[at]
                if left == UNSETTLED:
                    waiting.append((end, token))
                    end = at
                    token = self._candidates(nodes, word, end)
                    continue
                pair = left * many + token
                fits = apart.get(pair)
                if fits is None:
                    if len(apart) >= REMEMBERED:
                        apart.clear()
                    fits = apart[pair] = self._apart(
                        self.bpe.parts.get(left, b""), self.bpe.parts[token]
                    )
                if not fits:
                    token = less
                    continue
            states[end], starts[end] = token, at
            if not waiting:
                return
            end, token = waiting.pop()

    def _candidates(self, nodes: list[int], word: bytes, end: int) -> int:
        """The longest token that ends there; ``shorter`` leads to the others."""
        token = self.longest[nodes[end]]
        if token < 0:
            raise ValueError(f"byte {word[end - 1]} is missing in the vocabulary")
        return token

    def _apart(self, left: bytes, right: bytes) -> bool:
        """Whether the merges of ``left + right``, ``left`` being a token that merges form, form
        these two tokens. Empty ``left``: whether they form ``right``."""
        stable = self.stable.get(right)
        if stable is None:
            stable = self.stable[right] = self.bpe.merge(right) == [right]
        if not stable or not left:
            return stable
        a, b, i, j = self._edge(left, 1), self._edge(right, 0), 0, 0
        while True:
            (end, grows), (begin, spreads) = a[i], b[j]
            rank = self.bpe.ranks.get((end, begin))
            if rank is not None and rank < grows and rank <= spreads:
                return False
            if i + 1 == len(a) and j + 1 == len(b):
                return True
            if grows <= spreads:
                i += 1
            else:
                j += 1

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts at one side of a token while it is merged, each with the rank of the merge
        that takes it up."""
        edge = self.edges.get((token, side))
        if edge is None:
            parts = [token]
            while parts[-1] in self.sides:
                parts.append(self.sides[parts[-1]][side])
            parts.reverse()
            taken = [self.rank[p] for p in parts[1:]] + [len(self.rank)]
            edge = self.edges[token, side] = list(zip(parts, taken))
        return edge


class Codec:
    """Ids of texts and texts of ids, with a bounded memory of runs."""

    def __init__(self, path: str):
        self.bpe = ByteBPE(path)
        self.trie = TrieEncoder(self.bpe)
        self.parts = [self.bpe.parts.get(i, b"") for i in range(self.trie.many)]
        self.codes = [i.to_bytes(4, "little") for i in range(self.trie.many)]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        split = []
        for text in texts:
            stretches = self.bpe.split_special(text)
            split.append([(RUN.findall(s) if i is None else s, i) for s, i in stretches])
        known = self._runs({r for parts in split for runs, i in parts if i is None for r in runs})
        found = []
        for parts in split:
            found.append(
                b"".join(
                    b"".join(map(known.__getitem__, runs))
                    if i is None
                    else i.to_bytes(4, "little")
                    for runs, i in parts
                )
            )
        return found

    def decode(self, ids: bytes) -> str:
        numbers = memoryview(ids).cast("I") if ids else []
        return b"".join(map(self.parts.__getitem__, numbers)).decode("utf-8", "replace")

    def _runs(self, runs: set[str]) -> dict[str, bytes]:
        known, new = self.young, {}
        for run in runs.difference(known):
            ids = self.old.get(run)
            if ids is None:
                new[run] = self.bpe.words(run)
            else:
                known[run] = ids
        code = self.codes.__getitem__
        encoded = {
            word: b"".join(map(code, ids))
            for word, ids in self.trie.walk(w for words in new.values() for w in words)
        }
        for run, words in new.items():
            known[run] = b"".join(map(encoded.__getitem__, words))
        if len(known) > REMEMBERED:
            self.old, self.young = known, {}
        return known


def codec(path: str) -> Codec:
    """One codec per worker process, file and stage."""
    return held((Codec, path), lambda: Codec(path))


def encode_decode(path: str) -> Callable:
    """For ``mapInArrow`` over columns ``key`` and ``text``: the text's ids and what they decode
    to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in pieces(batch):
                ids = own.encode([t or "" for t in part["text"]])
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(part["key"], batch.schema.field("key").type),
                        "ids": pa.array(ids, pa.binary()),
                        "decoded": pa.array(map(own.decode, ids), pa.string()),
                    }
                )

    return run


def bpe_documents(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document its key, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded``."""
    two = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = two.schema["key"].dataType.simpleString()
    return two.mapInArrow(encode_decode(path), f"key {kind}, ids binary, decoded string")


def bpe_digest(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its key, number of tokens, and digests of the ids and of the decoded text."""

    @returning
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in encode_decode(path)(batches):
            ids, decoded = batch.column("ids").to_pylist(), batch.column("decoded").to_pylist()
            yield pa.RecordBatch.from_pydict(
                {
                    "key": batch.column("key"),
                    "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()),
                    "ids_sha256": pa.array(map(sha, ids), pa.string()),
                    "decoded_sha256": pa.array([sha(d.encode()) for d in decoded], pa.string()),
                }
            )

    two = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = two.schema["key"].dataType.simpleString()
    return two.mapInArrow(
        run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    ).withColumnRenamed("key", key)
