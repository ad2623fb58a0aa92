"""Byte-level BPE files: where a text is split before its merges, and the merges of one word."""

from __future__ import annotations

import json
import re
import string

import regex
from tokenizers.pre_tokenizers import ByteLevel

# White space by Unicode, as the inside of a character class, and the pattern the
# byte-level splitter states.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# For characters below U+0250, on which all versions of Unicode agree.
WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
MARKS = frozenset(string.punctuation)
# The same pattern with everything between white space left together: a run never splits inside
# the white space in front of it, so words can be looked for in each run alone.
RUN = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


class ByteBPE:
    """A ``tokenizers`` file of the byte-level BPE kind.

    ``ids``: id by bytes; ``parts``: bytes by id; ``ranks``: order of a merge by its two sides;
    ``special``: id by string of the added tokens, which are found in texts before anything else.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        added = spec["added_tokens"]
        if (
            model["type"] != "BPE"
            or before["type"] != "ByteLevel"
            or before["add_prefix_space"]
            or not before["use_regex"]
            or spec["normalizer"]
            or model.get("ignore_merges")
            or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
        ):
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        byte = byte_of_char()
        as_bytes = lambda word: bytes(byte[c] for c in word)
        self.special = {t["content"]: t["id"] for t in added}
        self.ids = {
            as_bytes(word): i for word, i in model["vocab"].items() if word not in self.special
        }
        self.parts = {i: word for word, i in self.ids.items()}
        self.parts |= {i: word.encode() for word, i in self.special.items()}
        self.ranks = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[as_bytes(left), as_bytes(right)] = rank
        self._splitter = ByteLevel(add_prefix_space=False, use_regex=True)
        self._special = (
            re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
            if self.special
            else None
        )

    def split_special(self, text: str) -> list[tuple[str, int | None]]:
        """``text`` in order as (stretch, None) and (string of an added token, its id)."""
        if self._special is None:
            return [(text, None)]
        found, at = [], 0
        for m in self._special.finditer(text):
            found += [(text[at : m.start()], None), (m[0], self.special[m[0]])]
            at = m.end()
        return [*found, (text[at:], None)]

    def words(self, run: str) -> list[bytes]:
        """The words of a run that the merges never cross."""
        if run.isascii() or max(run) < "\u0250":
            # Most runs are letters, or letters and one mark, behind at most one space.
            body = run[1:] if run[0] == " " else run
            if body.isalpha():
                return [run.encode()]
            if body[-1:] in MARKS and body[:-1].isalpha():
                return [run[:-1].encode(), run[-1:].encode()]
            return [w.encode() for w in WORD.findall(run)]
        # Which later characters are letters or numbers depends on the library's Unicode tables.
        return [run[a:b].encode() for _, (a, b) in self._splitter.pre_tokenize_str(run)]

    def merge(self, word: bytes) -> list[bytes]:
        """``word`` by the definition: the earliest merge first, from the left."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranked = [
                (self.ranks.get(pair, len(self.ranks)), i)
                for i, pair in enumerate(zip(parts, parts[1:]))
            ]
            rank, i = min(ranked)
            if rank == len(self.ranks):
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts


def byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1
    characters for themselves, the rest in order from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(rest)}
