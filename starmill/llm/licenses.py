"""Operator 9: licence notices in documents by patience alignment.

Words are runs of letters and digits, in lower case. A notice is found where at least ``coverage``
of a template's words are aligned with words of the document, in order. The alignment is patience's:
equal words at both ends are paired, then words that occur once in the template and once in the
stretch of text become anchors, the longest run of anchors in order on both sides stays, and the
gaps between them are aligned in the same way.

Where to align: a document that lacks too many of the template's words cannot reach the coverage.
Of a template of n words any ``n - ceil(coverage * n) + 1`` must hold one that is aligned, so each
occurrence of the words that are rarest in the document, as many as that, gives a stretch around
the place the notice would have there. No match of the stated coverage lies outside all of them,
and words that repeat elsewhere in the document stay unique in a stretch. A stretch that other words
interrupt is continued at either side, again and again, where at least ``RUN`` words in a row (or all
that are left) go on with the template within its length and a half; parts farther apart are not
one notice.

Every stretch that reaches the coverage is listed, also of one template, as long as they share no
words: of those that overlap the best covered goes first and what lies before and behind it is
searched again. Where stretches of several templates overlap, the words are one notice, named by the
template with the most words aligned. Templates are the notices below and the licence texts in
``license_texts``, a file each.

Documents are worked on one by one where they are read, so nothing is shuffled or gathered.

Cases: null texts and texts without words have no notice; several notices are all listed, and of
equally covered ones the longest template comes first, then the first by name, then by place; equal rows, or rows with equal or null keys, are scanned one by one; an empty
table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import pieces

COVERAGE, RUN = 0.8, 3
WORD = re.compile(r"[^\W_]+")

# Notices as their licences word them.
TEMPLATES = {
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Affero General Public License for more details."
    ),
    "agpl-line": (
        "This work is licensed under the GNU Affero General Public License, version 3."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "cc-by-sa-4.0-line": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 License."
    ),
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version. This library is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Lesser General Public License for more details."
    ),
    "lgpl-line": (
        "This work is licensed under the GNU Lesser General Public License, version 3."
    ),
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the License."
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder "
        "nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission."
    ),
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."
    ),
    "mit-line": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/."
    ),
}


@lru_cache(maxsize=1)
def whole_texts() -> dict[str, str]:
    """Licence texts by name."""
    folder = files("starmill.llm") / "license_texts"
    found = [f for f in folder.iterdir() if f.name.endswith(".txt")]
    return {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in found}


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of equal words, in order on both sides."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        ours, theirs = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1)}
        shared = [
            (i, place[a[i]])
            for i in range(a0, a1)
            if ours[a[i]] == 1 and theirs.get(a[i]) == 1
        ]
        anchors = increasing(shared)
        if not anchors:
            continue
        found += anchors
        i0, j0 = a0, b0
        for i, j in [*anchors, (a1, b1)]:
            todo.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
    return sorted(found)


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs whose second parts increase, by patience sorting: each pair lies
    on the first pile whose top isn't smaller, and remembers the top of the pile before."""
    tops: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        before.append(last[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            last.append(k)
        else:
            tops[pile], last[pile] = j, k
    run, k = [], last[-1] if last else -1
    while k >= 0:
        run.append(pairs[k])
        k = before[k]
    return run[::-1]


def runs(pairs: list[tuple[int, int]], least: int) -> list[tuple[int, int]]:
    """The pairs from the first to the last run of ``least`` that follow on both sides."""
    long = [
        k
        for k in range(len(pairs) - least + 1)
        if pairs[k + least - 1][0] - pairs[k][0] == least - 1
        and pairs[k + least - 1][1] - pairs[k][1] == least - 1
    ]
    return pairs[long[0] : long[-1] + least] if long else []


class Template:
    def __init__(self, name: str, text: str, coverage: float):
        self.name, self.words = name, words(text)
        self.counts = sorted(Counter(self.words).items(), key=lambda x: -len(x[0]))
        self.needed = math.ceil(coverage * len(self.words) - 1e-9)
        self.slack = len(self.words) // 2 + 2

    def all(self, text: list[str], places: dict[str, list[int]]) -> list[tuple[int, int, int]]:
        """Words aligned, first and end of the stretches that have enough, in order."""
        n = len(self.words)
        lacking = n - self.needed
        if len(text) < self.needed:
            return []
        for w, c in self.counts:
            lacking -= max(0, c - len(places.get(w, ())))
            if lacking < 0:
                return []
        rare = sorted(range(n), key=lambda i: (len(places.get(self.words[i], ())), i))
        starts: dict[int, set[int]] = {}
        for i in rare[: n - self.needed + 1]:
            for p in places.get(self.words[i], ()):
                # Stretches that start close together see the same words.
                starts.setdefault((p - i) // self.slack * self.slack, set()).add(p - i)
        order, found, todo = sorted(starts), [], [(0, len(text))]
        while todo:
            low, high = todo.pop()
            if high - low < self.needed:
                continue
            best = None
            for start in order[bisect_left(order, low - 2 * self.slack - n) :]:
                if start >= (best[2] if best else high):
                    break
                some = self.stretch(text, low, high, start, starts[start])
                if some and (best is None or some[0] > best[0]):
                    best = some
            if best:
                found.append(best)
                todo += [(low, best[1]), (best[2], high)]
        return sorted(found, key=lambda x: x[1])

    def stretch(
        self, text: list[str], low: int, high: int, start: int, exact: set[int]
    ) -> tuple[int, int, int] | None:
        """Words aligned, first and end of the stretch about ``start``, between two places."""
        n = len(self.words)
        first, end = max(low, start - self.slack), min(high, start + 2 * self.slack + n)
        pairs = self.widened(text, low, high, first, end)
        if len(pairs) < self.needed:
            # Of notices close together no word is unique: each is looked at from its own start.
            there = Counter(text[first:max(first, end)])
            if sum(min(c, there[w]) for w, c in self.counts) < self.needed:
                return None
            for place in sorted(exact):
                some = self.widened(text, low, high, max(low, place), min(high, place + n))
                if len(some) > len(pairs):
                    pairs = some
        if len(pairs) < self.needed:
            return None
        return len(pairs), pairs[0][1], pairs[-1][1] + 1

    def widened(
        self, text: list[str], low: int, high: int, first: int, end: int
    ) -> list[tuple[int, int]]:
        """Pairs of the words and the text from ``first`` to ``end``, and those that go on with
        them at both sides."""
        n = len(self.words)
        pairs = [(i, first + j) for i, j in align(self.words, text[first : max(first, end)])]
        if not pairs or len(pairs) == n:
            return pairs
        pairs = self.continued(self.words, text, pairs, high)
        # To the other side the same backwards, over as much of the text as it takes.
        top = pairs[-1][1] + 1
        reach = max(low, pairs[0][1] - 8 * (n + self.slack))
        while True:
            back = [(n - 1 - i, top - 1 - j) for i, j in reversed(pairs)]
            some = self.continued(self.words[::-1], text[reach:top][::-1], back, top - reach)
            first = top - 1 - some[-1][1]
            if reach == low or first - reach > n + self.slack:
                return [(n - 1 - i, top - 1 - j) for i, j in reversed(some)]
            reach = max(low, first - 8 * (n + self.slack))

    def continued(
        self, ours: list[str], theirs: list[str], pairs: list[tuple[int, int]], high: int
    ) -> list[tuple[int, int]]:
        """``pairs`` and those that go on with them behind, as long as there are some."""
        while True:
            kept = runs(pairs, RUN)
            # What follows the last run may be chance: it is aligned again with what lies behind.
            kept = pairs[: pairs.index(kept[-1]) + 1] if kept else pairs
            i, j = kept[-1][0] + 1, kept[-1][1] + 1
            if i == len(ours):
                return pairs
            more = align(ours[i:], theirs[j : min(high, pairs[-1][1] + 1 + len(ours) + self.slack)])
            more = runs(more, min(RUN, len(ours) - i))
            if len(kept) + len(more) <= len(pairs):
                return pairs
            pairs = kept + [(i + a, j + b) for a, b in more]


def scan(text: str, templates: list[Template], vocabulary: frozenset[str]) -> tuple:
    """Number of words, and (name, coverage, first word, end) of all notices, the best first."""
    own = words(text)
    places: dict[str, list[int]] = {}
    if not vocabulary.isdisjoint(own):
        for i, w in enumerate(own):
            if w in vocabulary:
                places.setdefault(w, []).append(i)
    stretches = [(t, *x) for t in templates for x in t.all(own, places)] if places else []
    # Of those that overlap the one with the most words aligned stays.
    stretches.sort(key=lambda x: (-x[1], len(x[0].words), x[0].name, x[2]))
    taken: list[tuple[int, int]] = []  # in order, apart from each other
    found = []
    for t, n, first, end in stretches:
        at = bisect_left(taken, (first, end))
        if (at and taken[at - 1][1] > first) or (at < len(taken) and taken[at][0] < end):
            continue
        taken.insert(at, (first, end))
        found.append((-n / len(t.words), -len(t.words), t.name, first, end))
    return len(own), [(name, -c, first, end) for c, _, name, first, end in sorted(found)]


def license_notices(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: dict[str, str] | None = None,
    coverage: float = COVERAGE,
) -> DataFrame:
    """Per document its key, ``n_words`` and ``notices``: array of (``name``, ``coverage``,
    ``first``, ``end``), places in words, the best first."""
    given = TEMPLATES | whole_texts() if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Template(name, t, coverage) for name, t in given.items()]
        known = [t for t in known if t.words]
        vocabulary = frozenset(w for t in known for w in t.words)
        fields = [("name", pa.string()), ("coverage", pa.float64())]
        struct = pa.struct([*fields, ("first", pa.int64()), ("end", pa.int64())])
        names = [f.name for f in struct]
        for batch in batches:
            kind = batch.schema.field("key").type
            for part in pieces(batch):
                rows = [scan(t or "", known, vocabulary) for t in part["text"]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(part["key"], kind),
                        "n_words": pa.array([n for n, _ in rows], pa.int64()),
                        "notices": pa.array(
                            [[dict(zip(names, x)) for x in found] for _, found in rows],
                            pa.list_(struct),
                        ),
                    }
                )

    two = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = two.schema["key"].dataType.simpleString()
    notice = "struct<name:string,coverage:double,first:long,end:long>"
    return two.mapInArrow(run, f"key {kind}, n_words long, notices array<{notice}>").select(
        F.col("key").alias(key), "n_words", "notices"
    )
