"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Buckets are scanned one after the other, as the method has it; what a scan of one bucket puts into
others is put there at once. So the Python steps are as many as symbols of the alphabet, plus runs
of equal symbols, and the work is linear in the text.
"""

from __future__ import annotations

import numpy as np

# Below this many symbols per distinct one, scanning buckets one by one costs more than it saves:
# ranks of the (by then short) text of names are doubled instead.
CROWDED = 32


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ``text`` in order. Its last symbol is 0 and occurs once."""
    n = len(text)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    small = classified(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    order = induced(text, small, lms)
    names, count = named(text, lms, order)
    if count == len(lms):
        ranks = np.empty(len(lms), np.int64)
        ranks[names] = np.arange(len(lms))
    elif len(names) < CROWDED * count:
        ranks = doubled(names)
    else:
        ranks = suffix_array(names)
    return induced(text, small, lms[ranks])


def classified(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one after them."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int64) - text[:-1])
    # A run of equal symbols goes like the step at its end.
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(np.append(step, 1)[at] > 0, True)


def induced(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes, in the order that follows from that of ``lms``."""
    n, k = len(text), int(text.max()) + 1
    count = np.bincount(text, minlength=k)
    end = np.cumsum(count)
    start = end - count
    found = np.zeros(n, np.int64)
    by_symbol = lms[np.argsort(text[lms], kind="stable")]
    lms_end = np.cumsum(np.bincount(text[lms], minlength=k))

    head = start.copy()

    def forward(x, c):
        """Puts the larger suffixes before those at ``x``; returns the ones of the same bucket."""
        j = x[x > 0] - 1
        j = j[~small[j]]
        s = text[j]
        same = s == c
        if not same.all():
            put(found, j[~same], s[~same], head, k)
        return j[same]

    for c in range(k):
        if not count[c]:
            continue
        x = found[start[c] : head[c]]
        while len(x):
            x = forward(x, c)
            found[head[c] : head[c] + len(x)] = x
            head[c] += len(x)
        own = by_symbol[lms_end[c - 1] if c else 0 : lms_end[c]]
        if len(own):
            forward(own, c)

    tail = end.copy()
    found[0], tail[0] = n - 1, 0  # the end mark

    def backward(x, c):
        j = x[x > 0] - 1
        j = j[small[j]]
        s = text[j]
        same = s == c
        if not same.all():
            put(found, j[~same], s[~same], tail, k, -1)
        return j[same]

    for c in range(k - 1, -1, -1):
        if not count[c]:
            continue
        x = found[tail[c] : end[c]][::-1]
        while len(x) and c:
            x = backward(x, c)
            found[tail[c] - len(x) : tail[c]] = x[::-1]
            tail[c] -= len(x)
        larger = found[start[c] : head[c]]
        if len(larger) and c:
            backward(larger[::-1], c)
    return found


def put(found, j, s, edge, k, way=1):
    """Writes ``j`` to the edges of their buckets ``s``, in order, and moves the edges."""
    if len(j) < 64:
        for a, b in zip(j.tolist(), s.tolist()):
            if way > 0:
                found[edge[b]] = a
                edge[b] += 1
            else:
                edge[b] -= 1
                found[edge[b]] = a
        return
    order = np.argsort(s, kind="stable")
    s = s[order]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    size = np.diff(np.append(first, len(s)))
    rank = np.arange(len(s)) - np.repeat(first, size)
    if way > 0:
        found[edge[s] + rank] = j[order]
        edge[s[first]] += size
    else:
        found[edge[s] - 1 - rank] = j[order]
        edge[s[first]] -= size


def named(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """The text of names of the substrings between ``lms`` places, which ``order`` has sorted."""
    number = np.full(len(text), -1, np.int64)
    number[lms] = np.arange(len(lms))
    ranked = number[order]
    ranked = ranked[ranked >= 0]
    length = np.append(np.diff(lms), 0) + 1
    at, size = lms[ranked], length[ranked]
    equal = size[1:] == size[:-1]
    left = np.flatnonzero(equal)
    step = 0
    while len(left):
        left = left[size[left] > step]
        if not len(left):
            break
        same = text[at[left] + step] == text[at[left + 1] + step]
        equal[left[~same]] = False
        left = left[same]
        step += 1
    names = np.empty(len(lms), np.int64)
    names[ranked] = np.cumsum(np.append(0, ~equal))
    return names, int(names[ranked[-1]]) + 1


def doubled(names: np.ndarray) -> np.ndarray:
    """The suffixes of a text of names in order, by ranks over twice as many names each time.

    Only suffixes whose rank isn't settled are sorted again.
    """
    n = len(names)
    order = np.argsort(names)
    rank = np.empty(n, np.int64)
    first = np.append(True, names[order[1:]] != names[order[:-1]])
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    step = 1
    while True:
        alone = first & np.append(first[1:], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            return order
        j = order[open_]
        after = np.where(j + step < n, rank[np.minimum(j + step, n - 1)], -1)
        own = rank[j]
        again = np.argsort(own * (n + 1) + after + 1)  # by both; both are below n
        j, own, after = j[again], own[again], after[again]
        order[open_] = j
        new = np.append(True, (own[1:] != own[:-1]) | (after[1:] != after[:-1]))
        first[open_] = new
        rank[j] = np.maximum.accumulate(np.where(new, open_, 0))
        step *= 2


def permuted_common_prefixes(
    text: np.ndarray, order: np.ndarray, most: int, where: np.ndarray | None = None
) -> np.ndarray:
    """For each place in text order, how many symbols its suffix shares with the one before it in
    ``order``, ``most`` at most. Symbols are below 2^16. With ``where``, 0 unless both places are
    marked in it."""
    if int(text.max()) >> 16:
        raise ValueError("symbols of more than 16 bits")
    before = np.empty(len(text), np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    asked = before >= 0
    if where is not None:
        asked &= where & where[before]
    # Where two such suffixes go on to the next place's two, they share one symbol more than those.
    # So only the last ones of such chains are compared.
    places = np.flatnonzero(asked)
    prior = before[places]
    on = (np.diff(places) == 1) & (np.diff(prior) == 1)
    on[on] = text[places[:-1][on]] == text[prior[:-1][on]]
    last = np.append(~on, True)[: len(places)]
    # Four symbols a word, the first one lowest.
    padded = np.append(text, np.zeros(most + 4, text.dtype)).astype(np.uint64)
    packed = padded[:-3].copy()
    for i in (1, 2, 3):
        packed |= padded[i : len(padded) - 3 + i] << np.uint64(16 * i)
    common = np.zeros(len(text), np.int64)
    left, prior = places[last], prior[last]
    for step in range(0, most, 4):
        differ = packed[left + step] ^ packed[prior + step]
        same = differ == 0
        # Past the end nothing is shared: the end mark occurs once.
        differ, at = differ[~same], left[~same]
        lowest = differ & (~differ + np.uint64(1))
        common[at] = step + sum((lowest >> np.uint64(16 * i) > 0).astype(np.int64) for i in (1, 2, 3))
        left, prior = left[same], prior[same]
        if not len(left):
            break
    common[left] = most
    ends = np.flatnonzero(last)
    ahead = np.repeat(ends, np.diff(np.append(-1, ends))) - np.arange(len(places))
    common[places] = np.minimum(common[places + ahead] + ahead, most)
    return common
