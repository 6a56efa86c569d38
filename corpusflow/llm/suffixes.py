"""Suffix arrays by induced sorting and permuted common prefixes, a bucket at a time in NumPy.

After Nong, Zhang and Chan, "Linear suffix array construction by almost pure
induced-sorting": suffixes are classified as L (larger than the next) or S, the
substrings between leftmost S suffixes (LMS) are sorted by inducing from their
first characters, and the sorted LMS suffixes induce all others. A bucket's
entries are handled in waves; an entry is touched once in each direction.

The reduced string of LMS names is sorted by doubling ranks, not by recursion:
its alphabet is as large as itself, so buckets hold one or two entries and a
loop over them would cost more than sorting. Names are sorted up to ``depth``
characters, which is as far as callers compare.
"""

from __future__ import annotations

import numpy as np


def s_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last is not."""
    n = len(text)
    s = np.zeros(n, bool)
    if n > 1:
        step = np.diff(text.astype(np.int16))
        at = np.where(step != 0, np.arange(n - 1), n - 1)
        at = np.minimum.accumulate(at[::-1])[::-1]
        s[:-1] = np.append(step, -1)[at] > 0
    return s


class _Buckets:
    def __init__(self, text: np.ndarray, s: np.ndarray):
        self.text, self.s = text, s
        self.size = np.bincount(text, minlength=256)
        self.end = np.cumsum(self.size)
        self.start = self.end - self.size
        self.used = np.flatnonzero(self.size).tolist()

    def _before(self, block: np.ndarray, s: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The suffixes one to the left that are of the type, by bucket and in the order found, and their ranks there."""
        p = block - 1
        p = p[p >= 0]
        p = p[self.s[p] == s]
        c = self.text[p]
        order = np.argsort(c, kind="stable")
        p, c = p[order], c[order]
        n = np.bincount(c, minlength=256)
        rank = np.arange(len(c)) - (np.cumsum(n) - n)[c]
        return p, c, n, rank

    def induce(self, lms: np.ndarray) -> np.ndarray:
        """All suffixes in the order that sorted LMS suffixes give them."""
        sa = np.full(len(self.text), -1, np.int32)
        c = self.text[lms]
        n = np.bincount(c, minlength=256)
        low = self.end - n
        sa[low[c] + np.arange(len(lms)) - (np.cumsum(n) - n)[c]] = lms
        head = self.start.copy()

        def left(block: np.ndarray) -> None:
            p, c, n, rank = self._before(block, False)
            sa[head[c] + rank] = p
            head[:] += n

        left(np.array([len(self.text)], np.int32))  # the empty suffix comes first
        for b in self.used:
            done = self.start[b]
            while done < head[b]:
                block, done = sa[done : head[b]], head[b]
                left(block)
            if low[b] < self.end[b]:
                left(sa[low[b] : self.end[b]])
        tail = self.end.copy()

        def right(block: np.ndarray) -> None:
            p, c, n, rank = self._before(block, True)
            sa[tail[c] - 1 - rank] = p
            tail[:] -= n

        for b in reversed(self.used):
            done = self.end[b]
            while done > tail[b]:
                block, done = sa[tail[b] : done][::-1], tail[b]
                right(block)
            if self.start[b] < head[b]:
                right(sa[self.start[b] : head[b]][::-1])
        return sa


def _same(text: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the substrings of ``lengths`` at ``a`` and ``b`` are equal."""
    out = np.zeros(len(a), bool)
    live, at = np.arange(len(a)), 0
    while len(live):
        live = live[text[a[live] + at] == text[b[live] + at]]
        at += 1
        ended = lengths[live] <= at
        out[live[ended]] = True
        live = live[~ended]
    return out


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a byte array, sorted at least by their first ``depth`` bytes."""
    if len(text) < 2:
        return np.arange(len(text), dtype=np.int32)
    s = s_types(text)
    buckets = _Buckets(text, s)
    lms = (np.flatnonzero(s[1:] & ~s[:-1]) + 1).astype(np.int32)
    if len(lms) < 2:
        return buckets.induce(lms)
    first = buckets.induce(lms[np.argsort(text[lms], kind="stable")])
    number = np.full(len(text), -1, np.int32)
    number[lms] = np.arange(len(lms))
    order = number[first]
    order = order[order >= 0]
    length = np.append(np.diff(lms), len(text) - lms[-1])  # up to the next LMS position, whose own byte counts as well
    a, b = order[:-1], order[1:]
    equal = (length[a] == length[b]) & (a != len(lms) - 1) & (b != len(lms) - 1)
    at = np.flatnonzero(equal)
    equal[at] = _same(text, lms[a[at]], lms[b[at]], length[a[at]] + 1)
    rank = np.empty(len(lms), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(~equal)]) + 1
    names, width = int(rank.max()), 1
    while names < len(lms) and 2 * width < depth + 2:  # a name stands for two bytes at least
        after = np.zeros_like(rank)
        after[:-width] = rank[width:]
        key = rank * (names + 1) + after
        order = np.argsort(key, kind="stable")
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)]) + 1
        names, width = int(rank.max()), 2 * width
    return buckets.induce(lms[np.argsort(rank, kind="stable")])


def permuted_common_prefixes(text: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """For every position in text order: the bytes it shares with its predecessor in ``sa``, counted to ``limit`` at most.

    Bytes are compared eight at a time as long as they agree; counts below the
    limit are multiples of eight.
    """
    n = len(text)
    words = np.concatenate([text, np.zeros(limit + 16, np.uint8)]).astype(np.uint64)
    for width in (1, 2, 4):
        words = words[:-width] | (words[width:] << np.uint64(8 * width))
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    plcp = np.zeros(n, np.int32)
    live = np.flatnonzero((phi >= 0) & (np.maximum(phi, np.arange(n)) + limit <= n))
    for at in [*range(0, limit - 8, 8), limit - 8]:
        live = live[words[live + at] == words[phi[live] + at]]
        plcp[live] = min(at + 8, limit)
    return plcp
