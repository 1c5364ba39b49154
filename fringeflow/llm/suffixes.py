"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified (S where a suffix is smaller than the next one, L where it is larger), the substrings
between leftmost S suffixes are sorted, their names make a string of at most half the length that is sorted by
recursion, and the order of the leftmost S suffixes induces that of all L and then of all S suffixes.

A scan that places one suffix at a time is no work for arrays, so a whole class is induced in rounds: inside a bucket a
suffix follows from the rank of its neighbour, and as the neighbour may still be tied, round k looks 2^k places
on, never past the suffix that the stretch is induced from. Stretches of one class are short (one or two symbols on
average), so the rounds shrink at once; a level costs a few passes over its symbols.
"""

from __future__ import annotations

import numpy as np


def _split_ties(r: np.ndarray, at: np.ndarray, left: np.ndarray) -> None:
    """Rank suffixes ``at``, given in order of ``r``, by what follows them; ``left`` is how far each may look.

    ``r`` holds the first place of each group of ties and is mended in place.
    """
    n, k = len(r), 1
    head = r[at]
    new = np.append(True, head[1:] != head[:-1])
    place = head + np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    tied = ~(new & np.append(new[1:], True))
    at, place = at[tied], place[tied]
    while True:
        more = left[at] >= k  # all of a group or none
        at, place = at[more], place[more]
        if not len(at):
            return
        key = r[at] * n + r[at + k]
        order = np.argsort(key)
        at, key = at[order], key[order]
        new = np.append(True, key[1:] != key[:-1])
        r[at] = place[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        tied = ~(new & np.append(new[1:], True))
        at, place = at[tied], place[tied]
        k *= 2


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, order: np.ndarray | None) -> np.ndarray:
    """Ranks of all suffixes from the order of the leftmost S suffixes; without it, of all up to the next of those."""
    n = len(s)
    counts = np.bincount(s)
    begin = np.cumsum(counts) - counts
    larger = np.bincount(s[~small], minlength=len(counts))
    r = begin[s]
    r[small] += larger[s[small]]  # in each bucket the L suffixes come first
    if order is not None:
        by = lms[np.argsort(order)]
        new = np.append(True, s[by[1:]] != s[by[:-1]])
        r[by] += np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    left = np.zeros(n, np.int64)
    for kind in (False, True):
        at = np.flatnonzero(small == kind)
        stop = np.where(small != kind, np.arange(n), n)
        left[at] = np.minimum.accumulate(stop[::-1])[::-1][at] - at
        if kind:
            left[-1] = 0
            r[at] = (begin + larger)[s[at]]
        _split_ties(r, at[np.argsort(s[at], kind="stable")], left)
    return r


def suffix_ranks(s: np.ndarray) -> np.ndarray:
    """For each suffix its place in the sorted order; symbols are 0, 1, ..., none left out, and the last is the only 0."""
    n, sigma = len(s), int(s.max()) + 1
    if sigma == n:
        return s.astype(np.int64)
    # S where the next different symbol is larger.
    differs = np.append(np.flatnonzero(s[1:] != s[:-1]), n - 1)
    upto = np.append(s[differs[:-1]] < s[differs[:-1] + 1], True)
    small = np.repeat(upto, np.diff(differs, prepend=-1))
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    found = _induce(s, small, lms, None)[lms]
    values, names = np.unique(found, return_inverse=True)
    order = names if len(values) == len(lms) else suffix_ranks(names)
    return _induce(s, small, lms, order)


def common_prefixes(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes ``a`` and ``b`` share, for each pair; ``s`` ends with a symbol of its own."""
    out = np.zeros(len(a), np.int64)
    open_, at = np.arange(len(a)), np.zeros(len(a), np.int64)
    while len(open_):
        block = int(np.clip((1 << 16) // len(open_), 4, 4096))
        step = at[open_, None] + np.arange(block)
        x, y = np.minimum(a[open_, None] + step, len(s) - 1), np.minimum(b[open_, None] + step, len(s) - 1)
        off = s[x] != s[y]
        ended = off.any(axis=1)
        out[open_[ended]] = at[open_[ended]] + off[ended].argmax(axis=1)
        open_ = open_[~ended]
        at[open_] += block
    return out


def permuted_lcp(s: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and for each suffix the prefix that it shares with the one before it in sorted order.

    Where the symbols before both are equal, the value is that of the suffix before less one; only the others are compared.
    """
    n = len(s)
    sa = np.empty(n, np.int64)
    sa[ranks] = np.arange(n)
    before = np.zeros(n, np.int64)
    before[sa[1:]] = sa[:-1]
    own = np.append(True, s[:-1] != s[before[1:] - 1]) | (before == 0)
    own[sa[0]] = True
    at = np.flatnonzero(own)
    met = at[at != sa[0]]
    lcp = np.zeros(n, np.int64)
    lcp[met] = common_prefixes(s, met, before[met])
    last = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    return sa, lcp[last] - (np.arange(n) - last)
