"""Runs of words that repeat with a period, by an enhanced suffix array.

Two equal neighbours of ``l`` words are a square. A run's last square is branching: its two halves go on with
different words, so they lie in one LCP interval of depth ``l`` and in different children of it. For each interval the
suffixes of all children but the largest are looked at, and for each such ``i`` the inverse suffix array says
whether ``i + l`` or ``i - l`` lies in the interval and outside the child: O(n log n) tests and no tree. A
branching square whose block stands often enough to its left (in the same interval again) is rotated to the left as
far as words agree; squares that end up on the same stretch are one run, whose period is the smallest.

Documents are taken in chunks of about ``CHUNK`` words, whose symbols are told apart by document, so that one array
serves many short texts and no interval holds two of them. A longer text is a chunk by itself; memory grows with
its words.

Defined results: null, empty and blank texts have no words and no runs; equal texts give equal runs; an empty table
gives an empty result; extra columns are carried in ``row``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from fringeflow.llm.suffixes import permuted_lcp, suffix_ranks

TIMES = 4
LEAST = 6
CHUNK = 1 << 16
BLANK = r"[\x20\x09-\x0D]+"
Run = tuple[int, int, int]

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct([("runs", pa.list_(_RUN)), ("collapsed", pa.binary())])
FOUND = StructType([StructField("runs", ArrayType(StructType([StructField(c, LongType()) for c in ("start", "length", "period")]))), StructField("collapsed", BinaryType())])


def _symbols(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of each text, other ones in each text, with one of its own after each; where texts begin."""
    parts, begins, at = [], [], 1
    for words in texts:
        begins.append(at - 1)
        seen: dict[bytes, int] = {}
        parts += [np.fromiter(map(seen.setdefault, words, count(at)), np.int64, len(words)), np.array([at + len(words)])]
        at += len(words) + 1
    ids = np.append(np.concatenate(parts), 0)
    used = np.zeros(at + 1, np.int64)
    used[ids] = 1
    return (np.cumsum(used) - 1)[ids], np.array([*begins, at - 1])


def _smaller(lcp: np.ndarray, step: int) -> np.ndarray:
    """For places of depth 1 and more the nearest one in this direction with a smaller value; both ends of ``lcp`` are smaller than all."""
    to = np.clip(np.arange(len(lcp)) + step, 0, len(lcp) - 1)
    at = np.flatnonzero((lcp >= 1) & (lcp[to] >= lcp))
    while len(at):  # all between a place and its pointer are no smaller, so it may take over the pointer's own
        to[at] = to[to[at]]
        at = at[lcp[to[at]] >= lcp[at]]
    return to


def _intervals(lcp: np.ndarray, most: np.ndarray, times: int) -> tuple[np.ndarray, ...]:
    """Children of the LCP intervals, all but the largest of each: first and last place, depth, and the interval's places.

    An interval of depth l can hold the blocks of a run only if it has ``times`` suffixes and l is at most ``most``.
    """
    low, high = _smaller(lcp, -1), _smaller(lcp, 1) - 1
    at = np.flatnonzero((lcp >= 1) & (high - low + 1 >= times) & (lcp <= most))
    at = at[np.argsort(low[at] * len(lcp) + high[at], kind="stable")]
    if not len(at):
        return (at,) * 5
    lo, hi = low[at], high[at]
    new = np.append(True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))
    last = np.append(new[1:], True)
    # Each boundary opens a child; the first of an interval also closes the one that begins the interval.
    first = np.concatenate([lo[new], at])
    end = np.concatenate([at[new] - 1, np.where(last, hi, np.append(at[1:], 0) - 1)])
    group = np.concatenate([np.arange(new.sum()), np.cumsum(new) - 1])
    order = np.lexsort((end - first, group))
    rest = order[np.append(group[order][1:] == group[order][:-1], False)]  # the largest comes last
    return first[rest], end[rest], lcp[at[new]][group[rest]], lo[new][group[rest]], hi[new][group[rest]]


def _squares(s: np.ndarray, begins: np.ndarray, times: int) -> np.ndarray:
    """Start and length of a half of each branching square with ``times - 2`` more of its blocks before it."""
    ranks = suffix_ranks(s)
    sa, shared = permuted_lcp(s, ranks)
    sizes = np.diff(begins) - 1
    most = np.append(np.repeat(sizes // times, np.diff(begins)), 0)[sa]
    lcp = np.append(shared[sa], -1)
    lcp[0] = -1
    first, end, depth, lo, hi = _intervals(lcp, np.append(most, 0), times)
    size = end - first + 1
    child = np.repeat(np.arange(len(size)), size)
    i = sa[np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size) + first[child]]
    found = [np.zeros((0, 2), np.int64)]
    for sign in (1, -1):
        j = i + sign * depth[child]
        rank = np.where(j >= 0, ranks[j], -1)
        ok = (rank >= lo[child]) & (rank <= hi[child]) & ((rank < first[child]) | (rank > end[child]))
        at, kin = np.minimum(i, j)[ok], child[ok]
        for block in range(1, times - 1):
            left = at - block * depth[kin]
            rank = np.where(left >= 0, ranks[left], -1)
            ok = (rank >= lo[kin]) & (rank <= hi[kin])
            at, kin = at[ok], kin[ok]
        found.append(np.stack([at, depth[kin]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def _rotated(s: np.ndarray, at: int, period: int) -> int:
    """How far to the left the words still repeat with this period; the first symbol of a text repeats nowhere before it."""
    block = 64
    while at > 0:
        low = max(0, at - block)
        off = np.flatnonzero(s[low:at] != s[low + period : at + period])
        if len(off):
            return low + int(off[-1]) + 1
        at, block = low, 2 * block
    return at


def runs_of(texts: list[list[bytes]], times: int = TIMES, least: int = LEAST) -> list[list[Run]]:
    """``(start, length, period)`` of the runs of each text, by start, then period; at least ``least`` words and ``times`` periods."""
    if not texts:  # a batch whose last text filled a chunk ends with an empty one
        return []
    s, begins = _symbols(texts)
    merged: dict[tuple[int, int], int] = {}
    for at, period in _squares(s, begins, times).tolist():
        stretch = (_rotated(s, at, period), at + 2 * period)
        merged[stretch] = min(period, merged.get(stretch, period))
    out: list[list[Run]] = [[] for _ in texts]
    for (start, end), period in sorted(merged.items(), key=lambda x: (x[0][0], x[1])):
        if end - start >= max(least, times * period):
            text = int(np.searchsorted(begins, start, "right")) - 1
            out[text].append((start - int(begins[text]), end - start, period))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by one space, without those that a run repeats."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words)


def _chunks(batches: Iterable[pa.Array]) -> Iterator[tuple[bool, list[list[bytes]]]]:
    """Words of the texts, about ``CHUNK`` at a time, and whether a batch ends there."""
    for batch in batches:
        held, size = [], 0
        for raw in batch:
            held.append((raw.as_py() or b"").split())
            size += len(held[-1]) + 1
            if size >= CHUNK:
                yield False, held
                held, size = [], 0
        yield True, held


@F.arrow_udf(FOUND)
def _periodic(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    done: list[dict] = []
    for over, texts in _chunks(batches):
        done += [{"runs": [dict(zip(("start", "length", "period"), r)) for r in runs], "collapsed": collapsed(words, runs)} for words, runs in zip(texts, runs_of(texts))]
        if over:
            yield pa.array(done, _FOUND)
            done = []


def repeated_from(text: Column, start: Column, period: Column) -> Column:
    """The words of ``text``, those from number ``start`` on replaced by repeats of the ``period`` words there."""
    words = F.filter(F.split(text, BLANK), lambda w: w != "")
    n = F.size(words)
    rounds = F.ceil((n - start) / period).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, start + 1, period), rounds))
    return F.array_join(F.concat(F.slice(words, F.lit(1), start), F.slice(tail, F.lit(1), n - start)), " ")


def periodic_runs(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` as struct ``row`` with ``runs`` (start, length, period) and ``collapsed`` (UTF-8 bytes) for every row."""
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row")
    found = docs.select(row, _periodic(F.encode(F.col(f"`{text_col}`"), "UTF-8")).alias("found"))
    return found.select("row", "found.runs", "found.collapsed")


def strongest(runs: Column) -> Column:
    """Of runs by start, then period, the first with the greatest length over period; null if there is none."""
    more = lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)
    return F.aggregate(runs, F.get(runs, F.lit(0)), more)
