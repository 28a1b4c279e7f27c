"""Stretches of a text that repeat with a period, by an enhanced suffix array.

Each task works on whole texts, so nothing is shuffled. Within a slice of texts:

1. Suffixes are sorted within their text by doubling prefixes. The rank of every place at every doubling
   is kept: equal ranks mean equal words, which gives common prefixes and, to the left, rotations.
2. An LCP interval of depth d holds the suffixes that share their first d words. A square of period d
   that doesn't go on to the right starts at i if i and i+d lie in one interval of depth d, in different
   children. For every suffix of all but the largest child, i+d and i-d are looked up by their place in
   the suffix array. No tree is built: intervals are ranges between smaller LCP values.
3. Such a square is the last one of its run. Rotating it left as long as the words agree gives
   the run's start; runs of multiples of a period have the same ends and are merged into the smallest.

The smaller children of all intervals hold n log n suffixes at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .wordlists import _ranges, joined, word_array
from .words import Slice, slices

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RESULT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def sorted_suffixes(code: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of all texts (suffixes of a text together) and the ranks of each doubling.

    ``code``: a number for each word; ``doc``: its text; ``end``: where that text ends. Places with
    equal rank at doubling k have the same text and the same next 2^k words. Each rank array
    has one more entry, which equals no rank.
    """
    n = len(code)
    key = doc.astype(np.int64) * (int(code.max()) + 1 if n else 1) + code
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.ones(n, bool)
    head[1:] = key[1:] != key[:-1]
    rank = np.full(n + 1, -1, np.int32)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels, h = [rank], 1
    while True:
        single = head & np.append(head[1:], True)
        open_ = np.flatnonzero(~single)
        if not len(open_):
            return order, levels
        at = order[open_]
        ahead = at + h
        inside = ahead < end[at]
        second = np.where(inside, rank[np.where(inside, ahead, n)], -1)
        pair = rank[at].astype(np.int64) * (n + 1) + second + 1
        by = np.argsort(pair, kind="stable")
        at, pair = at[by], pair[by]
        order[open_] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = pair[1:] != pair[:-1]
        head[open_] = fresh
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(fresh, open_, 0))
        levels.append(rank)
        h *= 2


def common(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` (of one text, a != b) share from their start."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        length += (levels[k][a + length] == levels[k][b + length]).astype(np.int64) << k
    return length


def _smaller_before(values: list[int]) -> list[int]:
    """Index of the nearest earlier value below each one; the first value is below all others."""
    found, stack = [0] * len(values), [0]
    for k in range(1, len(values)):
        v = values[k]
        while len(stack) > 1 and values[stack[-1]] >= v:
            stack.pop()
        found[k] = stack[-1]
        stack.append(k)
    return found


def small_children(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(from, to, interval's first, interval's last, depth) of all but the largest child of each interval.

    ``lcp[k]`` belongs to the suffixes k-1 and k; ``lcp[0]`` is 0, and one more 0 ends it. Intervals
    of depth 0 are left out.
    """
    values = lcp.tolist()
    before = np.array(_smaller_before(values), np.int64)
    after = len(values) - 1 - np.array(_smaller_before(values[::-1])[::-1], np.int64)
    k = np.flatnonzero(lcp > 0)
    key = before[k] * (int(lcp.max(initial=0)) + 1) + lcp[k]
    k = k[np.argsort(key, kind="stable")]
    left, depth = before[k], lcp[k]
    first = np.ones(len(k), bool)
    first[1:] = (left[1:] != left[:-1]) | (depth[1:] != depth[:-1])
    group = np.cumsum(first) - 1
    heads = np.flatnonzero(first)
    tails = np.append(heads[1:], len(k)) - 1 if len(heads) else heads
    lo = np.where(first, left, np.append(0, k[:-1])[: len(k)])
    lo = np.concatenate([lo, k[tails]])
    hi = np.concatenate([k, after[k[tails]]])
    of = np.concatenate([group, np.arange(len(heads))])
    by = np.lexsort((lo - hi, of))
    rest = np.ones(len(by), bool)
    rest[:1] = False
    rest[1:] = of[by][1:] == of[by][:-1]  # the first of an interval is its largest child
    by = by[rest]
    own = tails[of[by]]
    return lo[by], hi[by], left[own], after[k[own]] - 1, depth[own]


def find_runs(code: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, smallest period) of the runs of ``least`` words or more, by start, then period.

    ``first[i] .. first[i+1]`` are the words of the i-th text; starts count from the first text's first word.
    """
    n = len(code)
    none = np.zeros(0, np.int64)
    if n < 2:
        return none, none, none
    sizes = np.diff(first)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    begin, end = first[:-1][doc], first[1:][doc]
    order, levels = sorted_suffixes(code, doc, end)
    place = levels[-1]
    lcp = np.zeros(n + 1, np.int64)
    meet = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    lcp[meet] = common(order[meet - 1], order[meet], levels)
    lo, hi, left, right, depth = small_children(lcp)
    child = np.repeat(np.arange(len(lo)), hi - lo)
    suffix = order[lo[child] + _ranges(hi - lo)]
    left, right, depth = left[child], right[child], depth[child]
    squares = []
    for at in (suffix, suffix - depth):
        other = suffix + depth if at is suffix else at
        known = (other >= 0) & (other < n)
        there = place[np.where(known, other, n)]
        ok = known & (there >= left) & (there <= right)
        i, d = at[ok], depth[ok]
        stop = i + 2 * d
        goes_on = (stop < end[i]) & (code[np.minimum(stop, n - 1)] == code[i + d])
        squares.append((i[~goes_on], d[~goes_on]))
    i, d = (np.concatenate(x) for x in zip(*squares))
    start = i.copy()
    for k in range(len(levels) - 1, -1, -1):
        back = start - (1 << k)
        ok = back >= begin[i]
        back = np.where(ok, back, 0)
        ok &= levels[k][back] == levels[k][back + d]
        start = np.where(ok, back, start)
    length = i + 2 * d - start
    ok = length >= least
    start, length, d = start[ok], length[ok], d[ok]
    by = np.lexsort((d, length, start))
    start, length, d = start[by], length[by], d[by]
    new = np.ones(len(by), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, d = start[new], length[new], d[new]
    by = np.lexsort((d, start))
    return start[by], length[by], d[by]


def _slice_runs(s: Slice, least: int) -> tuple[pa.Array, pa.Array]:
    code = word_array(s).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    start, length, period = find_runs(code, s.first, least)
    doc = np.searchsorted(s.first, start, side="right") - 1
    change = np.zeros(len(code) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = joined(s, np.cumsum(change)[:-1] == 0)
    runs = pa.StructArray.from_arrays(
        [pa.array(x, pa.int64()) for x in (start - s.first[doc], length, period)], fields=list(_RUN)
    )
    ends = np.searchsorted(doc, np.arange(len(s.first))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs), kept


def periodic_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period) and collapsed (text) of every row of ``docs``.

    A run is a stretch of consecutive words with smallest period q (words q apart are identical), at
    least max(``least``, 2q) words long, that no neighbouring word extends keeping period q. Runs are
    ordered by start, then period; starts count words from 0. ``collapsed`` joins by one space the
    words that no run contains after its first q words.

    Null, empty and short texts have no runs; a null text has no words. Every row is judged by itself:
    rows that repeat a doc_id or have none give a row each. Overlapping runs of different periods are
    all returned; of runs over the same stretch only the smallest period is one. Other columns are
    ignored. Memory follows the longest text (about 300 bytes a word), not the table.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for s in slices(texts):
                rows = len(s.first) - 1
                runs, kept = _slice_runs(s, least)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(s.row, rows), pa.array(s.counts(), pa.int64()), runs, kept],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(judged, _RESULT)
