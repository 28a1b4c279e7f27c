"""Benchmark leaks in training texts: n-gram seeds find candidates, Smith-Waterman scores them.

The test items are read in blocks of bounded size. Every n-gram of an item is a seed. For each block one
pass over the corpus finds the seeds in the texts, leaves out items of which a text has too few words,
cuts out the passage around the seeds and aligns it with the item. The pass is narrow: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import NOT_LETTERS, grams, slices

N = 3
THRESHOLD = 0.5
#: Bytes of test items that are searched for at once.
BLOCK_BYTES = 8 << 20
MATCH, MISMATCH, GAP = 2.0, -1.0, 1.0
_BITS = 20

_LEAKS = "array<struct<item_id:bigint,score:double,first_word:int,last_word:int>>"
_LEAK_TYPE = pa.list_(
    pa.struct(
        [("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int32()), ("last_word", pa.int32())]
    )
)


class Items(NamedTuple):
    """Test items and their n-grams: ``keys[k]`` is in the items ``item[first[k] : first[k + 1]]``."""

    ids: np.ndarray
    words: list[np.ndarray]
    keys: np.ndarray
    first: np.ndarray
    item: np.ndarray
    maybe: np.ndarray


def _indexed(ids: np.ndarray, words: list[np.ndarray], n: int) -> Items:
    own = [item_grams(w, n) for w in words]
    table = np.zeros(sum(map(len, own)), dtype=[("k", "u8"), ("i", "i8")])
    if own:
        table["k"], table["i"] = np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own])
    table = np.unique(table)
    keys, first = np.unique(table["k"], return_index=True)
    maybe = np.zeros(1 << _BITS, bool)
    maybe[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    return Items(ids, words, keys, np.append(first, len(table)), table["i"], maybe)


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (count[0] of them), begin[1], ..."""
    return np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())


def item_grams(words: np.ndarray, n: int) -> np.ndarray:
    """n-grams of an item; one of fewer than ``n`` words has none."""
    return grams(words, n)


def find(items: Items, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key number) of the n-grams that are keys."""
    if not len(items.keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(items.maybe[(runs >> np.uint64(64 - _BITS)).astype(np.int64)])
    number = np.minimum(np.searchsorted(items.keys, runs[at]), len(items.keys) - 1)
    hit = items.keys[number] == runs[at]
    return at[hit], number[hit]


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment: (score, first word, last word of ``text``). Linear gaps.

    Row by row; along a row the best gap is a running maximum.
    """
    width = len(text)
    ramp = np.arange(1, width + 1) * GAP
    score = np.zeros(width + 1)
    begin = np.arange(width + 1)
    top, end, start = 0.0, -1, -1
    for word in item:
        diagonal = score[:-1] + np.where(text == word, MATCH, MISMATCH)
        above = score[1:] - GAP
        best = np.maximum(diagonal, above)
        origin = np.where(diagonal >= above, begin[:-1], begin[1:])
        fresh = best <= 0
        best[fresh] = 0.0
        origin[fresh] = np.arange(1, width + 1)[fresh]
        lifted = best + ramp
        run = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted >= run, np.arange(width), 0))
        along = run - ramp
        better = along > best
        origin = np.where(better, origin[source], origin)
        score[1:] = np.where(better, along, best)
        begin[1:] = origin
        j = int(score.argmax())
        if score[j] > top:
            top, end, start = float(score[j]), j - 1, int(begin[j])
    return top, start, end


def _leaks(h: np.ndarray, items: Items, n: int, threshold: float) -> list[tuple[int, float, int, int]]:
    """Leaks in one text: (item, score, first word, last word), the best of each item."""
    at, number = find(items, grams(h, n))
    if not len(at):
        return []
    # The hits are grouped by n-gram, so that a common one is looked up once for each item.
    order = np.argsort(number, kind="stable")
    at, number = at[order], number[order]
    keys = np.unique(number)
    who = np.unique(items.item[_ranges(items.first[keys], items.first[keys + 1] - items.first[keys])])
    # No alignment beats a match for every word that both have.
    sizes = np.array([len(items.words[i]) for i in who])
    both = np.isin(np.concatenate([items.words[i] for i in who]), h)
    who = who[np.add.reduceat(both.astype(np.int64), np.cumsum(sizes) - sizes) >= threshold * sizes]
    found = []
    for i in who:
        own = items.words[i]
        slack = 5 + len(own) // 3
        mine = np.searchsorted(items.keys, item_grams(own, n))
        begin = np.searchsorted(number, mine)
        count = np.searchsorted(number, mine, side="right") - begin
        spots = np.unique(at[_ranges(begin, count)] - np.repeat(np.arange(len(mine)), count))
        begin = np.maximum(spots - slack, 0)
        end = np.minimum(spots + len(own) + slack, len(h))
        best: tuple[float, int, int] = (0.0, -1, -1)
        k = 0
        while k < len(begin):
            lo, hi = begin[k], end[k]
            while k + 1 < len(begin) and begin[k + 1] < hi:
                k += 1
                hi = max(hi, end[k])
            k += 1
            text = h[lo:hi]
            if np.isin(own, text).sum() < threshold * len(own):
                continue
            score, first, last = align(own, text)
            if score > best[0]:
                best = (score, int(lo + first), int(lo + last))
        share = best[0] / (MATCH * len(own))
        if share >= threshold:
            found.append((int(i), share, best[1], best[2]))
    return found


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = N,
    threshold: float = THRESHOLD,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``leaks``: the items found in each text, with score and word range.

    The score is the alignment's share of a perfect one: 1 for an item that is there as it is. Words
    are runs of letters and digits, A-Z lower-cased; word numbers count those. Leaks are ordered by
    item_id, one for each item (its best passage).

    An item is found in a text that has any ``n`` neighbouring words of it unchanged; a copy whose every
    run of ``n`` words is broken (every third word changed, at n=3) is not looked at.

    A null or empty text has no leaks. Items that are null, empty or shorter than ``n`` words, or have
    no item_id, match nothing; an item_id with several texts is found by any of them. Repeated rows
    get the same leaks; other columns pass through (one named leaks is replaced).
    ``keep_text=False`` leaves the text out of the result.
    """
    spark = docs.sparkSession
    base = docs.drop("leaks").withColumn("text", F.col("text").cast("string"))
    base = base.withColumn("leaks", F.array().cast(_LEAKS))
    tests = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long"), F.col("text").cast("string")
    ).distinct()
    size = tests.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = 1 + size // BLOCK_BYTES
    for block in range(blocks):
        part = tests if blocks == 1 else tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted(part.collect())  # about BLOCK_BYTES of text
        if not rows:
            continue
        words: list[np.ndarray] = []
        for s in slices(pa.array([r["text"] for r in rows]), between=NOT_LETTERS):
            h = s.hashes(lower=True)
            words += [h[s.first[i] : s.first[i + 1]] for i in range(len(s.first) - 1)]
        ids = np.array([r["item_id"] for r in rows])
        base = _search(base, ids, words, n, threshold)
    if not keep_text:
        base = base.drop("text")
    return base


def _search(docs: DataFrame, ids: np.ndarray, words: list[np.ndarray], n: int, threshold: float) -> DataFrame:
    items = _indexed(ids, words, n)
    if not len(items.keys):
        return docs
    names = [f.name for f in docs.schema]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaks = batch.column("leaks").to_pylist()
            for s in slices(batch.column("text"), between=NOT_LETTERS):
                h = s.hashes(lower=True)
                at, _ = find(items, grams(h, n))
                for d in np.unique(np.searchsorted(s.first, at, side="right") - 1):
                    own = h[s.first[d] : s.first[d + 1]]
                    found = _leaks(own, items, n, threshold)
                    if found:
                        best = {x["item_id"]: x for x in leaks[s.row + d]}
                        for i, share, first, last in found:
                            new = {"item_id": int(ids[i]), "score": share, "first_word": first, "last_word": last}
                            if new["item_id"] not in best or best[new["item_id"]]["score"] < share:
                                best[new["item_id"]] = new
                        leaks[s.row + d] = [best[k] for k in sorted(best)]
            columns = [pa.array(leaks, _LEAK_TYPE) if c == "leaks" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(search, fields)
