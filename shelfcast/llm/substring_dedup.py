"""Repeated passages by suffix trees over prefix-partitioned suffixes.

A suffix is a text from one of its words on. Only the first ``window`` words of a suffix decide whether
its passage starts earlier elsewhere, so trees are built that deep. Three steps:

1. Each window of words has an anchor, its smallest ``SEED``-gram by hash; equal windows have equal
   anchors. Anchors that occur once in the corpus rule their windows out.
2. The suffixes left are range-partitioned by their path (hashes of the first word, of the first three,
   of the whole window). Spark chooses the bounds from the data: rare prefixes share a partition,
   common ones are cut further down, so groups fit in memory. In the sorted order of a partition
   the nodes of its subtree are runs of equal paths, and an internal node at the window's depth is a
   passage that repeats: its first suffix stays, the windows of the others are marked.
3. Marks meet their documents, and the words they cover go.

Copies within one batch of rows are settled before any shuffle, so that a passage of millions of
documents reaches its partition once a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .words import Slice, grams, mixed, signed, slices, whole, written

WINDOW = 20
SEED = 6

#: ``path`` orders suffixes as their tree does and ends in half of the window's hash, ``tail`` is the
#: other half; ``place`` packs the first word (high 32 bits) and, for windows already settled, how
#: many follow each other from there.
_SUFFIX = "path long, tail int, doc_id long, place long"
_HALF = np.uint64(0xFFFFFFFF)


def anchors(s: Slice, h: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of the windows of each text, word of each one's anchor, seed hashes of all words)."""
    at = whole(s.first, window)
    low = grams(h, seed)
    if not len(at):
        return at, at, low
    least, where, reach = low, np.arange(len(low)), 1
    span = window - seed + 1
    while reach < span:
        step = min(reach, span - reach)
        left, right = least[: len(least) - step], least[step:]
        where = np.where(right < left, where[step:], where[: len(where) - step])
        least = np.minimum(left, right)
        reach += step
    return at, where[at], low


def _anchor_rows(batches, window: int, seed: int) -> Iterator[pa.RecordBatch]:
    """One row an anchor. ``known``: its seed occurs elsewhere in the batch; all but one of those get a
    key of their own, as nothing is left to find out for them."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        keys, docs, words = [], [], []
        for s in slices(batch.column("text")):
            h = s.hashes()
            _, where, low = anchors(s, h, window, seed)
            where = np.unique(where)
            doc = np.searchsorted(s.first, where, side="right") - 1
            keys.append(low[where])
            docs.append(ids[s.row + doc])
            words.append(where - s.first[doc])
        if not keys:
            continue
        key, doc, word = (np.concatenate(x) for x in (keys, docs, words))
        if not len(key):
            continue
        order = np.argsort(key, kind="stable")
        key, doc, word = key[order], doc[order], word[order]
        again = np.zeros(len(key), bool)
        again[1:] = key[1:] == key[:-1]
        known = again.copy()
        known[:-1] |= again[1:]
        key[again] = mixed(key[again] ^ mixed(doc[again].astype(np.uint64) * np.uint64(31) + word[again].astype(np.uint64)))
        yield pa.RecordBatch.from_arrays(
            [signed(key), pa.array(doc, pa.int64()), pa.array(word, pa.int32()), pa.array(known)],
            ["key", "doc_id", "word", "known"],
        )


def _suffix_rows(batches, window: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Suffixes whose window has a repeated anchor; runs of windows that repeat within the batch."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        marks = batch.column("words")
        flat = marks.flatten().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(marks.value_lengths().to_numpy(zero_copy_only=False))])
        paths, tails, docs, starts = [], [], [], []
        for s in slices(batch.column("text")):
            h = s.hashes()
            at, where, _ = anchors(s, h, window, seed)
            if not len(at):
                continue
            n = len(s.first) - 1
            own = slice(int(ends[s.row]), int(ends[s.row + n]))
            marked = np.zeros(len(h) + 1, bool)
            base = np.repeat(s.first[:-1], np.diff(ends[s.row : s.row + n + 1]))
            marked[np.minimum(base + flat[own], len(h))] = True
            at = at[marked[where]]
            tail = grams(h, window)[at]
            top = np.uint64(0xFFFF)
            path = (h[at] & (top << np.uint64(48))) | ((grams(h, 3)[at] >> np.uint64(48)) << np.uint64(32)) | (tail >> np.uint64(32))
            doc = np.searchsorted(s.first, at, side="right") - 1
            paths.append(path)
            tails.append(tail)
            docs.append(ids[s.row + doc])
            starts.append(at - s.first[doc])
        if not paths:
            continue
        path, tail, doc, start = (np.concatenate(x) for x in (paths, tails, docs, starts))
        order = np.lexsort((start, doc, tail, path))
        path, tail, doc, start = path[order], tail[order], doc[order], start[order]
        fresh = np.ones(len(path), bool)
        fresh[1:] = (path[1:] != path[:-1]) | (tail[1:] != tail[:-1])
        again = later(fresh, doc, start)
        d, w, run = runs(doc[again], start[again])
        spread = mixed(d.astype(np.uint64) + (w.astype(np.uint64) << np.uint64(32)))
        both = lambda a, b: np.concatenate([a[fresh], b])
        yield pa.RecordBatch.from_arrays(
            [
                signed(both(path, spread)),
                pa.array((both(tail, spread) & _HALF).astype(np.uint32).view(np.int32)),
                pa.array(both(doc, d), pa.int64()),
                pa.array(np.concatenate([start[fresh] << 32, (w << 32) | run]), pa.int64()),
            ],
            ["path", "tail", "doc_id", "place"],
        )


def runs(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive starts of a document as (doc, first start, length)."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    head = np.ones(len(doc), bool)
    head[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
    at = np.flatnonzero(head)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], start[last] - start[at] + 1 if len(at) else start[:0]


def later(head: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rows elsewhere than the head of their run; the same row twice is one document, not two."""
    first = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
    return (doc != doc[first]) | (start != start[first])


def _repeats(batches) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes of a partition: windows of all but the first suffix of each deep node."""
    node, place = None, (0, 0)
    for batch in batches:
        path, tail, doc, place_ = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("path", "tail", "doc_id", "place")
        )
        start, run = place_ >> 32, place_ & 0xFFFFFFFF
        if not len(path):
            continue
        head = np.ones(len(path), bool)
        head[1:] = (path[1:] != path[:-1]) | (tail[1:] != tail[:-1])
        again = later(head, doc, start)
        if (path[0], tail[0]) == node:  # goes on from the batch before
            same = slice(0, int(np.append(np.flatnonzero(head)[1:], len(head))[0]))
            again[same] = (doc[same] != place[0]) | (start[same] != place[1])
        else:
            place = (doc[0], start[0])
        if head[1:].any():
            last = int(np.flatnonzero(head)[-1])
            place = (doc[last], start[last])
        node = (path[-1], tail[-1])
        on = again & (run == 0)
        d, w, n = runs(doc[on], start[on])
        known = run > 0
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([d, doc[known]]), pa.int64()),
                pa.array(np.concatenate([w, start[known]]), pa.int32()),
                pa.array(np.concatenate([n, run[known]]), pa.int32()),
            ],
            ["doc_id", "start", "run"],
        )


def repeated_windows(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """doc_id, start, run: windows from word ``start`` on, ``run`` of them, that start earlier elsewhere.

    Earlier: in a smaller doc_id, or before in the same document. ``docs``: doc_id not null, text.
    """
    found = docs.mapInArrow(
        lambda b: _anchor_rows(b, window, seed), "key long, doc_id long, word int, known boolean"
    )
    times = F.count("*").over(Window.partitionBy("key"))
    marks = (
        found.withColumn("times", times)
        .where("known OR times > 1")
        .groupBy("doc_id")
        .agg(F.collect_set("word").alias("words"))
    )
    spark = docs.sparkSession
    suffixes = (
        docs.join(written(spark, marks, "anchors"), "doc_id")
        .select("doc_id", "text", "words")
        .mapInArrow(lambda b: _suffix_rows(b, window, seed), _SUFFIX)
    )
    trees = suffixes.repartitionByRange("path", "tail").sortWithinPartitions("path", "tail", "doc_id", "place")
    return trees.mapInArrow(_repeats, "doc_id long, start int, run int")


def without_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed and kept (text) of every row of ``docs`` (doc_id, text).

    A word goes if a window of ``window`` words covers it whose words also start earlier: in a smaller
    doc_id, or before in the same document. Windows are judged on the texts as they came. ``kept``
    joins the words left by one space.

    A null, empty or short text keeps all its words. Rows that repeat a doc_id are one document; its
    texts should be the same (each is judged, and a removed window goes from all of them). Rows
    without doc_id take no part and keep their words. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    named = docs.where("doc_id IS NOT NULL")
    cuts = (
        repeated_windows(named, window, seed)
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("start", "run")).alias("cuts"))
    )
    cuts = written(docs.sparkSession, cuts, "repeated-windows")
    with_cuts = named.join(cuts, "doc_id", "left").select("doc_id", "text", "cuts")
    nameless = docs.where("doc_id IS NULL").select("doc_id", "text", F.lit(None).cast(cuts.schema["cuts"].dataType).alias("cuts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept = [], [], []
            for text, own in zip(batch.column("text"), batch.column("cuts")):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                total.append(len(words))
                removed = 0
                if own.is_valid:
                    change = np.zeros(len(words) + 1, np.int64)
                    start, run = (own.values.field(c).to_numpy(zero_copy_only=False) for c in ("start", "run"))
                    inside = start < len(words)
                    np.add.at(change, start[inside], 1)
                    np.add.at(change, np.minimum(start + run + window - 1, len(words))[inside], -1)
                    keep = np.cumsum(change)[:-1] == 0
                    removed = len(words) - int(keep.sum())
                    words = list(compress(words, keep))
                gone.append(removed)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(total, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return with_cuts.union(nameless).mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept string"
    )
