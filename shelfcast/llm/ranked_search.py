"""Ranked search of many items at once: what items share is computed once for each document.

1. Items come in blocks of a bounded number of terms. In each block the term sets that items share are
   mined: the terms of an item stand in the order of how many items hold them, and pairs of neighbours
   that two or more items have become a node of their own, again and again. The nodes form a graph:
   leaves are terms, inner nodes add two others, items add the few nodes they were reduced to.
2. One pass over the documents keeps, for each, its length and the counts of the block's terms
   (compared as strings, not by hash). The table is written once; document frequencies and the
   totals are aggregates over it.
3. Each task fills the leaves for a handful of documents, adds up every inner node once, sums the items,
   and keeps each item's best. Scores are 64-bit integers, so any order of adding gives the same sum.
   The tasks' best rows meet in one window an item.

A block's graph is at most a few MB, whatever the tables hold; more items make more blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.indexing import sums_below
from .wordlists import word_array
from .words import NOT_LETTERS, slices, written

#: Terms (with repeats over items) of a block of items; an item of more terms is a block of its own.
BLOCK_TERMS = 1 << 17
#: Sums that a task holds at once, as nodes x documents.
CELLS = 1 << 21
#: Letters, digits and all that isn't ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The apostrophe parts terms here, unlike elsewhere.
BETWEEN = NOT_LETTERS.copy()
BETWEEN[ord("'")] = True

_RESULT = "item_id long, doc_id long, score long"
_GRAPH = (
    "block long, terms array<string>, left array<int>, right array<int>, rounds array<int>, "
    "items array<long>, nodes array<int>, ends array<int>"
)


class Graph(NamedTuple):
    """Nodes ``0 .. len(terms)-1`` are terms; node ``len(terms)+i`` adds nodes ``left[i]`` and ``right[i]``.

    ``rounds``: ends of the ranges of inner nodes that need only earlier ones. Item i adds the nodes
    ``nodes[ends[i-1]:ends[i]]``.
    """

    terms: list[str]
    left: np.ndarray
    right: np.ndarray
    rounds: np.ndarray
    items: np.ndarray
    nodes: np.ndarray
    ends: np.ndarray


def shared_sets(items: np.ndarray, terms: list[list[str]]) -> Graph:
    """The graph of items with the given sets of terms (not empty)."""
    sizes = np.array([len(x) for x in terms], np.int64)
    flat = pa.array([t for own in terms for t in own], pa.string()).dictionary_encode()
    code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(len(terms)), sizes)
    held = np.bincount(code, minlength=len(flat.dictionary))
    by = np.lexsort((code, -held[code], of))
    node, of = code[by], of[by]
    n = len(flat.dictionary)
    left, right, rounds = [], [], []
    while len(node) > 1:
        pair = node[:-1] * n + node[1:]
        pair[of[:-1] != of[1:]] = -1
        kinds, inverse, times = np.unique(pair, return_inverse=True, return_counts=True)
        times[kinds < 0] = 0
        # A pair is taken where its neighbours to both sides are of rarer kinds; the commonest always is.
        order = np.empty(len(kinds), np.int64)
        order[np.lexsort((kinds, times))] = np.arange(len(kinds))
        weight = np.where(times[inverse] > 1, order[inverse] + 1, 0)
        around = np.concatenate([[0], weight, [0]])
        take = (weight > 0) & (weight > around[:-2]) & (weight > around[2:])
        again = np.bincount(inverse[take], minlength=len(kinds))
        take &= again[inverse] > 1
        if not take.any():
            break
        kinds_taken, which = np.unique(pair[take], return_inverse=True)
        left.append(kinds_taken // n)
        right.append(kinds_taken % n)
        at = np.flatnonzero(take)
        node[at] = n + which
        stay = np.ones(len(node), bool)
        stay[at + 1] = False
        node, of = node[stay], of[stay]
        n += len(kinds_taken)
        rounds.append(n)
    whole = lambda x: np.concatenate(x).astype(np.int32) if x else np.zeros(0, np.int32)
    ends = np.searchsorted(of, np.arange(len(terms)), side="right")
    return Graph(
        flat.dictionary.to_pylist(), whole(left), whole(right), np.array(rounds, np.int32),
        np.asarray(items, np.int64), node.astype(np.int32), ends.astype(np.int32),
    )


def _mined(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    table = table.sort_by("item_id")
    g = shared_sets(table.column("item_id").to_numpy(), table.column("terms").to_pylist())
    columns = {"block": pa.array([key[0].as_py()], pa.int64())}
    columns |= {
        name: pa.array([list(value)], pa.list_(kind))
        for name, value, kind in zip(
            Graph._fields, g, [pa.string(), *[pa.int32()] * 3, pa.int64(), pa.int32(), pa.int32()]
        )
    }
    return pa.table(columns)


def _counted(batches, terms: list[str]) -> Iterator[pa.RecordBatch]:
    """Each document's number of terms and its counts of the given ones."""
    known = pa.array(terms, pa.large_string())
    for batch in batches:
        for s in slices(batch.column("text"), between=BETWEEN):
            rows = len(s.first) - 1
            code = pc.index_in(word_array(s, lower=True), value_set=known)
            found = code.is_valid().to_numpy(zero_copy_only=False)
            key = s.doc()[found] * max(len(terms), 1) + code.drop_null().to_numpy(zero_copy_only=False)
            key, times = np.unique(key, return_counts=True)
            ends = np.searchsorted(key // max(len(terms), 1), np.arange(rows + 1)).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32)))
                for x in (key % max(len(terms), 1), times)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(s.row, rows), pa.array(s.counts(), pa.int64()), *lists],
                ["doc_id", "n", "term", "tf"],
            )


class Best:
    """The k best rows of each item, by score, then the smaller doc_id."""

    def __init__(self, items: int, k: int, hold: int = 1 << 20):
        self.k, self.hold = k, hold
        self.least = np.ones(items, np.int64)
        self.rows = [np.zeros((3, 0), np.int64)]
        self.waiting = 0

    def add(self, scores: np.ndarray, doc_id: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        self.rows.append(np.stack([item, scores[item, doc], doc_id[doc]]))
        self.waiting += len(item)
        if self.waiting > self.hold:
            self.settle()

    def settle(self) -> np.ndarray:
        item, score, doc = rows = np.concatenate(self.rows, axis=1)
        rows = rows[:, np.lexsort((doc, -score, item))]
        starts = np.searchsorted(rows[0], rows[0])
        rows = rows[:, np.arange(rows.shape[1]) - starts < self.k]
        item, held = np.unique(rows[0], return_counts=True)
        full = np.cumsum(held)[held == self.k] - 1
        self.least[item[held == self.k]] = rows[1, full]
        self.rows, self.waiting = [rows], 0
        return rows


def _scored(batches, graph: Graph, weight: np.ndarray, total: int, words: int, k: int) -> Iterator[pa.RecordBatch]:
    leaves = len(graph.terms)
    size = leaves + len(graph.left)
    starts = np.append(0, graph.ends[:-1]).astype(np.int64)
    step = max(1, CELLS // max(size, len(graph.nodes), 1))
    best = Best(len(graph.items), k)
    for batch in batches:
        doc_id, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "n"))
        lists = batch.column("term")
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        term = lists.flatten().to_numpy(zero_copy_only=False)
        tf = batch.column("tf").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        m = 50 + (50 * n * total) // max(words, 1)
        doc = np.repeat(np.arange(len(n)), np.diff(ends))
        gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        for row in range(0, len(n), step):
            stop = min(row + step, len(n))
            own = slice(int(ends[row]), int(ends[stop]))
            sums = np.zeros((size, stop - row), np.int64)
            sums[term[own], doc[own] - row] = gain[own]
            done = leaves
            for end in graph.rounds:
                part = slice(done - leaves, end - leaves)
                sums[done:end] = sums[graph.left[part]]
                sums[done:end] += sums[graph.right[part]]
                done = int(end)
            best.add(np.add.reduceat(sums[graph.nodes], starts, axis=0), doc_id[row:stop])
    item, score, doc = best.settle()
    yield pa.RecordBatch.from_arrays(
        [pa.array(graph.items[item], pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
        ["item_id", "doc_id", "score"],
    )


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, terms: the distinct terms of each item, A-Z lower-cased. Items without any are left out."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    text = F.translate(F.col("text").cast("string"), upper, lower)
    return (
        items.select(
            F.col("item_id").cast("long").alias("item_id"),
            F.explode(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("term"),
        )
        .where("item_id IS NOT NULL")
        .groupBy("item_id")
        .agg(F.sort_array(F.collect_set("term")).alias("terms"))
    )


def _in_blocks(terms: DataFrame, block_terms: int) -> DataFrame:
    """``block`` for each item: neighbours by item_id, about ``block_terms`` terms together."""
    total = terms.agg(F.sum(F.size("terms"))).first()[0] or 0
    if total <= block_terms:
        return terms.withColumn("block", F.lit(0).cast("long"))
    below = sums_below(terms.select("item_id", F.size("terms").cast("long").alias("n")), "item_id", ["n"])
    block = F.floor((F.col("below_n") + F.col("n") - 1) / block_terms)
    return terms.join(below.select("item_id", block.alias("block")), "item_id")


def _block(docs: DataFrame, graph: Graph, k: int) -> DataFrame:
    """item_id, doc_id, score: every task's best rows for the items of one block."""
    spark = docs.sparkSession
    counts = docs.mapInArrow(
        lambda batches: _counted(batches, graph.terms), "doc_id long, n long, term array<int>, tf array<int>"
    )
    counts = written(spark, counts, "term-counts")
    held = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    weight = np.zeros(len(graph.terms), np.int64)
    for term, df in counts.select(F.explode("term").alias("term")).groupBy("term").count().collect():
        weight[term] = math.floor(1000 * math.log((2 * held.docs + 2) / (2 * df + 1)))
    # A document without any of the terms scores 0.
    scored = counts.where(F.size("term") > 0)
    return scored.mapInArrow(lambda b: _scored(b, graph, weight, held.docs, held.words, k), _RESULT)


def rank(docs: DataFrame, items: DataFrame, k: int = 50, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents (doc_id, text) of each item (item_id, text).

    Terms are the maximal runs of ASCII letters and digits and of anything not ASCII, with A-Z
    lower-cased. With N documents of at least one term, L terms in them all, n in this one, df documents
    holding a term and tf its occurrences: w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 50 + 50 n N div L,
    and a document scores the sum of w * (10^9 tf div (1000 tf + 20 m)) over the item's distinct terms.
    Rows score above 0; rank counts from 1, equal scores by ascending doc_id.

    Null and empty texts have no terms: such documents count for nothing and such items return no row.
    Rows that repeat a doc_id are documents of their own; rows that repeat an item_id are one item with
    the terms of all. Rows without doc_id or item_id take no part. Either table may be empty. Other
    columns are ignored. A text's terms are counted whole, whatever its length.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id IS NOT NULL")
    blocks = written(spark, _in_blocks(item_terms(items), block_terms), "item-blocks")
    graphs = written(spark, blocks.groupBy("block").applyInArrow(_mined, _GRAPH), "item-graphs")
    rows = []
    for (block,) in graphs.select("block").orderBy("block").collect():
        row = graphs.where(F.col("block") == block).drop("block").first()
        graph = Graph(row.terms, *[np.array(row[c], np.int64) for c in Graph._fields[1:]])
        rows.append(_block(docs, graph, k))
    found = reduce(DataFrame.union, rows) if rows else spark.createDataFrame([], _RESULT)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
