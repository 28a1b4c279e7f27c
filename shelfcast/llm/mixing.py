"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Targets share the corpus by weight; a source stops at ``most`` times its size and the excess is
reshared. The total is cut into blocks of ``block`` words, which sources get by highest quotients
target / (2 q + 1); a source's blocks go to its shards in the same way, by the shards' sizes. A shard
lays its documents out in a seeded order, takes every block as often as its quota allows for all of
them, and the rest of the quota by a seeded ranking of the blocks. Part blocks, at a shard's end and of
the target, are settled in words, so that a source gives its target to the word.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .words import mixed, slices, written

BLOCK = 32
#: A source is cut into shards of at least so many words, and the corpus into at most MAX_SHARDS more
#: shards than sources.
SHARD_WORDS = 500_000
MAX_SHARDS = 16_384
#: A row counts as so many words when shards are sized, so that empty texts are spread as well.
ROW_WORDS = 64
MAX_SOURCES = 100_000

PLAN = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()),
        T.StructField("taken", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)


def shares(
    sizes: Sequence[int], weights: Sequence[float], share: float = 1.0, most: float = 3.0
) -> list[float]:
    """Target of each source: ``share`` of all sizes by weight, none above ``most`` times its size."""
    left, open_, out = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        each = left / sum(weights[i] for i in open_)
        full = [i for i in sorted(open_) if weights[i] * each > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * each
            break
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
            open_.discard(i)
        left = max(left, 0.0)
    return out


def apportion(claims: Sequence[float], seats: int) -> list[int]:
    """Sainte-Laguë: each seat to the highest claim / (2 q + 1); ties to the earlier claim.

    Starts from the claims rounded at the average price of a seat, which is the outcome of some
    number of seats near ``seats``, and gives or takes the few that differ.
    """
    total = sum(claims)
    if total <= 0 or seats <= 0:
        return [0] * len(claims)
    got = [max(0, int(np.ceil(c * seats / total - 0.5))) for c in claims]
    short = seats - sum(got)
    if short > 0:
        heap = [(-c / (2 * q + 1), i) for i, (c, q) in enumerate(zip(claims, got)) if c > 0]
        heapq.heapify(heap)
        for _ in range(short):
            _, i = heap[0]
            got[i] += 1
            heapq.heapreplace(heap, (-claims[i] / (2 * got[i] + 1), i))
    elif short < 0:
        heap = [(c / (2 * q - 1), -i) for i, (c, q) in enumerate(zip(claims, got)) if q]
        heapq.heapify(heap)
        for _ in range(-short):
            _, i = heap[0]
            got[-i] -= 1
            if got[-i]:
                heapq.heapreplace(heap, (claims[-i] / (2 * got[-i] - 1), i))
            else:
                heapq.heappop(heap)
    return got


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and the number of words of each text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.zeros(batch.num_rows, np.int64)
            for s in slices(batch.column("text")):
                size[s.row : s.row + len(s.first) - 1] = s.counts()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), pa.array(size)],
                ["doc_id", "source", "size"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")
    )
    return rows.mapInArrow(count, "doc_id long, source string, size long")


def settle(quotas: Sequence[int], sizes: Sequence[int], target: int, block: int, most: int) -> list[int]:
    """Words that each shard gives: its blocks, then what the source lacks of ``target`` or has beyond it.

    A shard gives at most ``most`` times its size, so quotas alone miss the target by part blocks; the
    difference goes to the shards in order, as far as they have room.
    """
    words = [min(q * block, most * size) for q, size in zip(quotas, sizes)]
    rest = target - sum(words)
    for i, size in enumerate(sizes):
        step = max(-words[i], min(most * size - words[i], rest))
        words[i] += step
        rest -= step
    return words


def take_blocks(sizes: np.ndarray, words: int, block: int, most: int, seed: int):
    """Words of each document, in the given order, that make up ``words`` words of the shard.

    Every block is taken as often as ``words`` allows for all of them, then once more by a seeded
    ranking; of the last one only as many words as are left. Returns the words taken by document, and
    the pieces (document, begin, end, times) they lie in.
    """
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    count = -(-total // block)
    none = np.zeros(0, np.int64)
    if not total or words <= 0:
        return np.zeros(len(sizes), np.int64), none, none, none, none
    rounds, extra = divmod(words, total)
    if rounds >= most:
        rounds, extra = most, 0
    rank = np.argsort(mixed(np.arange(count, dtype=np.uint64) + np.uint64(seed % (1 << 63))), kind="stable")
    length = np.full(count, block, np.int64)
    length[-1] = total - (count - 1) * block
    upto = np.cumsum(length[rank])
    whole = int(np.searchsorted(upto, extra, side="right"))
    # Words from its beginning that each block gives once more.
    more = np.zeros(count, np.int64)
    more[rank[:whole]] = length[rank[:whole]]
    if whole < count:
        more[rank[whole]] = extra - (int(upto[whole - 1]) if whole else 0)
    begins = ends - sizes
    edges = np.arange(count, dtype=np.int64) * block
    part = np.flatnonzero((more > 0) & (more < length))
    cuts = np.unique(np.concatenate([begins[sizes > 0], edges, edges[part] + more[part]]))
    stops = np.append(cuts[1:], total)
    doc = np.searchsorted(ends, cuts, side="right")
    each = rounds + (cuts - edges[cuts // block] < more[cuts // block])
    taken = np.bincount(doc, weights=each * (stops - cuts), minlength=len(sizes)).astype(np.int64)
    on = each > 0
    return taken, doc[on], (cuts - begins[doc])[on], (stops - begins[doc])[on], each[on]


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    share: float = 1.0,
    most: int = 3,
    block: int = BLOCK,
    shard_words: int = SHARD_WORDS,
    seed: int = 7,
    with_spans: bool = True,
) -> DataFrame:
    """Plan of the mix: per row of ``docs`` its source's target and the words taken from its text.

    ``docs`` needs doc_id, source and text; other columns are ignored. Sources in code point order,
    null last, take the ``weights`` in turn, repeating. ``spans`` lists [first word, word after the
    last, times] of what is taken; the times add up to at most ``most`` for each word.

    A null or empty text has size 0 and gives nothing. Repeated rows and null doc_ids are documents
    of their own. An empty table gives an empty plan. Sources are configuration: more than
    ``MAX_SOURCES`` of them raise an error. A large source has many shards, so no task depends on
    one source; shards hold at least ``shard_words`` words. A source gives its target, rounded to words,
    however small it is (never more than ``most`` times its size). Results depend on
    doc_id, source and text alone, so reruns agree.
    """
    spark = docs.sparkSession
    sizes = written(spark, sized(docs), "mix-sizes")
    totals = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
        .limit(MAX_SOURCES + 1)
        .collect()
    )
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; map them to fewer before mixing")
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    if not totals:
        return spark.createDataFrame([], PLAN)
    own = [r["size"] for r in totals]
    load = sum(own) + ROW_WORDS * sum(r["rows"] for r in totals)
    shard_words = max(shard_words, -(-load // MAX_SHARDS))
    targets = shares(own, [weights[i % len(weights)] for i in range(len(own))], share, most)
    seats = apportion(targets, round(sum(targets) / block))
    about = spark.createDataFrame(
        [
            (r["source"], i, r["size"], t, 1 + (r["size"] + ROW_WORDS * r["rows"]) // shard_words)
            for i, (r, t) in enumerate(zip(totals, targets))
        ],
        "of string, number int, source_size long, target double, shards long",
    )
    order = F.xxhash64("doc_id", "size", F.lit(seed))
    placed = (
        sizes.join(F.broadcast(about), sizes["source"].eqNullSafe(about["of"]))
        .drop("of")
        .withColumn("order", order)
        .withColumn("shard", F.pmod(F.xxhash64("order", F.lit(seed + 1)), "shards"))
    )
    parts: dict[int, list[tuple[int, int]]] = {}
    for r in placed.groupBy("number", "shard").agg(F.sum("size").alias("size")).collect():
        parts.setdefault(r["number"], []).append((r["shard"], r["size"]))
    quota = {}
    for number, rows in parts.items():
        rows.sort()
        held = [s for _, s in rows]
        words = settle(apportion(held, seats[number]), held, round(targets[number]), block, most)
        for (shard, _), q in zip(rows, words):
            quota[number, shard] = q

    def select(table: pa.Table) -> pa.Table:
        table = table.sort_by(
            [("order", "ascending"), ("doc_id", "ascending"), ("size", "ascending")]
        )
        number, shard = table["number"][0].as_py(), table["shard"][0].as_py()
        size = table["size"].to_numpy()
        taken, doc, begin, end, times = take_blocks(
            size, quota.get((number, shard), 0), block, most, seed * 1_000_003 + number * 8191 + shard
        )
        if not with_spans:
            doc = doc[:0]
        at = np.searchsorted(doc, np.arange(len(size) + 1))
        n = len(doc)
        flat = np.stack([begin[:n], end[:n], times[:n]], 1).reshape(-1)
        triples = pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * n + 1, 3, np.int32)), pa.array(flat))
        spans = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), triples)
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "source": table["source"],
                "size": table["size"],
                "source_size": table["source_size"],
                "target": table["target"],
                "taken": pa.array(taken),
                "spans": spans,
            }
        )

    return placed.groupBy("number", "shard").applyInArrow(select, PLAN)
