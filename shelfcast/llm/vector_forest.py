"""Nearest vectors by inner product: a forest of random-projection trees with one shared queue.

The trees are built on a bounded sample; every vector is put into its leaf of each tree. A query walks
all trees through one priority queue ordered by the distance to the planes it has not crossed, until
it has opened ``search_leaves`` leaves and these surely hold ``LEAST`` times the vectors it wants; the
vectors of those leaves are ranked exactly.

Vectors get one more coordinate that makes all norms equal, so that nearness in the trees follows the
inner product also where norms differ.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import written

SAMPLE = 20_000
TREES = 8
DEPTH = 7
SEARCH_LEAVES = 144
#: Leaves of one tree share no vector, so those opened in the fullest tree must hold k times this many.
LEAST = 30
#: Vectors ranked together by one task; larger leaves are cut.
BIN_ROWS = 20_000

_FOUND = "query_id long, vec_id long, score double"


class Forest(NamedTuple):
    planes: np.ndarray  # tree, node, coordinate
    cuts: np.ndarray  # tree, node
    depth: int
    norm: float  # the largest of the sample


def lifted(vectors: np.ndarray, norm: float) -> np.ndarray:
    """One more coordinate so that vectors up to ``norm`` long all have that length."""
    rest = np.maximum(norm**2 - (vectors**2).sum(1), 0.0)
    return np.concatenate([vectors, np.sqrt(rest)[:, None]], 1).astype(np.float32)


def plant(sample: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> Forest:
    """Trees whose nodes cut their sample at the median along the line between two of its points."""
    rng = np.random.default_rng(seed)
    norm = float(np.sqrt((sample.astype(float) ** 2).sum(1).max())) if len(sample) else 1.0
    points = lifted(sample, norm)
    width = points.shape[1]
    planes = np.zeros((trees, (1 << depth) - 1, width), np.float32)
    cuts = np.zeros((trees, (1 << depth) - 1), np.float32)
    for t in range(trees):
        node = np.zeros(len(points), int)
        for k in range((1 << depth) - 1):
            own = np.flatnonzero(node == k)
            line = rng.normal(size=width)
            if len(own) > 1:
                a, b = rng.choice(own, 2, replace=False)
                if (points[a] != points[b]).any():
                    line = (points[a] - points[b]).astype(float)
            planes[t, k] = line / np.linalg.norm(line)
            if len(own):
                along = points[own] @ planes[t, k]
                cuts[t, k] = np.median(along)
                node[own] = 2 * k + 1 + (along > cuts[t, k])
    return Forest(planes, cuts, depth, norm)


def leaves(forest: Forest, points: np.ndarray) -> np.ndarray:
    """Leaf of each lifted point in each tree."""
    inner = forest.planes.shape[1]
    out = np.zeros((len(points), len(forest.planes)), np.int32)
    for t, (planes, cuts) in enumerate(zip(forest.planes, forest.cuts)):
        node = np.zeros(len(points), np.int64)
        for _ in range(forest.depth):
            along = np.einsum("ij,ij->i", points, planes[node])
            node = 2 * node + 1 + (along > cuts[node])
        out[:, t] = node - inner
    return out


def search(
    forest: Forest, query: np.ndarray, limit: int, counts: np.ndarray, least: int
) -> list[tuple[int, int]]:
    """(tree, leaf) to open for a query, nearest planes first, in one queue for all trees.

    Stops after ``limit`` leaves, but not before those of some tree hold ``least`` vectors by ``counts``
    (tree, leaf), or all leaves are open.
    """
    inner = forest.planes.shape[1]
    scaled = query * (forest.norm / np.sqrt((query.astype(float) ** 2).sum()))
    side = forest.planes @ np.append(scaled, 0.0).astype(np.float32) - forest.cuts
    queue = [(0.0, t, 0) for t in range(len(side))]
    found: list[tuple[int, int]] = []
    held = [0] * len(side)
    while queue and (len(found) < limit or max(held) < least):
        bound, t, node = heapq.heappop(queue)
        while node < inner:
            along = float(side[t, node])
            near = 2 * node + 1 + (along > 0)
            heapq.heappush(queue, (max(bound, abs(along)), t, 4 * node + 3 - near))
            node = near
        found.append((t, node - inner))
        held[t] += int(counts[t, node - inner])
    return found


def best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best distinct vectors of each query (ties: smaller vec_id)."""
    order = np.lexsort((vec, -score, query))
    q, v = query[order], vec[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (v[1:] != v[:-1])
    order, q = order[fresh], q[fresh]
    first = np.searchsorted(q, q, side="left")
    return order[np.arange(len(q)) - first < k]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part, one per vec_id.

    Left out: null vec_ids; null, empty, zero or differently long vectors; null or non-finite parts.
    The length that most rows have counts (ties: the smaller). Repeated vec_ids: the smallest vector.
    """
    one = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long"), one.cast("array<double>").alias("embedding"))
    finite = F.forall(one, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size(one) > 0) & finite & F.exists(one, lambda x: x != 0))
    common = rows.groupBy(F.size(one).alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not common:
        return rows.limit(0)
    return rows.where(F.size(one) == common[0]["n"]).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def nearest(
    vectors: DataFrame,
    queries: DataFrame | None = None,
    k: int = 20,
    every: int = 20,
    search_leaves: int = SEARCH_LEAVES,
    sample: int = SAMPLE,
    trees: int = TREES,
    depth: int = DEPTH,
    bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest vectors found for each query.

    Queries are the rows whose vec_id is divisible by ``every``, or those of ``queries`` (vec_id).
    A query's own row is no candidate. The forest is built on at most ``sample`` rows, those with the
    smallest hash of their vec_id; all rows are indexed. See ``usable`` for the rows that take part;
    other columns are ignored. Scores are inner products of the vectors themselves in double precision;
    ties go to the smaller vec_id. A query finds ``k`` rows, or all others where there are fewer: up to
    ``LEAST * k`` rows every one is ranked. An empty table, or one without usable rows, has no result.
    """
    spark = vectors.sparkSession
    rows = written(spark, usable(vectors), "forest-vectors")
    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toPandas()
    if not len(taken):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    forest = plant(np.stack(taken["embedding"].to_numpy()), trees, depth)
    per_tree = 1 << depth

    def index(batches):
        for batch in batches:
            if batch.num_rows:
                own = np.stack(batch.column("embedding").to_numpy(zero_copy_only=False))
                leaf = leaves(forest, lifted(own, forest.norm)) + np.arange(trees, dtype=np.int32) * per_tree
                at = np.arange(0, leaf.size + 1, trees, dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(leaf.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["vec_id", "embedding", "leaves"])

    indexed = rows.mapInArrow(index, "vec_id long, embedding array<double>, leaves array<int>")
    in_leaf = indexed.select("vec_id", "embedding", F.explode("leaves").alias("leaf"))
    # At most trees * 2 ** depth counts.
    sizes = indexed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect()
    counts = np.zeros((trees, per_tree), np.int64)
    for r in sizes:
        counts[divmod(r["leaf"], per_tree)] = r["count"]
    least = LEAST * k + 1  # the query's own row is no candidate
    bins, used = {}, 0
    count, fill = 1, 0
    for r in sorted(sizes):
        if fill and fill + r["count"] > bin_rows:
            used, fill = used + count, 0
        count = -(-r["count"] // bin_rows)
        bins[r["leaf"]] = (used, count)
        fill += r["count"]
    starts = spark.createDataFrame(
        [(leaf, at, n) for leaf, (at, n) in bins.items()], "of_leaf int, bin int, parts int"
    )
    placed = in_leaf.join(F.broadcast(starts), F.col("leaf") == F.col("of_leaf")).select(
        (F.col("bin") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).cast("int").alias("bin"),
        "leaf", "vec_id", "embedding",
    )
    if queries is None:
        asked = rows.where(F.col("vec_id") % every == 0)
    else:
        asked = rows.join(queries.select(F.col("vec_id").cast("long")).distinct(), "vec_id")

    def open_leaves(batches):
        for batch in batches:
            lists, own_bins, at = [], [], []
            for i, q in enumerate(batch.column("embedding").to_numpy(zero_copy_only=False)):
                opened: dict[int, list[int]] = {}
                for t, leaf in search(forest, np.asarray(q), search_leaves, counts, least):
                    first, n = bins.get(t * per_tree + leaf, (0, 0))
                    for b in range(first, first + n):
                        opened.setdefault(b, []).append(t * per_tree + leaf)
                for b, found in opened.items():
                    at.append(i)
                    own_bins.append(b)
                    lists.append(found)
            picked = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own_bins, pa.int32()), *picked.columns, pa.array(lists, pa.list_(pa.int32()))],
                ["bin", "query_id", "embedding", "leaves"],
            )

    questions = asked.mapInArrow(
        open_leaves, "bin int, query_id long, embedding array<double>, leaves array<int>"
    )

    def rank(own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(ask):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x, leaf, vec = np.stack(own["embedding"].to_numpy()), own["leaf"].to_numpy(), own["vec_id"].to_numpy()
        y, ids = np.stack(ask["embedding"].to_numpy()), ask["query_id"].to_numpy()
        flat = np.concatenate(ask["leaves"].to_numpy())
        who = np.repeat(np.arange(len(ask)), ask["leaves"].map(len))
        parts = []
        for one in np.unique(flat):
            rows_, asks = np.flatnonzero(leaf == one), who[flat == one]
            if not len(rows_):
                continue
            for block in range(0, len(asks), 512):
                some = asks[block : block + 512]
                near = y[some] @ x[rows_].T
                near[ids[some][:, None] == vec[rows_][None, :]] = -np.inf
                if near.shape[1] > k:
                    edge = np.partition(near, -k, axis=1)[:, -k][:, None]
                    # Ties may differ in the last bits here; the exact scores below decide.
                    keep = near >= edge - 1e-9 * (1 + np.abs(edge))
                else:
                    keep = near > -np.inf
                keep &= near > -np.inf
                a, b = np.nonzero(keep)
                parts.append((some[a], rows_[b]))
        if not parts:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        who, which = (np.concatenate(p) for p in zip(*parts))
        score = np.concatenate(
            [(y[who[i : i + 65536]] * x[which[i : i + 65536]]).sum(1) for i in range(0, len(who), 65536)]
        )
        top = best(ids[who], vec[which], score, k)
        return pd.DataFrame({"query_id": ids[who][top], "vec_id": vec[which][top], "score": score[top]})

    near = placed.groupBy("bin").cogroup(questions.groupBy("bin")).applyInPandas(rank, _FOUND)
    # Lists of at most k per bin meet here; a query's lists come from at most search_leaves bins.
    listed = near.groupBy("query_id").agg(
        F.collect_set(F.struct((-F.col("score")).alias("less"), "vec_id")).alias("found")
    )
    top = F.slice(F.array_sort("found"), 1, k)
    return listed.select("query_id", F.posexplode(top)).select(
        "query_id",
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("col.vec_id").alias("vec_id"),
        (-F.col("col.less")).alias("score"),
    )

