"""Document scores by masked pseudo-likelihood: each word predicted from the words on both sides.

The corpus is counted first: hashed words to counts, over all documents. The commonest words get
classes of their own and the others share the rest, in order of frequency. A network of one hidden
layer sees the classes of ``SIDE`` words left and right of a hidden word and predicts its class; the
word within its class has its share of the class's count. A document's score is the sum of the log
probabilities of its words.

Every position of all documents is a training example, once. Texts are cut into pieces, and the pieces
are dealt by a hash of their row and place to ``ROUNDS`` rounds of shards of about ``SHARD`` examples.
The shards of a round are trained in parallel from common weights, which are then averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import Slice, mixed, slices, unsigned, written

BUCKET_BITS = 18
CLASSES = 256
OWN = 192
SIDE = 3
HIDDEN = 16
EVERY = 1
SHARD = 400_000
ROUNDS = 3
EDGE = CLASSES  # stands for what lies outside the text
#: Words of a text that are dealt together.
PIECE = 32
_TOKENS = 1024
#: Shards whose weights are summed by one task before the driver sees them.
_SUMS = 32


class Model(NamedTuple):
    classes: np.ndarray  # of each word bucket
    within: np.ndarray  # log share of each bucket in its class
    near: np.ndarray  # side word, class or EDGE, hidden unit
    bias: np.ndarray
    out: np.ndarray  # hidden unit, class
    base: np.ndarray


def buckets(s: Slice) -> np.ndarray:
    return (s.hashes(lower=True) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def contexts(first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Classes of the SIDE words before and after each word of its text."""
    n = len(classes)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.full((n, 2 * SIDE), EDGE, np.int16)
    for j, step in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        at = np.arange(max(0, -step), min(n, n - step))
        at = at[doc[at] == doc[at + step]]
        out[at, j] = classes[at + step]
    return out


def classed(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each bucket, and the log of its share in the class. A bucket never seen counts once."""
    counts = np.maximum(counts, 1)
    order = np.argsort(-counts, kind="stable")
    classes = np.zeros(len(counts), np.int16)
    classes[order[:OWN]] = np.arange(min(OWN, len(order)))
    rest = order[OWN:]
    share = np.cumsum(counts[rest])
    if len(rest):
        band = (share - 1) * (CLASSES - OWN) // share[-1]
        classes[rest] = OWN + np.minimum(band, CLASSES - OWN - 1)
    total = np.bincount(classes, weights=counts, minlength=CLASSES)
    return classes, np.log(counts / total[classes])


def start(counts: np.ndarray, seed: int = 5) -> Model:
    classes, within = classed(counts)
    rng = np.random.default_rng(seed)
    total = np.bincount(classes, weights=np.maximum(counts, 1), minlength=CLASSES) + 1.0
    return Model(
        classes,
        within,
        rng.normal(0, 0.1, (2 * SIDE, CLASSES + 1, HIDDEN)).astype(np.float32),
        np.zeros(HIDDEN, np.float32),
        rng.normal(0, 0.1, (HIDDEN, CLASSES)).astype(np.float32),
        np.log(total / total.sum()).astype(np.float32),
    )


def packed(m: Model) -> np.ndarray:
    return np.concatenate([x.reshape(-1) for x in (m.near, m.bias, m.out, m.base)]).astype(np.float32)


def unpacked(m: Model, flat: np.ndarray) -> Model:
    parts, at = [], 0
    for x in (m.near, m.bias, m.out, m.base):
        parts.append(flat[at : at + x.size].reshape(x.shape).astype(np.float32))
        at += x.size
    return Model(m.classes, m.within, *parts)


def hidden(m: Model, near: np.ndarray) -> np.ndarray:
    total = m.bias + m.near[0][near[:, 0]]
    for j in range(1, 2 * SIDE):
        total += m.near[j][near[:, j]]
    return np.tanh(total)


def class_log_probability(m: Model, near: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log probability of the classes ``target`` between the classes ``near``."""
    out = np.empty(len(target), np.float64)
    for i in range(0, len(target), _TOKENS):
        h = hidden(m, near[i : i + _TOKENS])
        logits = h @ m.out
        logits += m.base
        own = logits[np.arange(len(h)), target[i : i + _TOKENS]].astype(np.float64)
        # Weights are small, so the sum cannot overflow; the guard is for safety.
        np.minimum(logits, 80.0, out=logits)
        np.exp(logits, out=logits)
        out[i : i + _TOKENS] = own - np.log(logits.sum(1).astype(np.float64))
    return out


def fit(m: Model, examples: np.ndarray, rate: float = 0.05, batch: int = 512) -> Model:
    """One pass of Adagrad over ``examples`` (2 * SIDE context classes, target class), in their order."""
    near, bias, out, base = (x.copy() for x in (m.near, m.bias, m.out, m.base))
    moved = [np.full_like(x, 1e-2) for x in (near, bias, out, base)]
    units = np.arange(HIDDEN)
    rows = np.arange(2 * SIDE) * (CLASSES + 1)
    for i in range(0, len(examples), batch):
        x, y = examples[i : i + batch, :-1], examples[i : i + batch, -1]
        own = Model(m.classes, m.within, near, bias, out, base)
        h = hidden(own, x)
        p = h @ out
        p += base
        np.minimum(p, 80.0, out=p)  # as in the scores
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p /= len(y) ** 0.5
        inner = (p @ out.T) * (1 - h * h)
        # Sums of ``inner`` by side word and class, all units at once.
        cells = ((x + rows) * HIDDEN)[:, :, None] + units
        weight = np.broadcast_to(inner[:, None, :], cells.shape)
        summed = np.bincount(cells.reshape(-1), weight.reshape(-1), near.size)
        steps = [summed.reshape(near.shape).astype(np.float32), inner.sum(0), h.T @ p, p.sum(0)]
        for w, g, seen in zip((near, bias, out, base), steps, moved):
            seen += g * g
            w -= rate * g / np.sqrt(seen)
    return Model(m.classes, m.within, near, bias, out, base)


def _counts(batches) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches:
        for s in slices(batch.column("text")):
            total += np.bincount(buckets(s), minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["bucket", "times"]
    )


def corpus_counts(docs: DataFrame) -> np.ndarray:
    """Words of all texts in each of the 2 ** BUCKET_BITS buckets."""
    rows = docs.select(F.col("text").cast("string")).mapInArrow(_counts, "bucket int, times long")
    out = np.zeros(1 << BUCKET_BITS, np.int64)
    summed = rows.groupBy("bucket").agg(F.sum("times").alias("times")).toPandas()  # one row a bucket
    out[summed["bucket"].to_numpy(np.int64)] = summed["times"].to_numpy(np.int64)
    return out


def _pieces(batches, m: Model, groups: int) -> Iterator[pa.RecordBatch]:
    """The classes of all texts in pieces of ``PIECE`` words with ``SIDE`` more on both sides, EDGE outside
    the text, for the group that a hash of the row and the piece's place deals each to."""
    width = PIECE + 2 * SIDE
    for batch in batches:
        keys = unsigned(batch.column("row"))
        for s in slices(batch.column("text")):
            n = s.counts()
            if not n.sum():
                continue
            c = m.classes[buckets(s)]
            cuts = -(-n // PIECE)
            doc = np.repeat(np.arange(len(n)), cuts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            at = (s.first[:-1][doc] + piece * PIECE - SIDE)[:, None] + np.arange(width)
            inside = (at >= s.first[:-1][doc][:, None]) & (at < s.first[1:][doc][:, None])
            rows = np.where(inside, c[np.clip(at, 0, len(c) - 1)], EDGE).astype(np.int16)
            draw = mixed(keys[s.row + doc] + piece.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            group = ((draw >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            rows, cut = rows[order], np.searchsorted(group[order], np.arange(groups + 1))
            some = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some, pa.int32()),
                    pa.array([rows[cut[k] : cut[k + 1]].tobytes() for k in some], pa.binary()),
                ],
                ["shard", "pieces"],
            )


def examples(pieces: np.ndarray, every: int = 1) -> np.ndarray:
    """All words of ``pieces`` as examples (2 * SIDE context classes, target class), in the order of a hash
    of their content; with ``every`` above 1, those of which that hash is divisible by it."""
    around = [*range(SIDE), *range(SIDE + 1, 2 * SIDE + 1), SIDE]
    own = np.stack([pieces[:, j : j + PIECE].reshape(-1) for j in around], 1)
    own = own[own[:, -1] != EDGE]
    key = np.zeros(len(own), np.uint64)
    for j in range(own.shape[1]):
        key = mixed(key * np.uint64(31) + own[:, j].astype(np.uint64) + np.uint64(1))
    if every > 1:
        some = key % np.uint64(every) == 0
        own, key = own[some], key[some]
    return own[np.argsort(key, kind="stable")]


def _weighted_sums(batches) -> Iterator[pa.RecordBatch]:
    total, weight = None, 0.0
    for batch in batches:
        for own, n in zip(batch.column("weights"), batch.column("n").to_pylist()):
            flat = np.frombuffer(own.as_buffer(), np.float32).astype(np.float64) * n
            total = flat if total is None else total + flat
            weight += n
    if weight:
        yield pa.RecordBatch.from_arrays(
            [pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary()), pa.array([weight])],
            ["weights", "n"],
        )


def train(docs: DataFrame, every: int = EVERY, shard: int = SHARD, rounds: int = ROUNDS) -> Model:
    """The model of a corpus. Texts that are null or empty have no part; an empty corpus leaves the
    untrained network. Shards are ordered by content, so the same corpus gives the same model up to
    the rounding of sums, however it is partitioned."""
    spark = docs.sparkSession
    counts = corpus_counts(docs)
    model = start(counts)
    words = int(counts.sum())
    if not words:
        return model
    shards = 1 + words // every // shard // rounds  # of a round
    first = model
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    rows = docs.select(F.col("text").cast("string").alias("text"), F.xxhash64(*hashed).alias("row"))
    pieces = written(
        spark,
        rows.mapInArrow(lambda b: _pieces(b, first, rounds * shards), "shard int, pieces binary"),
        "lm-pieces",
    )
    for turn in range(rounds):
        now = model

        def epoch(table: pa.Table) -> pa.Table:
            flat = b"".join(x.as_buffer().to_pybytes() for x in table["pieces"])
            own = examples(np.frombuffer(flat, np.int16).reshape(-1, PIECE + 2 * SIDE), every)
            return pa.table(
                {"weights": pa.array([packed(fit(now, own)).tobytes()], pa.binary()), "n": [float(len(own))]}
            )

        dealt = pieces.filter(F.col("shard").between(turn * shards, (turn + 1) * shards - 1))
        trained = dealt.groupBy("shard").applyInArrow(epoch, "weights binary, n double")
        if shards > _SUMS:
            trained = trained.repartition(_SUMS).mapInArrow(_weighted_sums, "weights binary, n double")
        parts = trained.collect()  # at most _SUMS rows of about 100 KB
        total = sum(r["n"] for r in parts)
        if not total:  # few texts: no piece of them is dealt to this round
            continue
        flat = sum(np.frombuffer(r["weights"], np.float32).astype(np.float64) * (r["n"] / total) for r in sorted(parts, key=lambda r: (r["n"], bytes(r["weights"]))))
        model = unpacked(model, flat)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with n_words, log_prob (sum over the words) and mean_log_prob.

    Whole texts are read. A null or empty text has 0 words, log_prob 0 and no mean. Repeated rows get
    the same score; other columns pass through (those three are replaced, the text is left out).
    """
    base = docs.drop("n_words", "log_prob", "mean_log_prob").withColumn("text", F.col("text").cast("string"))
    kept = [c for c in base.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, words = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for s in slices(batch.column("text")):
                b = buckets(s)
                rows = slice(s.row, s.row + len(s.first) - 1)
                words[rows] = s.counts()
                if len(b):
                    c = model.classes[b]
                    each = class_log_probability(model, contexts(s.first, c), c) + model.within[b]
                    total[rows] = np.bincount(s.doc(), weights=each, minlength=len(s.first) - 1)
            mean = pa.array(total / np.maximum(words, 1), mask=words == 0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(words), pa.array(total), mean],
                [*kept, "n_words", "log_prob", "mean_log_prob"],
            )

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in base.schema if f.name != "text")
    return base.mapInArrow(run, f"{fields}n_words long, log_prob double, mean_log_prob double")


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """Scores of ``docs`` under the model of ``docs``. See ``train`` and ``score``."""
    return score(docs, train(docs))
