"""Toxicity scores: FTRL-proximal logistic regression over hashed words, word pairs and skip pairs.

Training is online, so it runs in one task over a bounded sample of the labelled texts
(``MAX_TRAINING`` rows, those with the smallest hash of their doc_id); per-coordinate rates and the L1
term leave a few thousand weights, which travel with the scoring function. Scoring reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import NOT_LETTERS, Slice, grams, mixed, slices

BITS = 20
MAX_TRAINING = 12_000
_SKIP = np.uint64(0xA24BAED4963EE407)


def feature_columns(s: Slice, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text, feature) of words, neighbouring pairs and pairs with one word between."""
    h, doc = s.hashes(lower=True), s.doc()
    shift = np.uint64(64 - bits)
    out = [(doc, (h >> shift).astype(np.int64))]
    if len(h) > 1:
        same = doc[1:] == doc[:-1]
        out.append((doc[1:][same], (grams(h, 2) >> shift).astype(np.int64)[same]))
    if len(h) > 2:
        same = doc[2:] == doc[:-2]
        skip = mixed(h[:-2] * _SKIP + h[2:])
        out.append((doc[2:][same], (skip >> shift).astype(np.int64)[same]))
    return out


def _features(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Distinct features of each text."""
    for batch in batches:
        for s in slices(batch.column("text"), between=NOT_LETTERS):
            n = len(s.first) - 1
            both = np.concatenate([(d << bits) | f for d, f in feature_columns(s, bits)])
            both = np.unique(both)
            at = np.searchsorted(both, np.arange(n + 1) << bits).astype(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(at), pa.array((both & ((1 << bits) - 1)).astype(np.int32))
            )
            rows = batch.slice(s.row, n)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("toxic"), lists], ["doc_id", "toxic", "features"]
            )


def ftrl(
    features: list[np.ndarray],
    labels: np.ndarray,
    bits: int = BITS,
    alpha: float = 0.8,
    beta: float = 1.0,
    l1: float = 8.0,
    l2: float = 1.0,
    epochs: int = 5,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Follow the regularised leader, one text after the other: (features, weights, intercept)."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    free = 1 << bits  # the intercept, without L1
    always = np.array([free])

    def weights(at: np.ndarray) -> np.ndarray:
        edge = np.where(at == free, 0.0, l1)
        lean = np.maximum(np.abs(z[at]) - edge, 0.0)
        return -np.sign(z[at]) * lean / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(epochs):
        for own, y in zip(features, labels):
            at = np.concatenate([own, always])
            w = weights(at)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    at = np.flatnonzero(np.abs(z[:free]) > l1)
    return at, weights(at), float(weights(always)[0])


def train(
    docs: DataFrame, labels: DataFrame, bits: int = BITS, max_training: int = MAX_TRAINING
) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Weights learnt from ``labels`` (doc_id, toxic) over the texts of ``docs``; None without both
    classes. Rows with a null doc_id or label are left out; a text labelled twice is toxic if either is.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_training)
    )
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = (
        texts.join(F.broadcast(known), "doc_id")  # at most max_training rows
        .select("doc_id", "toxic", "text")
        .mapInArrow(lambda b: _features(b, bits), "doc_id long, toxic int, features array<int>")
    )

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(order=mixed(frame["doc_id"].to_numpy(np.int64).view(np.uint64)))
        frame = frame.sort_values(["order", "doc_id", "toxic"], kind="stable")
        toxic = frame["toxic"].to_numpy()
        if toxic.min() == toxic.max():
            return pd.DataFrame({"feature": [], "weight": []})
        at, w, b = ftrl([np.asarray(f) for f in frame["features"]], toxic, bits)
        return pd.DataFrame({"feature": [-1, *at], "weight": [b, *w]})

    found = rows.groupBy().applyInPandas(learn, "feature int, weight double").toPandas()
    if not len(found):
        return None
    found = found.sort_values("feature")
    at, w = found["feature"].to_numpy(np.int64), found["weight"].to_numpy()
    return at[1:], w[1:], float(w[0])


def score(
    docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float] | None, bits: int = BITS
) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1, from the whole text.

    An empty or null text gets the intercept's probability; without a model every score is 0.
    """
    at, w, b = model if model is not None else (np.zeros(0, np.int64), np.zeros(0), -np.inf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits)
        table[at] = w
        live = table != 0
        for batch in batches:
            total = np.full(batch.num_rows, b)
            for s in slices(batch.column("text"), between=NOT_LETTERS):
                hits = []
                for doc, feature in feature_columns(s, bits):
                    on = live[feature]
                    hits.append((doc[on] << bits) | feature[on])
                hits = np.unique(np.concatenate(hits))
                total[s.row : s.row + len(s.first) - 1] += np.bincount(
                    hits >> bits,
                    weights=table[hits & ((1 << bits) - 1)],
                    minlength=len(s.first) - 1,
                )
            p = 1.0 / (1.0 + np.exp(-np.clip(total, -700, 700)))
            if model is None:
                p[:] = 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, "score"])

    base = docs.drop("score").withColumn("text", F.col("text").cast("string"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    return base.mapInArrow(run, f"{fields}, score double")


def held_out(doc_id) -> F.Column:
    """Rows kept from training: crc32 of the doc_id's text is a multiple of 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame, max_training: int = MAX_TRAINING) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), learnt from the labelled rows that aren't held out.

    Nulls, empty and very long texts are scored as they are; repeated rows get the same score;
    other columns pass through (a column named score is replaced). No labels: all scores are 0.
    """
    model = train(docs, labels.where(~held_out(F.col("doc_id"))), max_training=max_training)
    return score(docs, model)
