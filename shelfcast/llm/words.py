"""Words of Arrow text columns and their 64-bit hashes, as numpy arrays.

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D``. UTF-8 never uses those bytes inside
a longer character, so words of the bytes are the words of the text. Work goes in slices of about a
megabyte of whole texts, which bounds memory whatever an Arrow batch holds.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_path

SLICE_BYTES = 1 << 20
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Also cuts at ASCII punctuation, so that "word," and "word" are one word.
NOT_LETTERS = np.array([b < 128 and not chr(b).isalnum() and chr(b) != "'" for b in range(256)])
_STEP = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xD1342543DE82EF95)
_BASE = 0x5851F42D4C957F2D


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)
_LOWER = _CODES.copy()
_LOWER[65:91] = _CODES[97:123]
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


class Slice(NamedTuple):
    """Texts ``row .. row + len(first) - 2`` of a batch.

    ``first[i]`` is the first word of the i-th text (and the end of the one before); ``start`` and
    ``end`` are byte positions of the words in ``data``; ``at`` holds the texts' byte positions.
    """

    row: int
    data: np.ndarray
    at: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text (counted from ``row``) of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64-bit hashes of the words; ``lower``: A-Z count as a-z."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = _powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((_LOWER if lower else _CODES)[self.data] * up[: len(self.data)], out=total[1:])
        return mixed((total[self.end] - total[self.start]) * down[self.start])


def slices(
    texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES, between: np.ndarray = WHITE
) -> Iterator[Slice]:
    """The texts of a string column in slices of about ``limit`` bytes; a null counts as empty.

    ``between`` marks the byte values that separate words.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if not len(texts):
        return
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
        own = at[row : stop + 1] - at[row]
        yield _slice(row, data[at[row] : at[stop]], own, between)
        row = stop


def _slice(row: int, data: np.ndarray, at: np.ndarray, between: np.ndarray) -> Slice:
    if not len(data):
        none = np.zeros(0, np.int64)
        return Slice(row, data, at, np.zeros(len(at), np.int64), none, none)
    word = ~between[data]
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[at[:-1][at[:-1] < len(data)]] = False
    after = np.empty_like(word)
    after[:-1] = word[1:]
    after[at[1:][at[1:] > 0] - 1] = False
    start = np.flatnonzero(word & ~before)
    end = np.flatnonzero(word & ~after) + 1
    return Slice(row, data, at, np.searchsorted(start, at), start, end)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words (also those that cross texts; see ``whole``)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    last = len(hashes) - n + 1
    total = np.full(last, np.uint64(n), np.uint64)
    for i in range(n):
        total *= _GRAM
        total += hashes[i : i + last]
    return mixed(total)


def whole(first: np.ndarray, n: int) -> np.ndarray:
    """Starts of the runs of ``n`` words that lie within one text."""
    words = int(first[-1])
    if words < n:
        return np.zeros(0, np.int64)
    ok = np.ones(words - n + 1, bool)
    for back in range(1, n):
        cut = first[1:-1] - back
        ok[cut[(cut >= 0) & (cut < len(ok))]] = False
    return np.flatnonzero(ok)


def signed(x: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's long."""
    return pa.array(x.astype(np.uint64, copy=False).view(np.int64))


def unsigned(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores added until no column has it (names count in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: later jobs reread it instead of computing it again.

    Spark deletes the shuffle files of a finished job once the driver's garbage collector has found
    that nothing refers to them; asking for that here frees each step's disk before the next step.
    """
    path = fresh_path(spark, label)
    df.write.parquet(path)
    time.sleep(0.3)  # listeners refer to the job until they have seen its end
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)
