"""The words of a slice of texts as exact Arrow strings, and texts joined again from some of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .words import Slice

_AS_IS = np.arange(256, dtype=np.uint8)
_LOWER = _AS_IS.copy()
_LOWER[65:91] += 32


def _ranges(sizes: np.ndarray) -> np.ndarray:
    """0 .. size-1 for each size, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def taken_bytes(s: Slice, words: np.ndarray) -> np.ndarray:
    """Positions in ``s.data`` of the bytes of the given words, in order."""
    sizes = s.end[words] - s.start[words]
    return np.repeat(s.start[words], sizes) + _ranges(sizes)


def word_array(s: Slice, lower: bool = False) -> pa.Array:
    """All words of the slice as strings; ``lower``: A-Z become a-z, nothing else changes."""
    words = np.arange(len(s.start))
    data = (_LOWER if lower else _AS_IS)[s.data[taken_bytes(s, words)]]
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum(s.end - s.start, out=offsets[1:])
    return pa.Array.from_buffers(
        pa.large_string(), len(words), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
    )


def joined(s: Slice, keep: np.ndarray) -> pa.Array:
    """Each text of the slice as its words with ``keep``, joined by one space."""
    words = np.flatnonzero(keep)
    doc = np.searchsorted(s.first, words, side="right") - 1
    sizes = s.end[words] - s.start[words]
    last = np.ones(len(words), bool)
    last[:-1] = doc[1:] != doc[:-1]
    width = sizes + ~last
    at = np.cumsum(width) - width
    out = np.full(int(width.sum()), 0x20, np.uint8)
    out[np.repeat(at, sizes) + _ranges(sizes)] = s.data[taken_bytes(s, words)]
    offsets = np.zeros(len(s.first), np.int64)
    np.cumsum(np.bincount(doc, width, len(s.first) - 1).astype(np.int64), out=offsets[1:])
    return pa.Array.from_buffers(
        pa.large_string(), len(s.first) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())]
    ).cast(pa.string())
