"""Repeated byte strings by Burrows-Wheeler transforms of the text that may hold them.

1. Every string of ``length`` bytes has an anchor, its smallest ``SEED``-gram by hash; equal strings have
   equal anchors. The strings of one text with one anchor are a segment of some 130 bytes. Segments
   that are equal as a whole (told by a 128-bit BLAKE2 digest) have the same strings at the same places: the
   earliest stays in play, the strings of the others are marked. Anchors meet by one shuffle of digests;
   an anchor that many rows of a sample hold is spread by digest, which changes no result.
2. Only different segments of one anchor may still share strings. Their bytes are fetched, and anchors
   are dealt to tasks in blocks of about a megabyte. An anchor with more segments than a block holds is
   cut by a longer prefix or suffix around it, until its parts are small: every string holds more
   bytes before the anchor or more behind it, and equal strings agree on which.
3. In a block the transform of the segments is taken and extended backwards, breadth first: the
   intervals of all strings of 0, 1, 2 ... bytes give the places where neighbouring suffixes share just
   that many. After ``length`` - 1 bytes the places still open are those that share ``length`` or more,
   and nothing beyond is computed. In each such group all but the earliest string are marked.
4. Marks meet their documents, and the bytes they cover go.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .substring_dedup import later, runs
from .wordlists import _ranges
from .words import _CODES, _powers, mixed, signed, written

LENGTH = 100
SEED = 24
#: Bytes of the segments that a block of anchors holds, about.
BLOCK_BYTES = 1 << 20
#: More different segments than this, and an anchor is cut into longer ones.
ANCHOR_SEGMENTS = 4096
#: Anchors that are spread over tasks, at most.
SPREAD = 4096
#: Bytes of text that a task looks at together.
TEXT_BYTES = 1 << 18
#: Neither byte is part of any UTF-8 text.
_BETWEEN, _LAST = 0xFF, 0xFE
_PLACES = np.uint64(0xFFFFFFFF)


def byte_slices(texts: pa.Array, limit: int = TEXT_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, where each text begins and the last ends) of whole texts, about ``limit`` bytes."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if not len(texts):
        return
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
        yield row, data[at[row] : at[stop]], at[row : stop + 1] - at[row]
        row = stop


def segments(data: np.ndarray, at: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """(text, first string's place, strings, anchor's place less that, anchor's hash) of each segment.

    Places count from the first byte of ``data``; strings don't cross texts.
    """
    sizes = np.maximum(np.diff(at) - length + 1, 0)
    if not sizes.any():
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * up[: len(data)], out=total[1:])
    grams = (total[seed:] - total[:-seed]) * down[: len(data) - seed + 1]
    # The place in the low half settles ties: the first of the smallest.
    least = (grams & ~_PLACES) | np.arange(len(grams), dtype=np.uint64)
    reach, span = 1, length - seed + 1
    while reach < span:
        step = min(reach, span - reach)
        least = np.minimum(least[: len(least) - step], least[step:])
        reach += step
    text = np.repeat(np.arange(len(sizes)), sizes)
    start = at[text] + _ranges(sizes)
    anchor = (least[start] & _PLACES).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(start)))
    start, anchor = start[head], anchor[head]
    return text[head], start, count, anchor - start, mixed(grams[anchor])


def digests(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the 128-bit digests of the given stretches."""
    view = memoryview(data)
    found = b"".join([blake2b(view[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), stop.tolist())])
    both = np.frombuffer(found, np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


_SEGMENT = "high long, low long, key long, doc_id long, start long, run int, back int"
_SETTLED = "key long, doc_id long, start long, run int, back int"


def _segment_rows(batches, length: int, seed: int) -> Iterator[pa.RecordBatch]:
    """The first of the equal segments of a batch; of the others, the runs of strings they cover.

    The latter have no key, and ``high`` and ``low`` only spread them over tasks.
    """
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        parts = []
        for row, data, at in byte_slices(batch.column("text")):
            text, start, count, back, key = segments(data, at, length, seed)
            if len(text):
                high, low = digests(data, start, start + count + length - 1)
                parts.append((high, low, key, ids[row + text], start - at[text], count, back))
        if not parts:
            continue
        high, low, key, doc, start, count, back = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((start, doc, low, high))
        high, low, key, doc, start, count, back = (x[order] for x in (high, low, key, doc, start, count, back))
        fresh = np.ones(len(high), bool)
        fresh[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        d, w, n = joined_runs(*(x[later(fresh, doc, start)] for x in (doc, start, count)))
        spread = mixed(d.astype(np.uint64) * np.uint64(31) + w.astype(np.uint64))
        both = lambda a, b: np.concatenate([a[fresh], b])
        yield pa.RecordBatch.from_arrays(
            [
                signed(both(high, spread)),
                signed(both(low, spread)),
                pa.array(both(key.view(np.int64), np.zeros(len(d), np.int64)), mask=both(~fresh, np.ones(len(d), bool))),
                pa.array(both(doc, d), pa.int64()),
                pa.array(both(start, w), pa.int64()),
                pa.array(both(count, n), pa.int32()),
                pa.array(both(back, np.zeros(len(d), np.int64)), pa.int32()),
            ],
            ["high", "low", "key", "doc_id", "start", "run", "back"],
        )


def joined_runs(doc: np.ndarray, start: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs that follow each other in a document as one."""
    order = np.lexsort((start, doc))
    doc, start, run = doc[order], start[order], run[order]
    head = np.ones(len(doc), bool)
    head[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + run[:-1])
    at = np.flatnonzero(head)
    return doc[at], start[at], np.add.reduceat(run, at) if len(at) else run


def _firsts(batches, same: list[str], keep: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``same``, doc_id, start: the first row of each kind stays, the others lose their key."""
    last, place = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        doc, start = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "start"))
        head = np.zeros(len(doc), bool)
        head[0] = True
        for c in same:
            column = batch.column(c)
            differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
            head[1:] |= differs.to_numpy(zero_copy_only=False)
        first = tuple(batch.column(c)[0].as_py() for c in same)
        again = later(head, doc, start)
        kept = head.copy()
        if first == last:  # goes on from the batch before
            own = slice(0, int(np.append(np.flatnonzero(head)[1:], len(head))[0]))
            again[own] = (doc[own] != place[0]) | (start[own] != place[1])
            kept[0] = False
        else:
            place = (doc[0], start[0])
        if head[1:].any():
            at = int(np.flatnonzero(head)[-1])
            place = (doc[at], start[at])
        last = tuple(batch.column(c)[-1].as_py() for c in same)
        stay = pa.array(kept | again)  # the same place twice is one segment
        key = pc.if_else(pa.array(kept), batch.column("key"), pa.scalar(None, pa.int64()))
        columns = [key if c == "key" else batch.column(c) for c in keep]
        yield pa.RecordBatch.from_arrays(columns, keep).filter(stay)


def _alone(batches, spread: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of ``_firsts`` in the order of their key, less those that are alone with it.

    Rows without key pass. Keys of ``spread`` may have rows in other tasks, so their rows pass too.
    """
    held, open_ = None, None  # a row that is alone so far; the key of the last row
    for batch in batches:
        yield batch.filter(batch.column("key").is_null())
        batch = batch.filter(batch.column("key").is_valid())
        if held is not None:
            batch = pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy(zero_copy_only=False)
        near = np.concatenate([[held is None and key[0] == open_], key[1:] == key[:-1], [False]])
        pass_ = near[:-1] | near[1:] | np.isin(key, spread)
        open_ = key[-1]
        held = None if pass_[-1] else batch.slice(len(key) - 1)
        yield batch.filter(pa.array(pass_))


def _fetched(batches, length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted segments of each text."""
    for batch in batches:
        text, wanted = batch.column("text").cast(pa.large_string()), batch.column("wanted")
        sizes = wanted.value_lengths().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        flat = wanted.flatten()
        start, run = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "run"))
        _, offsets, data = text.buffers()
        at = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        stop = at[row] + start + run + length - 1
        inside = np.flatnonzero(stop <= at[row + 1])  # a repeated row may have a shorter text
        row, begin, size = row[inside], (at[row] + start)[inside], (run + length - 1)[inside]
        ends = np.zeros(len(size) + 1, np.int32)
        np.cumsum(size, out=ends[1:])
        bytes_ = data[np.repeat(begin, size) + _ranges(size)]
        segment = pa.Array.from_buffers(
            pa.binary(), len(size), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(bytes_.tobytes())]
        )
        flat = flat.take(pa.array(inside))
        yield pa.RecordBatch.from_arrays(
            [
                flat.field("key"), flat.field("n"), segment, batch.column("doc_id").take(pa.array(row)),
                flat.field("start"), flat.field("run"), flat.field("back"),
            ],
            ["key", "n", "segment", "doc_id", "start", "run", "back"],
        )


def cut_anchor(segment: bytes, back: int, core: int, length: int) -> list[tuple[int, int, int, int]]:
    """(first string, strings, bytes before the longer anchor, its length) of a segment's two parts.

    ``core`` bytes from ``back`` on are the anchor, which all strings of the segment hold. A string has
    ``length - core`` other bytes; those with at least half of them before the anchor share a longer one
    that begins earlier, the others one that ends later.
    """
    rest, strings = length - core, len(segment) - length + 1
    before = (rest + 1) // 2
    behind = rest - before + 1
    split = min(max(back - before + 1, 0), strings)
    parts = [(0, split, back - before, core + before), (split, strings - split, back - split, core + behind)]
    return [p for p in parts if p[1] > 0]


def _cut_rows(batches, length: int) -> Iterator[pa.RecordBatch]:
    names = ["key", "segment", "doc_id", "start", "run", "back", "core"]
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            segment = r["segment"]
            if r["core"] >= length:
                raise ValueError("segments of a whole string are equal")
            for first, count, back, core in cut_anchor(segment, r["back"], r["core"], length):
                own = segment[first : first + count + length - 1]
                key = int.from_bytes(blake2b(own[back : back + core], digest_size=8).digest(), "little", signed=True)
                rows.append((key, own, r["doc_id"], r["start"] + first, count, back, core))
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of ``text`` sorted by their first ``depth`` bytes or more."""
    n = len(text)
    ahead = np.concatenate([text, text[:8], text[:8], text[:8], text[:8], text[:8], text[:8], text[:8], text[:8]])
    packed = np.zeros(n, np.uint64)
    for i in range(8):
        packed = (packed << np.uint64(8)) | ahead[i : i + n]
    order = np.argsort(packed, kind="stable")
    key = packed[order]
    head = np.ones(n, bool)
    head[1:] = key[1:] != key[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    h = 8
    while h < depth:
        open_ = np.flatnonzero(~(head & np.append(head[1:], True)))
        if not len(open_):
            break
        at = order[open_]
        pair = rank[at] * n + rank[(at + h) % n]
        by = np.argsort(pair, kind="stable")
        at, pair = at[by], pair[by]
        order[open_] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = pair[1:] != pair[:-1]
        head[open_] = fresh
        rank[at] = np.maximum.accumulate(np.where(fresh, open_, 0))
        h *= 2
    return order


def short_prefixes(last: np.ndarray, length: int) -> np.ndarray:
    """For each place k of a Burrows-Wheeler transform, whether suffixes k-1 and k share less than ``length``.

    Intervals of all strings of i bytes are extended backwards by each byte that stands before them; where
    the extended interval ends at a place not yet reached, the suffixes on both sides share just i bytes.
    """
    n = len(last)
    order = np.argsort(last, kind="stable")
    forward = np.empty(n, np.int64)
    forward[order] = np.arange(n)
    byte = last[order].astype(np.int64)
    along = byte * n + order  # ascending: the places of each byte, byte by byte
    following = np.full(n, n, np.int64)
    same = byte[1:] == byte[:-1]
    following[order[:-1][same]] = order[1:][same]
    reached = np.zeros(n + 1, bool)
    reached[[0, n]] = True
    low, high = np.array([0]), np.array([n - 1])
    for _ in range(length):
        size = high - low + 1
        place = np.repeat(low, size) + _ranges(size)
        final = following[place] > np.repeat(high, size)  # the last of its byte in the interval
        place, own = place[final], np.repeat(np.arange(len(low)), size)[final]
        end = forward[place]
        open_ = ~reached[end + 1]
        place, own, end = place[open_], own[open_], end[open_]
        begin = np.searchsorted(along, last[place].astype(np.int64) * n + low[own])
        reached[end + 1] = True
        by = np.argsort(begin)
        low, high = begin[by], end[by]
        if not len(low):
            break
    return reached[:-1]


def repeats_in(parts: list[bytes], doc_id: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(doc_id, start, strings) of the runs of strings of ``length`` bytes that also start earlier.

    ``parts[i]`` are the bytes of document ``doc_id[i]`` from ``start[i]`` on.
    """
    text = np.frombuffer(bytes([_BETWEEN]).join(parts) + bytes([_LAST]), np.uint8)
    sizes = np.array([len(p) for p in parts], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    order = suffix_order(text, length)
    short = short_prefixes(text[order - 1], length)
    group = np.cumsum(short)
    shared = ~(short & np.append(short[1:], True))
    place, group = order[shared], group[shared]
    part = np.searchsorted(begin, place, side="right") - 1
    whole = place + length <= begin[part] + sizes[part]
    place, group, part = place[whole], group[whole], part[whole]
    doc, at = doc_id[part], start[part] + place - begin[part]
    by = np.lexsort((at, doc, group))
    doc, at, group = doc[by], at[by], group[by]
    head = np.ones(len(by), bool)
    head[1:] = group[1:] != group[:-1]
    again = later(head, doc, at)
    return runs(doc[again], at[again])


def _block_repeats(batches, length: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: blocks of whole keys of about BLOCK_BYTES each."""

    def settled() -> pa.RecordBatch:
        found = repeats_in(parts, np.array(docs, np.int64), np.array(starts, np.int64), length)
        return pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(found, (pa.int64(), pa.int64(), pa.int32()))], ["doc_id", "start", "run"]
        )

    parts, docs, starts, size, last = [], [], [], 0, None
    for batch in batches:
        rows = (batch.column(c).to_pylist() for c in ("key", "segment", "doc_id", "start"))
        for key, segment, doc, start in zip(*rows):
            if size >= BLOCK_BYTES and key != last:
                yield settled()
                parts, docs, starts, size = [], [], [], 0
            parts.append(segment)
            docs.append(doc)
            starts.append(start)
            size += len(segment) + 1
            last = key
    if parts:
        yield settled()


def _shared(rows: DataFrame) -> DataFrame:
    """Rows whose key others have too, with ``n``, how many."""
    times = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(times, "key")


def frequent_anchors(docs: DataFrame, length: int, seed: int) -> list[int]:
    """Anchors with more rows than a task's fair share, as far as one document in 64 tells.

    At most ``SPREAD``, as each holds that part of all rows. They are dealt out differently, no more.
    """
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(64)) == 0)
    rows = sample.mapInArrow(lambda b: _segment_rows(b, length, seed), _SEGMENT).groupBy("key").count()
    rows = rows.where("key IS NOT NULL")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = rows.agg(F.sum("count")).first()[0] or 0
    if not total:
        return []
    return [r.key for r in rows.where(F.col("count") > max(16, total / min(2 * tasks, SPREAD))).collect()]


def repeated_strings(
    docs: DataFrame, length: int = LENGTH, seed: int = SEED, anchor_segments: int = ANCHOR_SEGMENTS
) -> DataFrame:
    """doc_id, start, run: ``run`` strings of ``length`` bytes, from byte ``start`` on, that start earlier elsewhere.

    Earlier: in a smaller doc_id, or before in the same document. ``docs``: doc_id not null, text.
    """
    spark = docs.sparkSession
    spread = frequent_anchors(docs, length, seed)
    found = docs.mapInArrow(lambda b: _segment_rows(b, length, seed), _SEGMENT)
    dealt = F.coalesce("key", "high")
    if spread:
        dealt = F.when(F.col("key").isin(spread), F.col("high")).otherwise(dealt)
    found = found.repartition(dealt).sortWithinPartitions("key", "high", "low", "doc_id", "start")
    columns = ["key", "doc_id", "start", "run", "back"]

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _alone(_firsts(batches, ["high", "low"], columns), np.array(spread, np.int64))

    settled = written(spark, found.mapInArrow(settle, _SETTLED), "segments")
    marks = [settled.where("key IS NULL").select("doc_id", "start", "run")]
    shared = written(spark, _shared(settled.where("key IS NOT NULL")), "shared-segments")
    wanted = shared.groupBy("doc_id").agg(F.collect_list(F.struct("key", "n", "start", "run", "back")).alias("wanted"))
    texts = docs.join(wanted, "doc_id").select("doc_id", "text", "wanted")
    schema = "key long, n long, segment binary, doc_id long, start long, run int, back int"
    rows = texts.mapInArrow(lambda b: _fetched(b, length), schema).withColumn("core", F.lit(seed))
    large = shared.where(F.col("n") > anchor_segments)
    columns = ["key", "segment", "doc_id", "start", "run", "back", "core"]
    small = []
    while not large.isEmpty():
        rows = written(spark, rows, "segment-texts")
        small.append(rows.where(F.col("n") <= anchor_segments))
        large = rows.where(F.col("n") > anchor_segments)
        schema = "key long, segment binary, doc_id long, start long, run int, back int, core int"
        parts = large.mapInArrow(lambda b: _cut_rows(b, length), schema)
        parts = parts.repartition("key", "segment").sortWithinPartitions("key", "segment", "doc_id", "start")
        parts = written(
            spark, parts.mapInArrow(lambda b: _firsts(b, ["key", "segment"], columns), schema), "cut-anchors"
        )
        marks.append(parts.where("key IS NULL").select("doc_id", "start", "run"))
        rows = _shared(parts.where("key IS NOT NULL"))
        large = rows.where(F.col("n") > anchor_segments)
    small.append(rows)
    blocks = reduce(DataFrame.union, [r.select("key", "segment", "doc_id", "start") for r in small])
    blocks = blocks.repartition("key").sortWithinPartitions("key", "doc_id", "start")
    marks.append(blocks.mapInArrow(lambda b: _block_repeats(b, length), "doc_id long, start long, run int"))
    return reduce(DataFrame.union, marks)


def _without(batches, length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, gone, spans, kept = [], [], [], []
        for text, own in zip(batch.column("text"), batch.column("cuts")):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            total.append(len(data))
            removed = count = 0
            if own.is_valid:
                start, run = (own.values.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "run"))
                order = np.argsort(start)
                start, stop = start[order], np.minimum(start[order] + run[order] + length - 1, len(data))
                reach = np.maximum.accumulate(stop)
                new = np.ones(len(start), bool)
                new[1:] = start[1:] > reach[:-1]
                first = np.flatnonzero(new)
                begin, end = start[first], reach[np.append(first[1:], len(start)) - 1]
                inside = begin < end
                begin, end = begin[inside], end[inside]
                removed, count = int((end - begin).sum()), len(begin)
                edges = zip([0, *end.tolist()], [*begin.tolist(), len(data)])
                data = b"".join([data[a:b] for a, b in edges])
            gone.append(removed)
            spans.append(count)
            kept.append(data)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *[pa.array(x, pa.int64()) for x in (total, gone, spans)],
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def without_repeated_bytes(
    docs: DataFrame, length: int = LENGTH, seed: int = SEED, anchor_segments: int = ANCHOR_SEGMENTS
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary) of every row of ``docs`` (doc_id, text).

    Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes covers it that also starts earlier:
    in a smaller doc_id, or before in the same document. Strings are judged on the texts as they came,
    may overlap and never cross texts. ``n_spans`` counts the maximal stretches that go; ``kept`` may
    end within a character.

    A null text counts as empty; empty and short texts keep all. Rows that repeat a doc_id are one
    document; its texts should be the same (each is judged, and what goes from one goes from all). Rows without
    doc_id take no part and keep their bytes. Ties don't occur: no two strings start at the same
    place. Other columns are ignored.
    """
    if not 8 <= seed <= length <= 128:
        raise ValueError("8 <= seed <= length <= 128 bytes")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    named = docs.where("doc_id IS NOT NULL")
    cuts = repeated_strings(named, length, seed, anchor_segments)
    cuts = cuts.groupBy("doc_id").agg(F.collect_list(F.struct("start", "run")).alias("cuts"))
    cuts = written(docs.sparkSession, cuts, "repeated-strings")
    with_cuts = named.join(cuts, "doc_id", "left").select("doc_id", "text", "cuts")
    nameless = docs.where("doc_id IS NULL").select(
        "doc_id", "text", F.lit(None).cast(cuts.schema["cuts"].dataType).alias("cuts")
    )
    return with_cuts.union(nameless).mapInArrow(
        lambda b: _without(b, length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
