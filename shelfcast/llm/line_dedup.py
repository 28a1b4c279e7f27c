"""Near-duplicate lines by a segment-partition edit join.

Two lines within ``edits`` edits: if the shorter is cut into ``edits`` + 1 segments, one of them occurs
in the longer, near its own place. Every line is indexed by its segments, with its length and the
segment's number, and probes the index with its own substrings of the right places and lengths. Lines
that meet under a key, and whose parities of characters and of character pairs allow so few edits, are
compared by a banded bit-parallel edit distance.

A line goes if an earlier one is that near, so a line needs one partner, not all: under a key each
line meets its ``FEW`` earliest possible partners first. The rows of keys where some line had more of
them are set aside, and lines that were not removed meet the rest of their partners there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.bounds import broadcast_if_small
from .words import mixed, signed, unsigned, written

EDITS = 2
MIN_CHARS = 20
FEW = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D
_SLICE_CHARS = 1 << 20
_PARITY_BITS = 31
#: A key of more rows is cut into blocks of about so many, by what one in SOME documents has of it.
HOT = 16_384
SOME = 64
_BLOCK = 512
_ROW = ["key", "doc_id", "packed", "pairs"]
_MET = "doc_a long, line_a int, doc_b long, line_b int, key long, packed long, pairs long"


def lines_of(text: str) -> list[str]:
    """Lines of a text, without white space at their ends."""
    return [x.strip() for x in text.split("\n")]


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``. Columns of a band of 2 * edits + 1 rows are
    bits of an integer; ends that agree are cut off first."""
    if abs(len(a) - len(b)) > edits:
        return False
    same = _common(a, b)
    a, b = a[same:], b[same:]
    if not a or not b:
        return True
    back = _common(a[::-1], b[::-1])
    a, b = a[: len(a) - back], b[: len(b) - back]
    if not a or not b:
        return True
    m, n, width = len(a), len(b), 2 * edits + 1
    band = (1 << width) - 1
    up, down = band & ~((1 << edits) - 1), 0
    score = edits  # at row column + edits
    far = edits + n + edits - m
    for i in range(1, n + 1):
        c, match = b[i - 1], 0
        for k in range(max(0, edits + 1 - i), min(width, m - i + edits + 1)):
            if a[i + k - edits - 1] == c:
                match |= 1 << k
        diagonal = (((match & up) + up) ^ up) | match | down
        right = (down | ~(diagonal | up)) & band
        left = up & diagonal & band
        if not diagonal >> (width - 1) & 1:
            score += 1
            if score > far:
                return False
        diagonal = (diagonal & band) >> 1
        up = (left | ~(diagonal | right)) & band
        down = diagonal & right
    low = m - n + edits
    rows = ((1 << (width - 1)) - 1) >> low << low
    return score - (up & rows).bit_count() + (down & rows).bit_count() <= edits


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    step = 16
    while lo + step < hi and a[lo : lo + step] == b[lo : lo + step]:
        lo += step
        step *= 2
    hi = min(hi, lo + step)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def signatures(lines: list[str], edits: int, shortest: int):
    """(line, key, indexed) of all probes, and the lines' parities of characters and character pairs.

    ``indexed``: the row is the line's own segment as well as a probe for lines of its length. An edit
    changes at most two bits of the first parity, and four of the second.
    """
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.array([len(x) for x in lines], np.int64)
    start = np.concatenate([[0], np.cumsum(length)])
    spread = mixed((codes + np.uint64(1)) * _MIX)
    steps = np.full(len(codes) + 1, _BASE, np.uint64)
    steps[0] = 1
    back = np.full(len(codes) + 1, pow(_BASE, -1, 1 << 64), np.uint64)
    back[0] = 1
    steps, back = np.multiply.accumulate(steps), np.multiply.accumulate(back)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(spread * steps[:-1], out=total[1:])
    parity, pairs = np.zeros(len(lines), np.uint64), np.zeros(len(lines), np.uint64)
    some = length > 0
    if some.any():
        bit = np.uint64(1) << (spread % np.uint64(_PARITY_BITS))
        parity[some] = np.bitwise_xor.reduceat(bit, start[:-1][some])
        bit = np.uint64(1) << (mixed(spread[:-1] * np.uint64(3) + spread[1:]) & np.uint64(63))
        bit = np.append(bit, np.uint64(0))
        bit[start[1:][some] - 1] = 0  # pairs across lines
        pairs[some] = np.bitwise_xor.reduceat(bit, start[:-1][some])
    who, keys, own = [], [], []
    for shorter in range(edits + 1):
        size = length - shorter
        for i in range(edits + 1):
            short, extra = size // (edits + 1), size % (edits + 1)
            span = short + (i >= edits + 1 - extra)
            place = i * short + np.maximum(0, i - (edits + 1 - extra))
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1):
                at = place + shift
                ok = (size >= shortest) & (span > 0) & (at >= 0) & (at + span <= length)
                line = np.flatnonzero(ok)
                a = start[line] + at[line]
                key = (total[a + span[line]] - total[a]) * back[a]
                key = mixed(key ^ mixed((size[line] * 64 + i).astype(np.uint64) * _MIX))
                who.append(line)
                keys.append(key)
                own.append(np.full(len(line), shorter == 0 and shift == 0))
    return np.concatenate(who), np.concatenate(keys), np.concatenate(own), parity, pairs


def _line_rows(batches, shortest: int) -> Iterator[pa.RecordBatch]:
    """digest, doc_id, line and known (an earlier copy is in the batch) of the lines long enough."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        first: dict[bytes, tuple[int, int]] = {}
        rows = []
        for doc, text in zip(ids, batch.column("text").to_pylist()):
            for line, own in enumerate(lines_of(text or "")):
                if len(own) >= shortest:
                    digest = hashlib.blake2b(own.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    at = (doc, line)
                    if first.setdefault(digest, at) > at:
                        first[digest] = at
                    rows.append((digest, doc, line))
        known = [first[d] < (doc, line) for d, doc, line in rows]
        digest = [
            d if not k else hashlib.blake2b(b"%d:%d" % (doc, line), digest_size=16).digest()
            for (d, doc, line), k in zip(rows, known)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(digest, pa.binary()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.int32()),
                pa.array(known, pa.bool_()),
            ],
            ["digest", "doc_id", "line", "known"],
        )


def _signature_rows(batches, edits: int, shortest: int) -> Iterator[pa.RecordBatch]:
    """key, doc_id, the packed line number (32 bits), parity (31) and whether it is indexed (1), and
    the parity of pairs."""
    for batch in batches:
        texts, wanted = batch.column("text").to_pylist(), batch.column("lines").to_pylist()
        at = full = 0
        docs: list[int] = []
        numbers: list[int] = []
        lines: list[str] = []
        for doc, text, own in zip(batch.column("doc_id").to_pylist(), texts, wanted):
            every = lines_of(text)
            for n in own:
                if n < len(every) and len(every[n]) >= shortest:
                    docs.append(doc)
                    numbers.append(n)
                    lines.append(every[n])
                    full += len(every[n])
            at += 1
            if lines and (full >= _SLICE_CHARS or at == len(texts)):
                line, key, own_row, parity, pairs = signatures(lines, edits, shortest)
                packed = (
                    (np.array(numbers, np.uint64)[line] << np.uint64(32))
                    | (parity[line] << np.uint64(1))
                    | own_row.astype(np.uint64)
                )
                yield pa.RecordBatch.from_arrays(
                    [signed(key), pa.array(np.array(docs, np.int64)[line]), signed(packed), signed(pairs[line])],
                    _ROW,
                )
                docs, numbers, lines, full = [], [], [], 0


def _meet(doc, packed, pairs, part, late, edits: int, few: int | None):
    """Pairs (later, earlier) of one key's rows; ``crowded``: later rows with more partners left.

    ``late`` marks the rows that look for a partner; of rows of two blocks (see ``_parted``) only those
    of different blocks meet.
    """
    line = packed >> np.uint64(32)
    parity = (packed >> np.uint64(1)) & np.uint64((1 << _PARITY_BITS) - 1)
    order = np.lexsort((line, doc))
    rank = np.empty(len(doc), np.int64)  # of equal lines the same
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[order][1:] != doc[order][:-1]) | (line[order][1:] != line[order][:-1])
    rank[order] = np.cumsum(fresh)
    order = order[late[order]]
    indexed = (packed & np.uint64(1)) == 1
    side = (part & 1) == 1
    two = bool(side.any())
    found, partner, crowded = [], [], []
    every = np.argsort(rank, kind="stable")
    for begin in range(0, len(order), _BLOCK):
        own = order[begin : begin + _BLOCK]
        left = np.full(len(own), few or 0)
        for part in range(0, len(every), _BLOCK):
            other = every[part : part + _BLOCK]
            if rank[other[0]] >= rank[own[-1]]:
                break
            if few and not left.any():
                crowded.append(own)  # each may have more
                break
            near = rank[other][None, :] < rank[own][:, None]
            if two:
                near &= side[own][:, None] != side[other][None, :]
            near &= indexed[own][:, None] | indexed[other][None, :]
            near &= np.bitwise_count(parity[own][:, None] ^ parity[other][None, :]) <= 2 * edits
            near &= np.bitwise_count(pairs[own][:, None] ^ pairs[other][None, :]) <= 4 * edits
            a, b = np.nonzero(near)
            if few:
                seen = np.arange(len(a)) - np.searchsorted(a, a)
                keep = seen < left[a]
                crowded.append(own[np.unique(a[~keep])])
                left = np.maximum(left - np.bincount(a, minlength=len(own)), 0)
                a, b = a[keep], b[keep]
            found.append(own[a])
            partner.append(other[b])
    none = np.zeros(0, np.int64)
    join = lambda x: np.concatenate(x) if x else none
    return join(found), join(partner), join(crowded)


def _pair_rows(batches, edits: int, few: int | None) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: the pairs that meet under each key, the lines that had too many partners
    (no partner, no key), and all rows of those keys (no partner). The rows of a key, or of two blocks of
    a cut one, are held together."""
    rest = None

    def table(doc_a, line_a, doc_b=None, line_b=None, key=None, packed=None, pairs=None) -> pa.Table:
        n = len(doc_a)
        fill = lambda x, kind: pa.nulls(n, kind) if x is None else pa.array(x, kind)
        as_long = lambda x: None if x is None else x.view(np.int64)
        return pa.table(
            {
                "doc_a": pa.array(doc_a, pa.int64()),
                "line_a": pa.array(line_a, pa.int32()),
                "doc_b": fill(doc_b, pa.int64()),
                "line_b": fill(line_b, pa.int32()),
                "key": fill(as_long(key), pa.int64()),
                "packed": fill(as_long(packed), pa.int64()),
                "pairs": fill(as_long(pairs), pa.int64()),
            }
        )

    def groups(key, doc, packed, pairs, part, late):
        if not len(key):
            return
        head = np.ones(len(key), bool)
        head[1:] = (key[1:] != key[:-1]) | (part[1:] >> 1 != part[:-1] >> 1)
        at = np.append(np.flatnonzero(head), len(key))
        owns = np.add.reduceat((packed & np.uint64(1)).astype(np.int64), at[:-1])
        line = (packed >> np.uint64(32)).astype(np.int32)
        out, marks, whole = ([], []), [], []
        for g in np.flatnonzero((np.diff(at) > 1) & (owns > 0)):
            own = slice(at[g], at[g + 1])
            a, b, more = _meet(doc[own], packed[own], pairs[own], part[own], late[own], edits, few)
            out[0].append(at[g] + a)
            out[1].append(at[g] + b)
            if len(more):
                marks.append(at[g] + more)
                whole.append(np.arange(at[g], at[g + 1]))
        if out[0]:
            a, b = (np.concatenate(x) for x in out)
            yield from table(doc[a], line[a], doc[b], line[b]).to_batches()
        if marks:
            x, y = np.concatenate(marks), np.concatenate(whole)
            yield from table(doc[x], line[x]).to_batches()
            yield from table(doc[y], line[y], None, None, key[y], packed[y], pairs[y]).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        own = (
            unsigned(batch.column("key")),
            batch.column("doc_id").to_numpy(zero_copy_only=False),
            unsigned(batch.column("packed")),
            unsigned(batch.column("pairs")),
            batch.column("part").to_numpy(zero_copy_only=False),
            batch.column("late").to_numpy(zero_copy_only=False),
        )
        if rest is not None:
            own = tuple(np.concatenate(x) for x in zip(rest, own))
        same = (own[0] == own[0][-1]) & (own[4] >> 1 == own[4][-1] >> 1)
        cut = int(np.argmax(same))
        yield from groups(*(x[:cut] for x in own))
        rest = tuple(x[cut:] for x in own)
    if rest is not None:
        yield from groups(*rest)


def _parted(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` with ``part``: 0, but rows of keys of more than ``HOT`` rows (``sizes``: key, rows) are
    dealt into blocks by line and repeated for each pair of blocks, so that a pair is a group of its own.

    ``part`` is the lower block (high 31 bits), the higher one, and the row's side (lowest bit).
    """
    hot = sizes.where(F.col("rows") > HOT).select(
        F.col("key").alias("hot"), F.ceil(F.col("rows") / HOT).cast("long").alias("blocks")
    )
    rows = rows.join(broadcast_if_small(written(rows.sparkSession, hot, "line-hot")), F.col("key") == F.col("hot"), "left")
    line = F.shiftrightunsigned("packed", 32)
    own = F.pmod(F.xxhash64("doc_id", line), F.col("blocks"))

    def pair(other: Column) -> Column:
        low, high = F.least(own, other), F.greatest(own, other)
        return F.shiftleft(low, 32) + F.shiftleft(high, 1) + (own > other).cast("long")

    parts = F.when(F.col("hot").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), pair)
    )
    return rows.withColumn("part", F.explode(parts)).drop("hot", "blocks")


def _met(rows: DataFrame, sizes: DataFrame, edits: int, few: int | None) -> DataFrame:
    """Pairs and set-aside rows of signature rows with ``late``; ``sizes`` tells how many a key has."""
    dealt = _parted(rows, sizes).repartition("key", F.shiftright("part", 1)).sortWithinPartitions("key", "part")
    return dealt.mapInArrow(lambda b: _pair_rows(b, edits, few), _MET).distinct()


def _verified(pairs: DataFrame, named: DataFrame, edits: int) -> DataFrame:
    """doc_id, line of the later lines of pairs that are near."""
    needed = pairs.select(F.col("doc_a").alias("doc_id"), F.col("line_a").alias("line")).union(
        pairs.select("doc_b", "line_b")
    )
    own = needed.groupBy("doc_id").agg(F.collect_set("line").alias("lines"))
    own = written(named.sparkSession, own, "line-needed")
    # Texts of other documents stay where they are, if the ids are measured to be few.
    named = named.join(broadcast_if_small(own.select("doc_id")), "doc_id", "left_semi")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, numbers, lines = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "lines"))
            for doc, text, wanted in zip(*columns):
                every = lines_of(text)
                for n in wanted:
                    if n < len(every):
                        docs.append(doc)
                        numbers.append(n)
                        lines.append(every[n])
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(numbers, pa.int32()), pa.array(lines, pa.string())],
                ["doc", "number", "own"],
            )

    picked = named.join(own, "doc_id").select("doc_id", "text", "lines")
    # The same line of a repeated row comes once.
    texts = picked.mapInArrow(pick, "doc long, number int, own string").dropDuplicates(["doc", "number"])

    def side(x: str) -> DataFrame:
        return texts.select(
            F.col("doc").alias(f"doc_{x}"), F.col("number").alias(f"line_{x}"), F.col("own").alias(f"own_{x}")
        )

    both = pairs.join(side("a"), ["doc_a", "line_a"]).join(side("b"), ["doc_b", "line_b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [
                within(a, b, edits)
                for a, b in zip(batch.column("own_a").to_pylist(), batch.column("own_b").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_a"), batch.column("line_a")], ["doc_id", "line"]
            ).filter(pa.array(near, pa.bool_()))

    return both.select("doc_a", "line_a", "own_a", "own_b").mapInArrow(compare, "doc_id long, line int").distinct()


def repeated_lines(named: DataFrame, edits: int = EDITS, shortest: int = MIN_CHARS, few: int = FEW) -> DataFrame:
    """doc_id, line (from 0) of the lines that are within ``edits`` of an earlier one.

    ``named``: doc_id not null, text. Earlier: in a smaller doc_id, or before in the same document.
    """
    spark = named.sparkSession
    found = named.mapInArrow(
        lambda b: _line_rows(b, shortest), "digest binary, doc_id long, line int, known boolean"
    )
    least = F.min(F.struct("doc_id", "line")).over(Window.partitionBy("digest"))
    placed = found.withColumn("again", F.col("known") | (least < F.struct("doc_id", "line")))
    placed = written(spark, placed.select("doc_id", "line", "again"), "lines")
    firsts = placed.where("NOT again").groupBy("doc_id").agg(F.collect_set("line").alias("lines"))

    def signed_(named: DataFrame, firsts: DataFrame) -> DataFrame:
        return named.join(firsts, "doc_id").select("doc_id", "text", "lines").mapInArrow(
            lambda b: _signature_rows(b, edits, shortest), "key long, doc_id long, packed long, pairs long"
        )

    # How large keys are is told by some of the documents; it decides how rows are dealt only.
    some = F.pmod(F.xxhash64("doc_id"), F.lit(SOME)) == 0
    sizes = signed_(named.where(some), firsts.where(some)).groupBy("key").agg((F.count("*") * SOME).alias("rows"))
    rows = signed_(named, firsts).withColumn("late", F.lit(True))
    met = written(spark, _met(rows, sizes, edits, few), "line-pairs")
    pairs = met.where("doc_b IS NOT NULL").select("doc_a", "line_a", "doc_b", "line_b")
    near = written(spark, _verified(pairs, named, edits), "line-near")
    crowded = met.where("doc_b IS NULL AND key IS NULL")
    crowded = crowded.select(F.col("doc_a").alias("doc_id"), F.col("line_a").alias("line"))
    open_ = written(spark, crowded.join(near, ["doc_id", "line"], "left_anti").distinct(), "line-open")
    if not open_.isEmpty():
        aside = met.where("key IS NOT NULL").select(
            "key", F.col("doc_a").alias("doc_id"), F.col("line_a").alias("line"), "packed", "pairs"
        )
        late = open_.withColumn("late", F.lit(True))
        aside = aside.join(late, ["doc_id", "line"], "left").withColumn("late", F.coalesce("late", F.lit(False)))
        sizes = aside.groupBy("key").agg(F.count("*").alias("rows"))
        rest = _met(aside.select(*_ROW, "late"), sizes, edits, None).select(*pairs.columns)
        rest = written(spark, rest.join(pairs, pairs.columns, "left_anti"), "line-rest")
        near = near.union(_verified(rest, named, edits)).distinct()
    return placed.where("again").select("doc_id", "line").union(near)


def without_repeated_lines(
    docs: DataFrame, edits: int = EDITS, shortest: int = MIN_CHARS, few: int = FEW
) -> DataFrame:
    """``docs`` (doc_id, text, other columns) with the lines that stay as ``text``; n_lines, n_removed
    and removed (line numbers from 0) are added.

    A line goes if it is within ``edits`` edits of an earlier line: of a document with a smaller
    doc_id, or further up in the same. Lines are what ``\\n`` separates, compared without white space
    at their ends; those of fewer than ``shortest`` characters always stay.

    A null text stays null, with no lines; an empty one has one empty line. Rows that repeat a doc_id
    are one document and lose the same line numbers; their texts should be the same. Rows without
    doc_id take no part and stay as they are. Other columns pass through (n_lines, n_removed and
    removed are replaced).
    """
    base = docs.drop("n_lines", "n_removed", "removed").withColumns(
        {"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")}
    )
    named = base.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    gone = repeated_lines(named, edits, shortest, few).groupBy("doc_id")
    # As text, so that its size can be measured; where it is small, the texts stay where they are.
    numbers = F.array_join(F.sort_array(F.collect_set("line")).cast("array<string>"), ",")
    gone = written(docs.sparkSession, gone.agg(numbers.alias("removed")), "line-removed")
    rows = base.join(broadcast_if_small(gone), "doc_id", "left")
    none = F.array().cast("array<int>")
    rows = rows.withColumn("removed", F.coalesce(F.split("removed", ",").cast("array<int>"), none))
    every = F.split("text", "\n", -1)
    stay = F.filter(every, lambda x, i: ~F.array_contains("removed", i))
    return rows.withColumns(
        {
            "n_lines": F.coalesce(F.when(F.col("text").isNotNull(), F.size(every)), F.lit(0)),
            "n_removed": F.size("removed"),
            "text": F.when(F.size("removed") > 0, F.array_join(stay, "\n")).otherwise(F.col("text")),
        }
    ).select(*base.columns, "n_lines", "n_removed", "removed")
