"""Repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from shelfcast.llm import bwt_dedup
from shelfcast.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def plain(docs, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, kept) of documents with unique ids."""
    seen, found = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        keep = [True] * len(data)
        for i in range(len(data) - length + 1):
            string = data[i : i + length]
            if string in seen:
                keep[i : i + length] = [False] * length
            seen.add(string)
        spans = sum(not k and (i == 0 or keep[i - 1]) for i, k in enumerate(keep))
        kept = bytes(b for b, k in zip(data, keep) if k)
        found[doc_id] = (len(data), len(data) - len(kept), spans, kept)
    return found


def rows_of(frame):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in frame.collect()}


def corpus(seed, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randrange(20, 80))) for _ in range(8)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts.append(rng.choice([p, p[a:], p[:a]]) if rng.random() < 0.6 else " ".join(word() for _ in range(30)))
        docs.append((i * 3, "\n".join(parts)))
    docs += [(5000 + i, docs[i][1]) for i in range(20)]
    docs += [(6001, None), (6002, ""), (6003, "x" * 99), (6004, "x" * 100), (6005, "x" * 700), (6006, "ab" * 400)]
    docs += [(6007, "\x00" * 150), (6008, passages[0] * 40)]
    return docs


@pytest.mark.parametrize("seed", range(60))
def test_a_block_is_that_of_brute_force(seed):
    rng = random.Random(seed)
    length = rng.choice([8, 12, 20, 100])
    base = bytes(rng.choice(b"ab") for _ in range(200))
    parts = []
    for _ in range(rng.randrange(1, 8)):
        a = rng.randrange(0, 150)
        parts.append(bytes(rng.choice(b"abc") for _ in range(rng.randrange(30))) + base[a : a + rng.randrange(180)])
    parts = [p for p in parts if len(p) >= length] or [base]
    doc = np.array([rng.randrange(3) for _ in parts])
    start = np.array([1000 * i for i in range(len(parts))])
    found = bwt_dedup.repeats_in(parts, doc, start, length)
    got = {(d, s + i) for d, s, r in zip(*[x.tolist() for x in found]) for i in range(r)}
    places = {}
    for p, d, s in zip(parts, doc.tolist(), start.tolist()):
        for i in range(len(p) - length + 1):
            places.setdefault(p[i : i + length], []).append((d, s + i))
    assert got == {x for own in places.values() for x in own if x != min(own)}


def test_segments_cover_every_string_once_and_equal_strings_share_an_anchor():
    texts = [t for _, t in corpus(4)]
    at_anchor = {}
    for row, data, at in bwt_dedup.byte_slices(pa.array(texts), 2000):
        text, start, count, back, key = bwt_dedup.segments(data, at, 100, 24)
        for t in range(len(at) - 1):
            strings = [s for i in np.flatnonzero(text == t) for s in range(start[i], start[i] + count[i])]
            assert strings == list(range(at[t], max(at[t], at[t + 1] - 99)))
        for s, n, b, k in zip(start, count, back, key):
            for i in range(n):
                string = data[s + i : s + i + 100].tobytes()
                assert at_anchor.setdefault(string, (k, b - i)) == (k, b - i)


@pytest.mark.parametrize("core", [24, 62, 90, 99])
def test_a_cut_anchor_keeps_every_string_once(core):
    rng = random.Random(core)
    for _ in range(200):
        strings = rng.randrange(1, 100 - core + 2)
        back = rng.randrange(strings - 1, 100 - core + 1)
        segment = bytes(rng.randrange(256) for _ in range(strings + 99))
        kept = []
        for first, count, ahead, wide in bwt_dedup.cut_anchor(segment, back, core, 100):
            kept += range(first, first + count)
            assert core < wide <= 100
            # Every string of the part holds the whole longer anchor, which holds the old one.
            assert count - 1 <= ahead and ahead + wide <= 100
            assert first + ahead <= back and back + core <= first + ahead + wide
        assert sorted(kept) == list(range(strings))


@pytest.mark.parametrize("how", [{}, {"anchor_segments": 2}, {"length": 30, "seed": 12, "anchor_segments": 3}])
def test_documents_are_those_of_brute_force(spark, how):
    docs = corpus(7)
    random.Random(1).shuffle(docs)
    frame = spark.createDataFrame([(*d, 1, b"x") for d in docs], SCHEMA + ", key int, segment binary")
    got = rows_of(bwt_dedup.without_repeated_bytes(frame.repartition(5), **how))
    assert got == plain(docs, how.get("length", 100))


def test_a_common_phrase_in_ever_other_surroundings(spark):
    rng = random.Random(8)
    phrase = "the same seventy bytes stand in the middle of every document, ever and ever "
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    docs = [(i, noise(120) + phrase + noise(120)) for i in range(300)]
    docs += [(1000 + i, docs[i][1][60:]) for i in range(50)]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(4)
    assert rows_of(bwt_dedup.without_repeated_bytes(frame, anchor_segments=20)) == plain(docs)


def test_rows_without_id_repeated_rows_and_empty_tables(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdef ") for _ in range(400))
    frame = spark.createDataFrame([(None, text), (None, None), (5, text), (5, text), (9, text)], SCHEMA)
    got = sorted(
        ((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in bwt_dedup.without_repeated_bytes(frame).collect())
    )
    assert got == [(False, 0, 0, 0, 0), (False, 0, 400, 0, 0), (True, 5, 400, 0, 0), (True, 5, 400, 0, 0), (True, 9, 400, 400, 1)]
    assert bwt_dedup.without_repeated_bytes(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        bwt_dedup.without_repeated_bytes(frame, length=20, seed=40)


def test_the_query_against_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    expected = {
        d: (n, gone, spans, hashlib.sha256(kept).hexdigest()) for d, (n, gone, spans, kept) in plain(docs).items()
    }
    frame = QUERIES["op13_repeated_bytes"](spark, small)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()}
    assert got == expected
    assert any(gone for _, gone, _, _ in expected.values())


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_rows_alone_with_their_key_are_left_out(size):
    rng = random.Random(size)
    keys = [None] * 3 + sorted(rng.randrange(40) for _ in range(40))
    rows = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(range(len(keys)))], ["key", "row"])
    got = [
        r["row"]
        for b in bwt_dedup._alone((rows.slice(i, size) for i in range(0, len(keys), size)), np.array([7, 8]))
        for r in b.to_pylist()
    ]
    assert sorted(got) == [i for i, k in enumerate(keys) if k is None or k in (7, 8) or keys.count(k) > 1]


def test_a_frequent_anchor_is_spread(spark):
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = noise(160)
    docs = [(i, noise(90) + passage + noise(90)) for i in range(4000)]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(4)
    assert bwt_dedup.frequent_anchors(frame, 100, 24)
    assert rows_of(bwt_dedup.without_repeated_bytes(frame, anchor_segments=500)) == plain(docs)
