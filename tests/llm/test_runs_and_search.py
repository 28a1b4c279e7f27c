"""Periodic runs and ranked search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from shelfcast.llm import periodic_runs, ranked_search
from shelfcast.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def plain_runs(words, least=12):
    """(start, length, period) of every run, by trying every period at every place."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] == words[i + q]:
                j = i
                while j + q < len(words) and words[j] == words[j + q]:
                    j += 1
                if j + q - i >= max(least, 2 * q):
                    found.setdefault((i, j + q - i), q)
                i = j
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic(rng, kinds, n):
    words = [rng.randrange(kinds) for _ in range(n)]
    if words and rng.random() < 0.6:
        a, p = rng.randrange(n), rng.randrange(1, 9)
        for i in range(a, min(n, a + rng.randrange(60))):
            words[i] = words[a + (i - a) % p]
    return words


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9), st.sampled_from([1, 2, 3, 5]), st.sampled_from([2, 4, 12]))
def test_runs_are_those_of_brute_force(seed, kinds, least):
    rng = random.Random(seed)
    texts = [periodic(rng, kinds, rng.randrange(60)) for _ in range(rng.randrange(1, 5))]
    first = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    found = periodic_runs.find_runs(np.array(sum(texts, []), np.int64), first, least)
    expected = [(s + int(f), n, q) for f, x in zip(first, texts) for s, n, q in plain_runs(x, least)]
    assert list(zip(*map(np.ndarray.tolist, found))) == expected


def test_one_word_a_million_times_is_one_run():
    found = periodic_runs.find_runs(np.zeros(1_000_000, np.int64), np.array([0, 1_000_000]), 12)
    assert [x.tolist() for x in found] == [[0], [1_000_000], [1]]


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a"),
    (4, "a " * 12),
    (None, "a b " * 6),
    (5, "a " * 11),
    (6, "x " + "é ü " * 7 + "é"),
    (6, "x " + "é ü " * 7 + "é"),
    (7, "w " * 50_000),
]


def test_runs_of_odd_rows(spark):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in ODD], DOCS + ", runs string, n_words int")
    got = sorted(map(repr, ((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(frame).collect())))
    expected = []
    for doc_id, text in ODD:
        words = WORD.findall(text or "")
        runs = [(0, 50_000, 1)] if doc_id == 7 else plain_runs(words)
        expected.append(repr((doc_id, len(words), runs, collapsed(words, runs))))
    assert got == sorted(expected)
    empty = spark.createDataFrame([], DOCS)
    assert periodic_runs.periodic_runs(empty).collect() == []


def changed(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_the_query_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join("abcdefg"[w] for w in periodic(rng, 7, rng.randrange(90)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "a"), (1004, "é  b\n" * 30)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    planted = 0
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        planted += changed(doc_id, words) != words
        words = changed(doc_id, words)
        runs = plain_runs(words)
        r = got[doc_id]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(collapsed(words, runs))
        top = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r.start, r.length, r.period) == top
        assert r.exponent_milli == (1000 * top[1] // top[2] if runs else None)
    assert planted > 10


# Ranked search


def plain_rank(docs, items, k=50):
    counts = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs if d is not None]
    total = sum(bool(c) for _, c in counts)
    words = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    terms = {}
    for item, text in items:
        if item is not None:
            terms.setdefault(item, set()).update(TERM.findall((text or "").translate(LOWER)))
    rows = []
    for item, own in terms.items():
        scored = []
        for doc, c in counts:
            m = 50 + 50 * sum(c.values()) * total // max(words, 1)
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in own if t in c
            )
            if score > 0:
                scored.append((-score, doc))
        rows += [(item, i, doc, -score) for i, (score, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows)


def found_by(docs, items, **how):
    return sorted(tuple(r) for r in ranked_search.rank(docs, items, **how).collect())


@pytest.mark.parametrize("block_terms", [1 << 17, 30])
def test_rank_is_that_of_brute_force(spark, block_terms):
    rng = random.Random(3)
    vocabulary = [f"{c}{i}" for i in range(12) for c in ("a", "É", "Zz")]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "'s", "."]) for _ in range(n))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(150)]
    docs += [(1000 + i, docs[i][1]) for i in range(60)]  # ties
    docs += [(2000, None), (2001, ""), (2002, ".,'"), (None, text(20)), (2003, "a1 " * 5000), (3, docs[0][1])]
    items = [(i, text(rng.randrange(1, 25))) for i in range(40)]
    items += [(100, items[0][1]), (101, None), (102, " "), (None, "a1"), (103, "nowhere"), (0, "zz1 EXTRA")]
    got = found_by(
        spark.createDataFrame([(*d, 1, "y") for d in docs], DOCS + ", n int, score string"),
        spark.createDataFrame([(*i, "z") for i in items], ITEMS + ", block string"),
        k=7,
        block_terms=block_terms,
    )
    assert got == plain_rank(docs, items, 7)


def test_rank_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b")], DOCS)
    asked = spark.createDataFrame([(1, "a")], ITEMS)
    for d, i in ((docs, items), (some, items), (docs, asked)):
        frame = ranked_search.rank(d, i)
        assert frame.columns == ["item_id", "rank", "doc_id", "score"]
        assert frame.collect() == []


def test_shared_sets_are_nodes_of_their_own_and_add_up():
    rng = random.Random(9)
    common = [f"c{i}" for i in range(8)]
    items = [sorted(set(rng.sample(common, 6)) | {f"own{i}"}) for i in range(30)]
    g = ranked_search.shared_sets(np.arange(30), items)
    sets = [frozenset([t]) for t in g.terms]
    for left, right in zip(g.left, g.right):
        assert not sets[left] & sets[right]
        sets.append(sets[left] | sets[right])
    starts = [0, *g.ends]
    for i, own in enumerate(items):
        nodes = [sets[n] for n in g.nodes[starts[i] : starts[i + 1]]]
        assert sum(map(len, nodes)) == len(own) and frozenset().union(*nodes) == set(own)
    assert len(g.left) > 0
    assert len(g.nodes) + len(g.left) < sum(map(len, items)) * 0.8
