"""Mixing, toxicity, leaks and language-model scores."""

import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from shelfcast.llm import decontaminate, mixing, pseudo_likelihood as lm, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def highest_quotients(claims, seats):
    got = [0] * len(claims)
    for _ in range(seats):
        best = max(range(len(claims)), key=lambda i: (Fraction(claims[i]) / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=6), st.integers(0, 60))
def test_apportionment_by_highest_quotients(claims, seats):
    if sum(claims) == 0:
        assert mixing.apportion(claims, seats) == [0] * len(claims)
    else:
        got = mixing.apportion(claims, seats)
        assert sum(got) == seats
        # The same lowest quotient that won, whoever has it among ties.
        won = lambda a: sorted(Fraction(c, 2 * k + 1) for c, q in zip(claims, a) for k in range(q))
        assert won(got) == won(highest_quotients(claims, seats))


def test_shares_stop_at_three_times_the_size():
    assert mixing.shares([100, 100, 1000], [1, 2, 3]) == pytest.approx([225, 300, 675])
    assert mixing.shares([0, 0], [1, 2]) == [0, 0]
    assert sum(mixing.shares([5, 50, 500, 7], [1, 2, 3, 1])) == pytest.approx(562)


@pytest.fixture(scope="module")
def mixed_docs(spark):
    rng = random.Random(5)
    rows = []
    for d in range(600):
        source = rng.choice(["b", "b", "b", "B", "é", "", None, "tiny" if d % 97 == 0 else "b"])
        rows.append((d, " ".join(["w"] * rng.choice([0, 1, 30, 200])), source, 0))
    rows += [rows[3], (None, "a b c", "b", 0), (None, None, None, 0), (999, None, "b", 0)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, size int")


def test_mix_meets_targets_and_caps(mixed_docs):
    rows, df = mixed_docs
    got = mixing.mix(df, shard_words=3000).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = mixing.shares([sizes[s] for s in order], [1 + i % 3 for i in range(len(order))])
    taken = dict.fromkeys(order, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[order.index(r.source)])
        assert 0 <= r.taken <= 3 * r.size
        assert r.taken == sum((e - b) * t for b, e, t in r.spans)
        assert all(0 <= b < e <= r.size and 1 <= t <= 3 for b, e, t in r.spans)
        assert all(x[1] <= y[0] for x, y in zip(r.spans, r.spans[1:]))
        taken[r.source] += r.taken
    for s, t in zip(order, targets):
        assert abs(taken[s] - t) <= 0.5, s
    again = mixing.mix(df.repartition(7), shard_words=3000).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


@pytest.mark.parametrize("sizes", [[10], [40], [7, 0, 33], [300, 5], [1], [32, 32], [0]])
@pytest.mark.parametrize("share", [0, 0.3, 1, 1.7, 2.99, 3])
def test_blocks_of_a_shard_word_by_word(sizes, share):
    """Counted word by word: whole rounds, then seeded blocks, the last one in part."""
    total = sum(sizes)
    words = round(share * total)
    taken, doc, begin, end, times = mixing.take_blocks(np.array(sizes), words, 32, 3, 5)
    assert taken.sum() == words and len(taken) == len(sizes)
    count = np.zeros(total, int)
    first = np.cumsum([0, *sizes])
    for d, b, e, t in zip(doc, begin, end, times):
        count[first[d] + b : first[d] + e] += t
    assert [count[a:b].sum() for a, b in zip(first, first[1:])] == taken.tolist()
    rounds = min(words // total, 3) if total else 0
    assert set(count.tolist()) <= {rounds, rounds + 1} and count.max(initial=0) <= 3
    blocks = [count[i : i + 32] for i in range(0, total, 32)]
    assert sum(len(set(b.tolist())) > 1 for b in blocks) <= 1


def test_shards_give_the_target_to_the_word():
    assert mixing.settle([4], [40], 120, 32, 3) == [120]
    assert mixing.settle([1], [10], 30, 32, 3) == [30]
    assert mixing.settle([2, 3], [100, 20], 190, 32, 3) == [130, 60]
    assert mixing.settle([2, 2], [100, 100], 100, 32, 3) == [36, 64]
    assert mixing.settle([0], [0], 0, 32, 3) == [0]


def test_small_sources_give_their_targets(spark):
    rows = [(1, "w " * 10, "a"), (2, "w " * 40, "b"), (3, "w " * 300, "c"), (4, "w " * 900, "d")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(abs(r.taken - r.target) <= 0.5 for r in got) and len(got) == 4


def test_mix_query_takes_all_documents(spark, small):
    from shelfcast.llm.queries import QUERIES

    got = QUERIES["op2_source_mix"](spark, small).collect()
    texts = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.size == len(WORD.findall(texts[r.doc_id].text or "")) and r.taken <= 3 * r.size
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    from shelfcast.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, folder).collect()}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    right = wrong = caught = toxic = 0
    for r in spark.read.parquet(f"{folder}/labels.parquet").collect():
        one = got[r.doc_id]
        assert one.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= one.score <= 1 and one.predicted == int(one.score >= 0.5)
        if one.held_out:
            right += one.predicted == r.toxic
            wrong += one.predicted != r.toxic
            toxic += r.toxic
            caught += r.toxic and one.predicted
    assert right / (right + wrong) > 0.96 and caught / toxic > 0.7


def test_toxicity_of_odd_rows(spark):
    rng = random.Random(1)
    text = lambda t: " ".join(rng.choice("abcdefgh") for _ in range(30)) + (" vile." if t else "")
    rows = [(i, text(i % 4 == 0), 1.0) for i in range(400)]
    odd = [(1000, None, 1.0), (1001, "", 1.0), (None, "vile", 1.0), (3, rows[3][1], 1.0)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, score double")
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(300)] + [(None, 1), (7, None), (5, 0)], "doc_id long, toxic int"
    )
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        if r.doc_id is not None and 300 <= r.doc_id < 400:
            assert (r.score >= 0.5) == (r.doc_id % 4 == 0)
    assert all(r.score < 0.5 for r in got if r.text in (None, ""))
    # Without labels, without both classes, without documents.
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in toxicity.toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_ftrl_weights_are_sparse():
    rng = np.random.default_rng(0)
    rows, y = [], []
    for i in range(600):
        own = rng.choice(np.arange(1000, 200_000), 50, replace=False)
        rows.append(np.sort(np.append(own, 7)) if i % 5 == 0 else np.sort(own))
        y.append(int(i % 5 == 0))
    at, w, _ = toxicity.ftrl(rows, np.array(y))
    assert 7 in at and len(at) < 50 and w[list(at).index(7)] > 1


def local_score(a, b):
    """Smith-Waterman by the cell."""
    best, table = 0.0, [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = max(
                0.0, table[i - 1][j - 1] + (2.0 if x == y else -1.0), table[i - 1][j] - 1, table[i][j - 1] - 1
            )
            best = max(best, table[i][j])
    return best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=15))
def test_alignment_equals_the_cells(a, b):
    a, b = np.array(a, np.uint64), np.array(b, np.uint64)
    score, first, last = decontaminate.align(a, b)
    assert score == local_score(a, b)
    if score:
        assert 0 <= first <= last < len(b) and local_score(a, b[first : last + 1]) == score


def leak_corpus():
    rng = random.Random(8)
    words = ["w%d" % i for i in range(900)] + ["the"] * 300
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, text(rng.choice([12, 30, 50]))) for i in range(30)]
    rows, planted = [], set()
    for d in range(200):
        own = text(rng.choice([20, 90, 300]))
        if d % 3 == 0:
            i, item = items[d % 30 if d % 9 else 0]
            copy = list(item)
            for _ in range(len(item) // 8):
                at = rng.randrange(len(copy))
                kind = rng.randrange(3)
                copy[at : at + (kind > 0)] = [] if kind == 2 else [rng.choice(words)]
            at = rng.randrange(len(own))
            own[at:at] = copy
            planted.add((d, i))
        rows.append((d, " ".join(own).upper() if d % 2 else ", ".join(own)))
    return rows, [(i, " ".join(x)) for i, x in items], planted


@pytest.mark.parametrize("block_bytes", [8 << 20, 900])
def test_leaks_equal_full_alignment(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    rows, items, planted = leak_corpus()
    odd = [(900, None), (901, ""), (None, "x " + items[2][1]), rows[3]]
    bench = [*items, (50, None), (51, ""), (None, "the the the"), (52, "the w1"), items[0]]
    docs = spark.createDataFrame([(*r, 5) for r in rows + odd], "doc_id long, text string, leaks int").repartition(3)
    got = decontaminate.find_leaks(docs, spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert len(got) == len(rows) + len(odd)
    split = lambda t: re.findall(r"\w+", t.lower())
    number = {}
    code = lambda t: np.array([number.setdefault(w, len(number)) for w in split(t)], np.uint64)
    expected = set()
    for d, text in rows:
        own = code(text)
        for i, item in items:
            test = code(item)
            if decontaminate.align(test, own)[0] >= 0.5 * 2 * len(test):
                expected.add((d, i))
    found = {(r.doc_id, x.item_id) for r in got for x in r.leaks if r.doc_id is not None and r.doc_id < 900}
    assert planted <= expected and found == expected
    assert [x.item_id for r in got if r.doc_id is None for x in r.leaks] == [2]
    none = decontaminate.find_leaks(docs, spark.createDataFrame([], "item_id long, text string")).collect()
    assert all(r.leaks == [] for r in none) and len(none) == len(got)


@pytest.mark.parametrize("every", [4, 5])
def test_leaks_of_copies_with_every_few_words_changed(spark, every):
    item = ["w%d" % i for i in range(60)]
    copy = [f"new{every}x{i}" if i % every == every - 1 else w for i, w in enumerate(item)]
    late = [f"new{every}y{i}" if i % every == 0 else w for i, w in enumerate(item)]
    around = lambda x: " ".join(["a", "b"] * 20 + x + ["c", "d"] * 20)
    rows = [(1, around(copy)), (2, around(late)), (3, around(item)), (4, around([])), (5, around(item[:20]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "a b a")], "item_id long, text string")
    for some in (docs, docs.where("doc_id != 3")):
        got = {(r.doc_id, x.item_id): x for r in decontaminate.find_leaks(some, bench).collect() for x in r.leaks}
        assert {d for d, i in got if i == 7} == {1, 2, 3} & {r.doc_id for r in some.collect()}
        codes = {w: i for i, w in enumerate(dict.fromkeys(" ".join(t for _, t in rows).split() + item))}
        for d, text in rows[:2]:
            own, test = ([codes[w] for w in x] for x in (text.split(), item))
            assert got[d, 7].score == pytest.approx(local_score(test, own) / 120)


def test_leak_query_equals_full_alignment(spark, small):
    from shelfcast.llm.queries import QUERIES

    code = {}
    word = lambda t: np.array(
        [code.setdefault(w, len(code)) for w in re.findall(r"[^\x00-\x26\x28-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t.translate({i: i + 32 for i in range(65, 91)}))],
        np.uint64,
    )
    items = [(r.item_id, word(r.text)) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    expected = set()
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        own = word(r.text or "")
        for i, test in items:
            if np.isin(test, own).sum() >= 0.5 * len(test) and decontaminate.align(test, own)[0] >= len(test):
                expected.add((r.doc_id, i))
    got = {(r.doc_id, r.item_id) for r in QUERIES["op3_benchmark_leaks"](spark, small).collect()}
    assert got == expected and got


def test_window_network_scores_equal_the_formula(spark):
    docs = [(1, "a b c a b"), (2, "c"), (3, ""), (4, None), (None, "zz a"), (1, "a b c a b")]
    df = spark.createDataFrame([(*r, 0.5) for r in docs], "doc_id long, text string, log_prob double").repartition(2)
    model = lm.train(df, every=1)
    got = {(r.doc_id, r.n_words): r for r in lm.score(df, model).collect()}
    bucket = lambda w: int(lm.buckets(next(lm.slices(lm.pa.array([w]))))[0])
    for d, text in docs:
        words = (text or "").split()
        c = [int(model.classes[bucket(w)]) for w in words]
        total = 0.0
        for i, w in enumerate(words):
            sides = [*range(i - 3, i), *range(i + 1, i + 4)]
            near = [c[j] if 0 <= j < len(c) else lm.EDGE for j in sides]
            h = np.tanh(model.bias + sum(model.near[j][x] for j, x in enumerate(near)))
            logits = (h @ model.out + model.base).astype(float)
            total += logits[c[i]] - np.log(np.exp(logits).sum()) + model.within[bucket(w)]
        r = got[d, len(words)]
        assert r.log_prob == pytest.approx(total, rel=1e-4, abs=1e-6)
        assert r.mean_log_prob == (pytest.approx(total / len(words), rel=1e-4) if words else None)
    probabilities = [
        np.exp(lm.class_log_probability(model, np.full((lm.CLASSES, 6), 3, np.int16), np.arange(lm.CLASSES))).sum()
    ]
    assert probabilities == pytest.approx([1.0], abs=1e-4)
    assert lm.score(df.limit(0), lm.train(df.limit(0))).collect() == []


def test_the_network_learns_from_both_sides(spark):
    rng = random.Random(3)
    pairs = [("l%d" % i, "m%d" % i, "r%d" % i) for i in range(12)]
    text = lambda: " ".join(w for _ in range(40) for w in rng.choice(pairs))
    rows = [(i, text()) for i in range(400)]
    shuffled = [(1000 + i, " ".join(rng.sample(t.split(), len(t.split())))) for i, t in rows[:50]]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm.train(train, every=4, shard=4000)
    test = spark.createDataFrame(rows[:50] + shuffled, "doc_id long, text string")
    got = {r.doc_id: r.mean_log_prob for r in lm.score(test, model).collect()}
    plain = np.mean([got[i] for i in range(50)])
    mixed = np.mean([got[1000 + i] for i in range(50)])
    assert plain > np.log(1 / 36) + 1 > mixed
    again = lm.train(train.repartition(9), every=4, shard=4000)
    assert np.allclose(again.out, model.out, atol=1e-4)


def test_every_position_is_an_example_once(spark):
    texts = ["a b c d e f g " * 30, "h", "", None, "i j", "a b c d e f g " * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = lm.start(lm.corpus_counts(df))
    rows = df.selectExpr("text", "xxhash64(doc_id, text) AS row").repartition(3)
    got = rows.mapInArrow(lambda b: lm._pieces(b, model, 7), "shard int, pieces binary").collect()
    assert len({r.shard for r in got}) > 1
    width = lm.PIECE + 2 * lm.SIDE
    own = [lm.examples(np.frombuffer(r.pieces, np.int16).reshape(-1, width)) for r in got]
    expected = []
    for text in texts:
        s = next(lm.slices(lm.pa.array([text], lm.pa.string())))
        c = model.classes[lm.buckets(s)]
        expected += [(*near, y) for near, y in zip(lm.contexts(s.first, c).tolist(), c.tolist())]
    assert sorted(map(tuple, np.concatenate(own).tolist())) == sorted(expected)


def test_training_takes_every_position(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    plain = lm.fit

    def counted(model, own, *rest):
        seen.add(len(own))
        return plain(model, own, *rest)

    monkeypatch.setattr(lm, "fit", counted)
    df = spark.createDataFrame([(i, "a b c d e " * (i % 40)) for i in range(200)], "doc_id long, text string")
    lm.train(df, shard=2000)
    assert seen.value == 5 * sum(i % 40 for i in range(200))
