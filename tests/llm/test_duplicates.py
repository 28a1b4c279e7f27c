"""Line, document and passage deduplication against brute force."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from shelfcast.llm import components as component_steps, line_dedup, sketch_dedup, substring_dedup
from shelfcast.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"
ODD = [
    (90_001, None),
    (90_002, ""),
    (90_003, " \n\t \n"),
    (90_004, "one"),
    (90_005, "one"),
    (90_006, "ONE"),
    (None, "one"),
    (None, None),
]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("abé", max_size=14), st.text("abé", max_size=14), st.integers(0, 3))
def test_within_is_the_edit_distance(a, b, edits):
    assert line_dedup.within(a, b, edits) == (distance(a, b) <= edits)


def edited(rng, text, times):
    text = list(text)
    for _ in range(times):
        at = rng.randrange(len(text) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            text.insert(at, rng.choice("abcxyz"))
        elif text:
            at = min(at, len(text) - 1)
            if kind == 1:
                text[at] = rng.choice("abcxyz")
            else:
                del text[at]
    return "".join(text)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9), st.integers(0, 3), st.integers(8, 40))
def test_near_lines_share_a_key(seed, edits, length):
    rng = random.Random(seed)
    a = "".join(rng.choice("abcd é") for _ in range(length))
    b = edited(rng, a, rng.randint(0, edits))
    line, key, own, parity, pairs = line_dedup.signatures([a, b], edits, 4)
    probes = [set(key[line == i].tolist()) for i in (0, 1)]
    index = [set(key[(line == i) & own].tolist()) for i in (0, 1)]
    assert probes[0] & index[1] or probes[1] & index[0]
    assert (int(parity[0]) ^ int(parity[1])).bit_count() <= 2 * edits
    assert (int(pairs[0]) ^ int(pairs[1])).bit_count() <= 4 * edits


def lines_brute(rows, edits=2, shortest=20):
    every = sorted(
        {(d, n, x.strip()) for d, t in rows if d is not None and t is not None for n, x in enumerate(t.split("\n"))}
    )
    every = [x for x in every if len(x[2]) >= shortest]
    gone = set()
    for i, (d, n, x) in enumerate(every):
        if any(
            (e, m) < (d, n) and abs(len(x) - len(y)) <= edits and line_dedup.within(x, y, edits)
            for e, m, y in every[:i]
        ):
            gone.add((d, n))
    return gone


def line_corpus(seed=3):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(15, 60))) for _ in range(40)]
    stem = "a template of many lines that share a long start and end number "
    rows = []
    for d in range(120):
        lines = [edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 6))]
        if d % 2:
            lines.append(stem + "%05d" % rng.randrange(100_000))
        if d % 3 == 0:
            lines.append("  the very same line of a third of all rows \t")
        rows.append((d, "\n".join(lines)))
    return [*rows, rows[5], *ODD]


@pytest.mark.parametrize("few", [1, 8])
def test_lines_equal_brute_force(spark, few):
    rows = line_corpus()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", n_lines int, extra string").repartition(5)
    got = line_dedup.without_repeated_lines(df, few=few).collect()
    gone = lines_brute(rows)
    assert len(got) == len(rows) and len(gone) > 60
    assert {(r.doc_id, n) for r in got for n in r.removed if r.doc_id is not None} == gone
    texts = dict(rows)
    for r in got:
        assert r.extra == "x"
        if r.doc_id is not None and texts[r.doc_id] is not None:
            lines = texts[r.doc_id].split("\n")
            assert r.n_lines == len(lines) and r.n_removed == len(r.removed)
            assert r.text == "\n".join(x for n, x in enumerate(lines) if n not in r.removed)
    odd = {r.doc_id: r for r in got}
    assert odd[90_001].text is None and odd[90_001].n_lines == 0
    assert odd[90_002].n_lines == 1 and odd[90_003].n_lines == 3


@pytest.mark.parametrize("few", [2, 8])
def test_lines_of_one_key_go_to_many_groups(spark, monkeypatch, few):
    monkeypatch.setattr(line_dedup, "HOT", 40)
    monkeypatch.setattr(line_dedup, "SOME", 1)
    monkeypatch.setattr(line_dedup, "_BLOCK", 16)
    rng = random.Random(few)
    rows = [(i, "\n".join("Posted 2024-01-02 by user %06d" % rng.randrange(10**6) for _ in range(2))) for i in range(150)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {(r.doc_id, r.line) for r in line_dedup.repeated_lines(df, few=few).collect()}
    assert got == set(lines_brute(rows)) and got
    one = [(7, i, (i << 32) | 1, 0) for i in range(400)]
    keyed = spark.createDataFrame(one, "key long, doc_id long, packed long, pairs long")
    parted = line_dedup._parted(keyed, keyed.groupBy("key").agg(line_dedup.F.count("*").alias("rows"))).collect()
    groups, met = {}, set()
    for r in parted:
        groups.setdefault(r.part >> 1, []).append((r.doc_id, r.part & 1))
    for own in groups.values():
        two = any(s for _, s in own)
        met |= {(a, b) for a, s in own for b, t in own if a < b and (s != t or not two)}
    assert len(met) == 400 * 399 // 2 and max(map(len, groups.values())) < 160


def test_line_query_equals_brute_force(spark, small):
    from shelfcast.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    gone = lines_brute(rows)
    got = QUERIES["op1_line_dedup"](spark, small).collect()
    assert {(r.doc_id, n) for r in got for n in r.removed} == gone and len(got) == len(rows) and gone
    for r in got:
        lines = dict(rows)[r.doc_id].split("\n")
        kept = "\n".join(x for n, x in enumerate(lines) if (r.doc_id, n) not in gone)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def shingles(text, n):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if 0 < len(words) < n:
        return {tuple(words)}
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def copies_brute(rows, n=4, percent=80):
    sets = [(d, shingles(t, n)) for d, t in rows]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if d is None or e is None or not a or not b:
                continue
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                x, y = sorted((root(d), root(e)))
                up[y] = x
    return {(d, len(s), None if d is None else root(d), d is None or root(d) == d) for d, s in sets}


def near_corpus(seed=1):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(3000)]
    boiler = [rng.choice(words) for _ in range(60)]
    rows = []
    for g in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([3, 10, 40, 120]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append(" ".join(own + (boiler if g % 3 == 0 else [])))
    large = [rng.choice(words) for _ in range(150)]
    for i in range(90):
        own = list(large)
        own[rng.randrange(150)] = "v%d" % i
        own[rng.randrange(150)] = "u%d" % i
        rows.append(" ".join(own))
    for i in range(30):  # mostly boilerplate
        rows.append(" ".join(boiler + [rng.choice(words) for _ in range(rng.choice([4, 10, 16]))]))
    rows = list(enumerate(rows))
    return [*rows, rows[3], *((200 + i, "the same text of many rows here") for i in range(80)), *ODD]


@pytest.mark.parametrize("long", [4, 64])
def test_near_copies_equal_brute_force(spark, long):
    rows = near_corpus()
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", kept int").repartition(4)
    got = sketch_dedup.near_copies(df, n=4, percent=80, long=long).collect()
    assert len(got) == len(rows)
    assert {tuple(r) for r in got} == copies_brute(rows)


@pytest.mark.parametrize("larger", [33, 37, 39, 40])
def test_sets_listed_whole_meet_larger_ones(spark, larger):
    rng = random.Random(larger)
    rows = []
    for i in range(150):
        own = ["%x" % rng.getrandbits(60) for _ in range(larger + 3)]
        rows += [(2 * i, " ".join(own[:35])), (2 * i + 1, " ".join(own))]
    got = sketch_dedup.near_copies(spark.createDataFrame(rows, SCHEMA), n=4, percent=80).collect()
    assert {r.n_shingles for r in got} == {32, larger}
    assert [r for r in got if r.component_id != r.doc_id // 2 * 2] == []


@pytest.mark.parametrize("listed, less, larger", [(32, 32, 40), (32, 26, 32), (512, 512, 640), (512, 508, 635), (512, 504, 630)])
def test_lists_cut_on_one_side_only(spark, listed, less, larger):
    rng = random.Random(larger)
    entries = []
    for i in range(120):
        own = [rng.getrandbits(62) for _ in range(larger)]
        entries += [(x, 2 * i, less) for x in sorted(own[:less])[:listed]]
        entries += [(x, 2 * i + 1, larger) for x in sorted(own)[:listed]]
    df = spark.createDataFrame(entries, "value long, id long, n long")
    pairs, _ = sketch_dedup._meet(df, listed, sketch_dedup.LONG, 80)
    assert {(r.a, r.b) for r in pairs.collect()} == {(2 * i, 2 * i + 1) for i in range(120)}


def test_a_large_group_of_near_copies_takes_a_few_pairs_each(spark, monkeypatch):
    rng = random.Random(8)
    base = ["b%d" % i for i in range(144)]
    rows = []
    for i in range(700):
        own = list(base)
        for _ in range(rng.choice([0, 1, 2, 2, 3, 3, 4])):
            own[rng.randrange(144)] = "x%x" % rng.getrandbits(50)
        rows.append((i, " ".join(own)))
    compared = []
    written = sketch_dedup.written

    def counted(spark, df, label):
        out = written(spark, df, label)
        if label in ("sketch-pairs", "sketch-rest"):
            compared.append(out.count())
        return out

    monkeypatch.setattr(sketch_dedup, "written", counted)
    got = sketch_dedup.near_copies(spark.createDataFrame(rows, SCHEMA).repartition(4), n=4, percent=80).collect()
    assert {tuple(r) for r in got} == copies_brute(rows)
    assert sum(compared) < 10 * len(rows)


def test_near_copy_query_equals_brute_force(spark, small):
    from shelfcast.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op5_near_copies"](spark, small).collect()
    assert {tuple(r) for r in got} == copies_brute(rows) and len(got) == len(rows)


def test_components_of_long_and_wide_groups(spark):
    rng = random.Random(2)
    path = list(range(1000, 1060))
    rng.shuffle(path)
    edges = [*zip(path, path[1:]), *((7, x) for x in range(8, 60)), (3, 4), (4, 3), (5, 5)]
    got = dict(map(tuple, components(spark, spark.createDataFrame(edges, "u long, v long")).collect()))
    assert {got[x] for x in path} == {1000} and {got[x] for x in range(7, 60)} == {7}
    assert got[3] == got[4] == 3


def counted_writes(monkeypatch, *modules):
    labels = []
    for module in modules:
        def counted(spark, df, label, write=module.written):
            labels.append(label)
            return write(spark, df, label)

        monkeypatch.setattr(module, "written", counted)
    return labels


@pytest.mark.parametrize("few, writes", [(1 << 20, 2), (100, None)])
def test_few_links_are_joined_up_in_one_task(spark, monkeypatch, few, writes):
    rng = random.Random(3)
    path = list(range(-50, 150))
    rng.shuffle(path)
    edges = [*zip(path, path[1:]), *((900, x) for x in range(901, 960)), (2**40, -(2**40)), (7, 7), (700, 700)]
    labels = counted_writes(monkeypatch, component_steps)
    df = spark.createDataFrame(edges, "u long, v long").repartition(4)
    got = sorted(map(tuple, components(spark, df, few).collect()))
    expected = [*((x, -50) for x in path), *((x, 900) for x in range(900, 960)), (2**40, -(2**40)), (-(2**40), -(2**40))]
    assert got == sorted(expected)
    assert len(labels) == (writes or len(labels))
    assert components(spark, df.where("u = v"), few).collect() == []


def test_no_round_over_lists_that_are_closed(spark, monkeypatch):
    base = ["b%d" % i for i in range(150)]
    rows = [(i, " ".join([*base, *("x%d" % j for j in range(i % 5))])) for i in range(90)]
    rows += [(100 + i, " ".join(base[: 149 - i])) for i in range(8)]
    labels = counted_writes(monkeypatch, sketch_dedup)
    got = sketch_dedup.near_copies(spark.createDataFrame(rows, SCHEMA), n=4, percent=80, long=4).collect()
    assert {tuple(r) for r in got} == copies_brute(rows) and {r.component_id for r in got} == {0}
    assert labels.count("sketch-rest") == 1


def passages_brute(rows, window=20):
    first = {}
    words = {}
    for d, t in rows:
        own = WORD.findall(t or "")
        words[d] = own
        if d is not None:
            for i in range(len(own) - window + 1):
                key = tuple(own[i : i + window])
                first[key] = min(first.get(key, (d, i)), (d, i))
    out = set()
    for d, t in rows:
        own = WORD.findall(t or "")
        gone = set()
        if d is not None:
            for i in range(len(own) - window + 1):
                if first[tuple(own[i : i + window])] < (d, i):
                    gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(own) if i not in gone)
        out.add((d, len(own), len(gone), kept))
    return out


def passage_corpus(seed=4):
    rng = random.Random(seed)
    words = ["a", "b", "É", "d.", "E,", "f"] + ["w%d" % i for i in range(400)]
    shared = [[rng.choice(words) for _ in range(rng.choice([19, 20, 21, 55]))] for _ in range(6)]
    rows = []
    for d in range(150):
        own = [rng.choice(words) for _ in range(rng.choice([0, 5, 30, 90]))]
        for _ in range(rng.randrange(3)):
            own[rng.randrange(len(own) + 1) :] = rng.choice(shared) + own[:7]
        rows.append((d, "\n ".join(own)))
    rows += [(300, "z " * 70), (301, "y x " * 40), (302, "z " * 30)]
    rng.shuffle(rows)
    return [*rows, rows[7], *ODD]


@pytest.mark.parametrize("parts", [1, 6])
def test_passages_equal_brute_force(spark, parts):
    rows = passage_corpus()
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", kept string").repartition(parts)
    got = substring_dedup.without_repeats(df).collect()
    assert len(got) == len(rows)
    expected = passages_brute(rows)
    assert {tuple(r) for r in got} == expected and sum(x[2] for x in expected) > 1000


def test_passage_query_equals_brute_force(spark, small):
    from shelfcast.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op9_repeated_passages"](spark, small).collect()
    assert {tuple(r) for r in got} == {
        (d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in passages_brute(rows)
    }


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert line_dedup.without_repeated_lines(none).collect() == []
    assert sketch_dedup.near_copies(none).collect() == []
    assert substring_dedup.without_repeats(none).collect() == []


def test_very_long_text(spark):
    rng = random.Random(9)
    long = " ".join("w%d" % rng.randrange(5000) for _ in range(60_000))
    rows = [(1, long), (2, long + " end"), (3, "x " + long[: len(long) // 2])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {(r.doc_id, r.component_id) for r in sketch_dedup.near_copies(df).collect()} == {(1, 1), (2, 1), (3, 3)}
    assert {tuple(r) for r in substring_dedup.without_repeats(df).collect()} == passages_brute(rows)
    assert {(r.doc_id, r.n_removed) for r in line_dedup.without_repeated_lines(df).collect()} == {(1, 0), (2, 0), (3, 0)}
