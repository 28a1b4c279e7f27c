"""The corpus pipeline: every stage's decisions take effect, and odd rows pass."""

import random
import zlib

import corpus_pipeline
from corpus_pipeline import COLUMNS, STAGES, run


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def corpus(spark, folder):
    rng = random.Random(6)
    words = ["w%d" % i for i in range(2000)]
    text = lambda n=60: " ".join(rng.choice(words) for _ in range(n))
    item = text(30)
    rows = []
    for d in range(400):
        own = [text(), text(), "the same line in every other document of this corpus"][: 3 if d % 2 else 2]
        if d % 10 == 0:
            own[0] += " vile"
        rows.append([d, "\n".join(own)])
    base = text(300).split()
    for d in range(400, 420):  # near copies, each on one long line with its own words
        own = list(base)
        own[rng.randrange(300)] = "c%d" % d
        own[rng.randrange(300)] = "long-%d-word" % d
        rows.append([d, " ".join(own)])
    rows.append([420, text() + " " + item + " " + text()])
    rows.append([421, rows[401][1]])
    rows += [[422, None], [423, ""], [None, text()], [424, "short"], [424, "short"]]
    full = [(d, t, "en", rng.choice(["a", "b", None]), len(t or ""), 1) for d, t in rows]
    write(spark, folder, "documents", full, "doc_id long, text string, lang string, source string, n_chars long, extra int")
    labels = [(d, 1, int(d % 10 == 0)) for d in range(400) if d % 7]
    write(spark, folder, "labels", labels, "doc_id long, quality int, toxic int")
    write(spark, folder, "benchmark", [(1, item), (2, None)], "item_id long, text string")
    return full


def test_stages(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in STAGES:
        before = docs
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        if name != STAGES[-1][0]:
            assert docs.columns == COLUMNS
            assert docs.schema["n_chars"].dataType == before.schema["n_chars"].dataType
    assert [name for name, _ in STAGES] == ["toxicity", "line_dedup", "near_copies", "benchmark_leaks", "source_mix"]

    ids = {name: [r.doc_id for r in out] for name, out in seen.items()}
    kept = set(ids["toxicity"])
    toxic = {d for d in range(0, 400, 10)}
    held = {d for d in toxic if zlib.crc32(str(d).encode()) % 5 == 0}
    assert not kept & toxic and held and len(ids["toxicity"]) == len(rows) - len(toxic)

    lines = {r.doc_id: r.text for r in seen["line_dedup"]}
    hot = "the same line in every other document of this corpus"
    assert [d for d, t in lines.items() if t and hot in t] == [1]
    assert 421 not in lines and lines[422] is None and lines[423] == "" and ids["line_dedup"].count(424) == 2
    assert all(r.n_chars == len(r.text or "") for r in seen["line_dedup"])

    near = set(ids["near_copies"])
    assert near & set(range(400, 420)) == {400} and None in near and {1, 3, 422, 423} <= near
    assert set(ids["near_copies"]) - set(ids["benchmark_leaks"]) == {420}
    plan = seen["source_mix"]
    assert sorted(map(str, ids["source_mix"])) == sorted(map(str, ids["benchmark_leaks"]))
    assert all(0 <= r.taken <= 3 * r.size for r in plan) and sum(r.taken for r in plan) > 0


def test_run_reads_and_writes_each_stage(spark, tmp_path):
    folder = str(tmp_path / "in")
    corpus(spark, folder)
    assert corpus_pipeline.ORACLE_SQL is None
    first, again = (sorted(map(str, run(spark, folder).collect())) for _ in range(2))
    assert first == again and first


def test_empty_documents(spark, tmp_path):
    folder = str(tmp_path / "in")
    corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in STAGES:
        assert stage(spark, docs, folder).collect() == []
