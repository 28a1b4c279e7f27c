import datetime as dt
import random

import pytest
from pyspark.sql import functions as F, types as T

from shelfcast.operators import aggregates, bounds, columns, filters, indexing, joins, metrics, series, splits, upserts

KEY = ["s", "p"]


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def labels(spark, days, oos, censor=False):
    rows = [(1, 1, day(d), o) for d, o in zip(days, oos, strict=True)]
    frame = spark.createDataFrame(rows, "s int, p int, ds date, oos boolean")
    labelled = series.with_windows(
        frame, KEY, "ds",
        lambda w: {"y": series.stockout_ahead(F.col("oos"), series.horizon_frame(w), censor)},
    )
    return [r["y"] for r in labelled.orderBy("ds").collect()]


def test_empty_horizon_is_true_or_censored(spark):
    days = [0, 1, 20]  # nothing in the week after day 1, nothing after the last
    assert labels(spark, days, [False] * 3) == [False, True, True]
    assert labels(spark, days, [False] * 3, censor=True) == [False, None, None]


def test_horizon_is_seven_days_and_null_counts_as_in_stock(spark):
    assert labels(spark, [0, 7, 8], [False, True, False])[0] is True
    assert labels(spark, [0, 7, 8], [False, None, True])[0] is False


def test_rolling_frame_counts_rows_not_days(spark):
    rows = [(1, 1, day(10 * i), float(i)) for i in range(9)]
    frame = spark.createDataFrame(rows, "s int, p int, ds date, q double")
    out = series.with_windows(
        frame, KEY, "ds",
        lambda w: {
            "low": F.min("q").over(series.rolling_frame(w)),
            "std": F.stddev_samp("q").over(series.rolling_frame(w)),
            "change": series.change_over("q", w),
        },
    ).orderBy("ds").collect()
    assert [r["low"] for r in out] == [0, 0, 0, 0, 0, 0, 0, 1, 2]
    assert out[0]["std"] is None and out[1]["std"] is not None
    assert [r["change"] for r in out] == [None] * 7 + [7.0, 7.0]


def test_latest_per_key_has_a_total_order(spark):
    rows = [(1, 5, "b", i) for i in range(20)] + [(1, 5, "a", 99), (1, 4, "z", 0)]
    expected = (1, 5, "a", 99)
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "k int, at int, x string, y int").repartition(4)
        assert tuple(series.latest_per_key(frame, ["k"], ["at"]).first()) == expected


def test_split_never_divides_a_day(spark):
    rows = [(day(0),)] * 6 + [(day(1),)] * 3 + [(day(2),)]
    frame = spark.createDataFrame(rows, "ds date")
    got = splits.with_split(frame, "ds").groupBy("ds").agg(F.collect_set("split").alias("x")).orderBy("ds").collect()
    # percent ranks: 0, 6/9, 9/9
    assert [r["x"] for r in got] == [["train"], ["train"], ["test"]]


def test_split_of_one_day_and_of_one_row(spark):
    frame = spark.createDataFrame([(day(0),)] * 4, "ds date")
    assert {r["split"] for r in splits.with_split(frame, "ds").collect()} == {"train"}
    ranked = splits.with_percent_rank(spark.createDataFrame([(day(0),)], "ds date"), "ds")
    assert ranked.first()["day_rank"] == 0.0


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [1, 2, 7, 1024])
def test_auc_equals_brute_force_for_any_buckets(spark, buckets):
    rng = random.Random(buckets)
    # a third of the rows share one score
    rows = [(rng.randint(0, 1), 0.5 if rng.random() < 0.33 else round(rng.random(), 2)) for _ in range(400)]
    frame = spark.createDataFrame(rows, "y int, s double")
    assert abs(metrics.roc_auc(frame, "y", "s", buckets).first()[0] - brute_auc(rows)) < 1e-12


def test_auc_of_one_class_or_no_rows_is_null(spark):
    frame = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, s double")
    assert metrics.roc_auc(frame, "y", "s").first()[0] is None
    assert metrics.roc_auc(frame.limit(0), "y", "s").first()[0] is None


def test_f1_without_positives_is_zero(spark):
    frame = spark.createDataFrame([(0, 0), (0, 0)], "y int, z int")
    assert frame.agg(metrics.f1("y", "z")).first()[0] == 0.0
    frame = spark.createDataFrame([(1, 0), (0, 0)], "y int, z int")
    assert frame.agg(metrics.f1("y", "z"), metrics.accuracy("y", "z")).first()[:] == (0.0, 0.5)


def test_dense_index_is_dense_and_repeatable(spark):
    frame = spark.range(5000).withColumn("t", F.concat(F.lit("k"), F.col("id").cast("string")))
    one = {r["t"]: r["row_index"] for r in indexing.dense_index(frame, ["t"]).collect()}
    two = {r["t"]: r["row_index"] for r in indexing.dense_index(frame.repartition(9), ["t"], hex_digits=1).collect()}
    assert sorted(one.values()) == list(range(5000))
    assert one == two


def test_sums_below(spark):
    rows = [(x, x % 5) for x in random.Random(1).sample(range(10000), 500)]
    frame = spark.createDataFrame(rows, "x int, n int")
    for buckets in (1, 3, 100):
        got = {r["x"]: r["below_n"] for r in indexing.sums_below(frame, "x", ["n"], buckets).collect()}
        assert got == {x: sum(m for y, m in rows if y < x) for x, _ in rows}


def test_store_grid_same_for_list_table_and_unmeasured_table(spark, monkeypatch):
    products = spark.createDataFrame([("a",), ("b",), ("c",)], "product_id string")
    stores = spark.createDataFrame([(i,) for i in range(10)], "store_id int")
    listed = {tuple(r) for r in joins.store_grid(products, list(range(10))).collect()}
    assert {tuple(r) for r in joins.store_grid(products, stores).collect()} == listed
    monkeypatch.setattr(bounds, "estimated_bytes", lambda _: 2**62)  # too large to broadcast
    assert {tuple(r) for r in joins.store_grid(products, stores, chunks=3).collect()} == listed
    assert len(listed) == 30


def test_salted_join_cuts_a_hot_key_and_keeps_every_row(spark):
    hot = spark.range(600).select(F.lit(1).alias("k"), (F.col("id") % 3).alias("v"))  # exact copies too
    rest = spark.range(1200).select((F.col("id") % 40 + 2).cast("int").alias("k"), F.col("id").alias("v"))
    none = spark.createDataFrame([(None, 7)], "k int, v long")
    fact = hot.unionByName(rest).unionByName(none).repartition(8)
    side = spark.createDataFrame([(1, "a"), (1, "b"), (5, "c"), (99, "d")], "k int, w string")
    side = series.latest_per_key(side, ["k", "w"], [])
    assert [(r["k"], r["_parts"]) for r in joins.hot_keys(fact, ["k"], 100).collect()] == [(1, 2)]
    joined = joins.salted_left_join(fact, side, ["k"], hot_rows=100)
    plain = fact.join(side, ["k"], "left")
    assert joined.columns == plain.columns
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))
    assert "_part" in joined._jdf.queryExecution().toString()
    assert "_part" not in joins.salted_left_join(fact, side, ["k"])._jdf.queryExecution().toString()


def test_positions_are_even(spark):
    pairs = spark.createDataFrame([(i,) for i in range(7)], "k int")
    got = joins.assign_by_position(spark.range(100), "id", pairs, ["k"]).groupBy("k").count().collect()
    assert sorted(r["count"] for r in got) == [14] * 5 + [15] * 2


def test_not_in_keeps_null_keys(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    seen = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert {r["k"] for r in joins.not_in(rows, seen, ["k"]).collect()} == {2, None}


def test_broadcast_only_below_the_limit(spark):
    frame = spark.range(1000)
    assert bounds.estimated_bytes(frame) == 16000
    assert "Hint broadcast" in str(bounds.broadcast_if_small(frame)._jdf.queryExecution().logical())
    assert bounds.broadcast_if_small(frame, 100) is frame


def test_align_to(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    frame = spark.createDataFrame([("x", 1, True)], "extra string, a int, other boolean")
    aligned = columns.align_to(frame, schema)
    assert aligned.schema.fieldNames() == ["a", "b"]
    assert [f.dataType for f in aligned.schema] == [T.LongType(), T.StringType()]
    assert tuple(aligned.first()) == (1, None)


def test_fill_by_type(spark):
    frame = spark.createDataFrame([(None, None, None, float("nan"))], "a string, b int, c boolean, d double")
    assert tuple(columns.fill_by_type(frame).first()) == ("", 0, False, 0.0)


def test_watermark_of_nothing(spark):
    empty = spark.createDataFrame([], "d string")
    assert aggregates.watermark(empty, "d") == dt.date(1900, 1, 1)
    assert aggregates.watermark(None, "d") == dt.date(1900, 1, 1)
    one = spark.createDataFrame([("2024-05-06",)], "d string")
    assert aggregates.watermark(one, "d") == dt.date(2024, 5, 6)
    assert filters.newer_than(one, "d", dt.date(2024, 5, 6)).count() == 0


def test_require_unique(spark):
    frame = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError, match="not unique"):
        aggregates.require_unique(frame, ["k"])
    assert aggregates.require_unique(frame.distinct(), ["k"]).count() == 1


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    stage = spark.createDataFrame([("b", 3), ("b", 4), ("c", 5)], "k string, v int")
    once = upserts.upserted(target, stage, ["k"], ["v"])
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 4), ("c", 5)]
    twice = upserts.upserted(once, stage, ["k"], ["v"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    none = upserts.upserted(target, stage.limit(0), ["k"])
    assert sorted(map(tuple, none.collect())) == [("a", 1), ("b", 2)]


def test_latest_row_of_nothing(spark):
    empty = spark.createDataFrame([], "id string, at timestamp")
    assert aggregates.latest_row(empty, "at", ["id", "at"]).first() is None
