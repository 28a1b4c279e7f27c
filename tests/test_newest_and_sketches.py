"""Newest rows kept by a stream, and column roles from merged sketches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.series import latest_per_key
from shelfcast.plans.silver import clean_search, silver
from shelfcast.schemas import PRODUCT_SEARCH
from shelfcast.sources.column_roles import detect_roles
from shelfcast.sources.load_roles import load_distincts, merged_distincts, merged_roles
from shelfcast.streaming.newest_rows import newest_of_each, take_newest

from .test_jobs import NOW, bronze, facts

KEYS = ["store_id", "product_id"]


def found_products(spark, rows):
    """(store, product, title, load day) as landed search rows."""
    full = [(s, p, t, 5.0, 2.5, "b", 1, 3, "", "c", "", day, "", "") for s, p, t, day in rows]
    return spark.createDataFrame(full, PRODUCT_SEARCH)


def shown(frame):
    return sorted(map(str, frame.collect()))


def test_newest_as_aggregate_equals_ranking(spark):
    days = [None, dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    rows = [(i % 5 or None, days[i % 3], i % 4 or None, f"t{i % 2}" if i % 7 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, day date, n long, t string")
    for newest in (["day"], ["day", "n"]):
        assert shown(newest_of_each(df, ["k"], newest)) == shown(latest_per_key(df, ["k"], newest))
    with pytest.raises(ValueError):
        newest_of_each(df, ["k"], ["t"])


def test_stream_keeps_the_newest_product(spark, tmp_path):
    landing, base, checkpoint = (str(tmp_path / n) for n in ("landing", "tables", "checkpoint"))
    spark.createDataFrame([], PRODUCT_SEARCH).write.parquet(landing)

    def take():
        return take_newest(
            spark, landing, PRODUCT_SEARCH, KEYS, ["load_date"], "newest_products", base, checkpoint, clean_search
        )

    def whole():
        return latest_per_key(clean_search(spark.read.parquet(landing)).dropna(subset=KEYS), KEYS, ["load_date"])

    assert take() is None
    landings = [
        [(1, "10", "a", "2024-02-02"), (1, "11", "b", "2024-02-01"), (1, "10", "b", "2024-02-02"), (1, None, "x", "2024-02-01")],
        [(1, "10", "late", "2024-02-01"), (1, "11", "new", "2024-02-03"), (2, "10", "c", None)],
        [(2, "10", "d", "2024-01-01"), (3, "9", "e", None), (1, "10", "a", "2024-02-02")],
    ]
    for rows in landings:
        found_products(spark, rows).write.mode("append").parquet(landing)
        assert shown(take()) == shown(whole())
    assert shown(take()) == shown(whole()) and whole().count() == 4


def test_stream_ranks_a_batch_once_without_a_state_store(spark, tmp_path):
    landing, base, checkpoint = (str(tmp_path / n) for n in ("landing", "tables", "checkpoint"))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def take(rows):
        landed = spark.createDataFrame(rows, "k long, day date, t string")
        landed.coalesce(1).write.mode("append").parquet(landing)
        before = read.value
        kept = take_newest(
            spark, landing, landed.schema, ["k"], ["day"], "newest_once", base, checkpoint,
            lambda df: df.mapInArrow(counted, df.schema),
        )
        return sorted(map(tuple, kept.collect())), read.value - before

    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    take([(i, one, "a") for i in range(50)])
    found, passed = take([(0, two, "b"), (1, None, "c"), (2, one, "A"), (None, two, "x"), (50, None, "d")])
    assert passed == 5  # each new row once, no old one
    expected = [(0, two, "b"), (1, one, "a"), (2, one, "A"), *[(i, one, "a") for i in range(3, 50)], (50, None, "d")]
    assert found == expected
    assert not (tmp_path / "checkpoint" / "state").exists()


def test_silver_over_kept_products_equals_silver_over_history(spark, tmp_path):
    """The table holds clean rows; as a search input they give the same join."""
    inputs = bronze(spark, search_loads=3)
    fact = facts(spark, [(1, "10", "2024-02-02", 3.0)])
    landing = str(tmp_path / "landing")
    inputs["search"].write.parquet(landing)
    cut = take_newest(
        spark, landing, PRODUCT_SEARCH, KEYS, ["load_date"], "newest_landed", str(tmp_path / "t"), str(tmp_path / "c"),
        lambda rows: rows.withColumn("load_date", F.to_date("load_date")),
    )
    stamp = F.lit(NOW).cast("timestamp")
    got = silver(fulfillment=fact, load_ts=stamp, latest_product_only=True, **{**inputs, "search": cut})
    assert shown(got) == shown(silver(fulfillment=fact, load_ts=stamp, latest_product_only=True, **inputs))
    assert cut.count() == 1


def test_roles_of_merged_loads_equal_roles_of_all_rows(spark):
    frame = spark.range(3000).select(
        F.col("id"),
        (F.col("id") % 100).cast("int").alias("kind"),
        F.concat(F.lit("x"), "id").alias("code"),
        (F.col("id") % 3).cast("string").alias("color"),
        F.when(F.col("id") % 10 == 0, F.col("id")).alias("sparse"),
        F.lit(None).cast("string").alias("empty"),
        F.col("id").alias("store_id"),
        (F.col("id") * 1.5).alias("price"),
        F.lit(True).alias("flag"),
        F.array("id").alias("list"),
        (F.col("id") % 4).alias("load"),
    )
    sketches = load_distincts(frame, "load")
    assert sketches.select("load").distinct().count() == 4
    got = merged_roles(frame.schema, sketches, categorical_columns=["store_id"])
    assert shown(got) == shown(detect_roles(frame, categorical_columns=["store_id"]))
    # A value that all loads have counts once.
    again = load_distincts(frame.withColumn("load", F.lit("more")), "load").unionByName(sketches)
    distinct = {r.column_name: (r.known, r.distinct_values) for r in merged_distincts(again).collect()}
    assert distinct["kind"] == (6000, 100) and distinct["empty"] == (0, 0)
    assert abs(distinct["id"][1] - 3000) < 90 and distinct["id"][0] == 6000
    assert dict(map(tuple, merged_roles(frame.schema, again).collect()))["id"] == "numerical"
    none = load_distincts(frame.limit(0), "load")
    assert dict(map(tuple, merged_roles(frame.schema, none).collect()))["id"] == "numerical"
