"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfcast.checks.q_joins import fulfillment_lines, search_lines
from shelfcast.operators.joins import left_join
from shelfcast.plans.gold import gold
from shelfcast.plans.silver import clean_fulfillment, clean_search
from shelfcast.schemas import SERIES_KEY


def plan(frame):
    return frame._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def count(pattern, text):
    return len(re.findall(pattern, text))


def test_gold_has_two_shuffles_one_scan_and_no_join(spark, small):
    text = plan(entry.queries()["m1_gold_daily"](spark, small))
    assert count(r"Exchange hashpartitioning", text) == 2
    assert count(r"Exchange", text) == 2
    assert count(r"FileScan", text) == 1
    assert "Join" not in text
    # one operator for the day's rank, one for all series columns
    assert count(r"\bWindow \[", text) == 2


def test_gold_drops_old_loads_before_the_shuffle(spark, small):
    text = plan(entry.queries()["w1_latest_per_day"](spark, small))
    below = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


@pytest.mark.parametrize("name", ["m1_gold_daily", "w8_percent_rank_by_day", "w9_temporal_split", "a12_roc_auc"])
def test_no_cartesian_product(spark, small, name):
    text = plan(entry.queries()[name](spark, small))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_percent_rank_window_sees_days_only(spark, small):
    """The only window without a partition stands on the per-day counts."""
    text = plan(entry.queries()["w8_percent_rank_by_day"](spark, small))
    single = text.index("Exchange SinglePartition")
    assert "HashAggregate" in text[single : single + 400]


def test_filters_and_columns_reach_the_scan(spark, small):
    text = plan(entry.queries()["p6_equality_filter"](spark, small))
    assert "EqualTo(l_returnflag,R)" in text
    text = plan(entry.queries()["s1_table_scan"](spark, small))
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>", text)


def test_incremental_read_prunes_partitions(spark, tmp_path):
    from shelfcast.operators.filters import newer_than
    from shelfcast.sources.tables import overwrite_days

    rows = spark.range(60).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 6).cast("int")).alias("d"))
    overwrite_days(rows, str(tmp_path / "t"), "d")
    frame = newer_than(spark.read.parquet(str(tmp_path / "t")), "d", "2024-01-04")
    assert re.search(r"PartitionFilters: \[[^\]]*d#\d+ > ", plan(frame))
    assert frame.count() == 20


def test_large_sides_are_not_broadcast_by_hint(spark, small):
    text = plan(entry.queries()["j1_left_join_two_keys"](spark, small))
    assert "strategy=broadcast" not in text


def test_skewed_fact_side_is_split(spark, small):
    """A third of the facts on one key: AQE cuts that partition on the fact side."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lines = fulfillment_lines(spark, small)
        hot = F.pmod(F.xxhash64("product_tcin", "record_date"), F.lit(3)) == 0
        facts = clean_fulfillment(
            lines.withColumns(
                {
                    "store_id": F.when(hot, 1).otherwise(F.col("store_id")),
                    "product_tcin": F.when(hot, "1").otherwise(F.col("product_tcin")),
                }
            ).repartition(12)
        )
        products = clean_search(search_lines(spark, small)).select(*SERIES_KEY, "price")
        joined = left_join(facts, products, SERIES_KEY)
        expected = (
            facts.groupBy(*SERIES_KEY).count().join(products, SERIES_KEY, "left").agg(F.sum("count")).first()[0]
        )
        joined.collect()  # the final plan is known after an action on this very frame
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == expected
        assert "skew=true" in text or "skewed" in text
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_a_hot_series_is_one_row_per_day_before_its_window(spark):
    """90 % of the raw rows are copies of one series: the series shuffle sees its days only."""
    schema = "store_id int, product_id int, record_date string, silver_load_ts timestamp, available_to_promise_qty double"
    hot = spark.range(20000).select(
        F.lit(1).alias("store_id"), F.lit(1).alias("product_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).cast("string").alias("record_date"),
        F.timestamp_seconds(F.col("id")).alias("silver_load_ts"), (F.col("id") * 1.0).alias("available_to_promise_qty"),
    )
    other = spark.createDataFrame([(2, 1, "2024-01-01", None, 3.0)], schema)
    from shelfcast.plans.silver import SILVER_COLUMNS

    rows = hot.unionByName(other)
    wide = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in SILVER_COLUMNS])
    out = gold(wide, F.lit("2024-03-01").cast("timestamp"))
    got = out.filter("store_id = 1").orderBy("ds").collect()
    assert len(got) == 10
    assert [r["available_to_promise_qty"] for r in got] == [float(19990 + i) for i in range(10)]
