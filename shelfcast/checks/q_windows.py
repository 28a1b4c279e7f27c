"""Windows, the label, the split and the gold table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.series import (
    change_over,
    horizon_frame,
    latest_per_key,
    rolling_frame,
    stockout_ahead,
    with_windows,
)
from ..operators.splits import with_percent_rank, with_split
from ..plans.gold import GOLD_COLUMNS
from ..schemas import GOLD_KEY, SERIES_KEY
from ..session import fresh_path
from ..streaming.newest_rows import take_newest
from .q_sinks import fresh_name
from .registry import query, table
from .standins import DAILY_SQL, GOLD_SQL, SILVER_SQL, daily, gold_rows, gold_select, rounded, silver_rows

KEYS = ", ".join(GOLD_KEY)
GOLD_SHOWN = [c for c in GOLD_COLUMNS if c not in ("gold_load_ts",)]


@query("m1_gold_daily", gold_select(GOLD_SHOWN))
def gold_daily(spark, folder):
    return rounded(gold_rows(spark, folder).select(*GOLD_SHOWN))


@query(
    "w1_latest_per_day",
    f"WITH {SILVER_SQL} SELECT {KEYS}, arg_max(event_id, (silver_load_ts, event_id)) AS event_id "
    f"FROM fact GROUP BY {KEYS}",
)
def latest_per_day(spark, folder):
    rows = silver_rows(spark, folder).select(
        F.col("store_id").cast("int").alias("store_id"),
        F.col("product_id").cast("int").alias("product_id"),
        F.col("record_date").cast("date").alias("ds"),
        "silver_load_ts",
        "event_id",
    )
    latest = latest_per_key(rows, GOLD_KEY, ["silver_load_ts", "event_id"])
    return latest.select(*GOLD_KEY, "event_id")


@query(
    "w1_latest_by_stream",
    "SELECT l_partkey, l_suppkey, l_shipdate, l_orderkey, l_linenumber FROM "
    "(SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS l_shipdate, l_orderkey, l_linenumber, row_number() OVER "
    "(PARTITION BY l_partkey, l_suppkey ORDER BY CAST(l_shipdate AS DATE) DESC, l_orderkey, l_linenumber) AS n "
    "FROM lineitem) WHERE n = 1",
)
def latest_by_stream(spark, folder):
    """The newest line of each part and supplier, kept by a stream over two landings, the newer days first."""
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_orderkey", "l_linenumber"
    )
    landing, base, checkpoint = (fresh_path(spark, x) for x in ("landing", "tables", "newest"))
    name = fresh_name("newest")
    for newer in (True, False):
        lines.filter((F.year("l_shipdate") >= 1995) == newer).write.mode("append").parquet(landing)
        found = take_newest(
            spark, landing, lines.schema, ["l_partkey", "l_suppkey"], ["l_shipdate"], name, base, checkpoint
        )
    return found


def _rolling(name, source, aggregate):
    @query(name, gold_select([*GOLD_KEY, source[1]], "rolled"))
    def run(spark, folder):
        column, alias = source
        rows = daily(spark, folder).select(*GOLD_KEY, column)
        added = with_windows(
            rows, SERIES_KEY, "ds", lambda w: {alias: aggregate(column).over(rolling_frame(w))}
        )
        return rounded(added.select(*GOLD_KEY, alias))

    return run


_rolling("w2_rolling_avg", ("available_to_promise_qty", "inv_7d_avg"), F.avg)
_rolling("w3_rolling_min", ("available_to_promise_qty", "inv_7d_min"), F.min)
_rolling("w4_rolling_max", ("available_to_promise_qty", "inv_7d_max"), F.max)
_rolling("w5_rolling_stddev", ("available_to_promise_qty", "inv_7d_std"), F.stddev_samp)
_rolling("w6_rolling_trend", ("google_trend_score", "trend_7d_avg"), F.avg)


@query(
    "w7_change_over_7_rows",
    gold_select([*GOLD_KEY, "price_change_7d", "rating_change_7d", "reviews_change_7d"], "rolled"),
)
def change_7_rows(spark, folder):
    rows = daily(spark, folder)
    added = with_windows(
        rows,
        SERIES_KEY,
        "ds",
        lambda w: {
            "price_change_7d": change_over("price", w),
            "rating_change_7d": change_over("rating", w),
            "reviews_change_7d": change_over("number_of_reviews", w),
        },
    )
    return rounded(added.select(*GOLD_KEY, "price_change_7d", "rating_change_7d", "reviews_change_7d"))


@query(
    "w8_percent_rank_by_day",
    f"WITH {DAILY_SQL} SELECT {KEYS}, round(percent_rank() OVER (ORDER BY ds), 9) AS day_rank FROM daily",
)
def percent_rank_by_day(spark, folder):
    ranked = with_percent_rank(daily(spark, folder).select(*GOLD_KEY), "ds")
    return ranked.withColumn("day_rank", F.round("day_rank", 9))


@query(
    "w9_temporal_split",
    f"WITH {DAILY_SQL} SELECT {KEYS}, CASE WHEN percent_rank() OVER (ORDER BY ds) < 0.70 "
    "THEN 'train' ELSE 'test' END AS split FROM daily",
)
def temporal_split(spark, folder):
    return with_split(daily(spark, folder).select(*GOLD_KEY), "ds")


def _labelled(spark, folder, censor_empty):
    rows = gold_rows(spark, folder).select(*GOLD_KEY, "is_oos_today")
    return with_windows(
        rows,
        SERIES_KEY,
        "ds",
        lambda w: {
            "stockout_next_7d": stockout_ahead(F.col("is_oos_today"), horizon_frame(w), censor_empty)
        },
    ).select(*GOLD_KEY, "stockout_next_7d")


@query("w10_stockout_label", gold_select([*GOLD_KEY, "stockout_next_7d"]))
def stockout_label(spark, folder):
    return _labelled(spark, folder, False)


@query(
    "w10_stockout_label_censored",
    f"WITH {GOLD_SQL} SELECT {KEYS}, CASE WHEN later_rows > 0 THEN any_oos = 1 END AS stockout_next_7d FROM ahead",
)
def stockout_label_censored(spark, folder):
    return _labelled(spark, folder, True)


@query(
    "o1_sorted_output",
    f"WITH {GOLD_SQL} SELECT {KEYS}, stockout_next_7d FROM gold ORDER BY {KEYS}",
)
def sorted_output(spark, folder):
    return gold_rows(spark, folder).select(*GOLD_KEY, "stockout_next_7d").orderBy(*GOLD_KEY)
