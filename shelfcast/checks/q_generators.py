"""Generated tables. Draws are MD5 uniforms, so the SQL reproduces every value."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import draws
from ..operators.joins import choose_observed
from ..plans import fulfillment as ff
from ..plans.dependence import fit_tree, pair_counts, sample_tree
from ..plans.load_marginals import load_sketches, merged_marginals
from ..plans.copula import as_number, cleaned_for_fit, fit_copula, sample_copula
from ..plans.price_snapshot import cart_threshold, price_snapshot
from ..plans.search_snapshot import search_snapshot, varied_price, varied_rating
from ..plans.trends import generated_trends
from ..session import fresh_path
from ..sources.tables import append_aligned
from .q_sinks import fresh_name
from .registry import query, table
from .standins import rounded, sql_uniform

NOW = dt.datetime(2024, 3, 1, 6, 30)
DAY, STAMP = NOW.date().isoformat(), NOW.isoformat()


def sql_between(draw: str, low: float, high: float) -> str:
    return f"({low}::DOUBLE + {draw} * {float(high - low)!r}::DOUBLE)"


def sql_vary(value: str, draw: str, share: float) -> str:
    return f"{value} * (1.0::DOUBLE + {sql_between(draw, -share, share)})"


def sql_price(value: str, *keys: str) -> str:
    return f"(round_even({sql_vary(value, sql_uniform('price', *keys), 0.1)} * 2, 0) / 2)"


def sql_rating(value: str, *keys: str) -> str:
    return f"greatest(0.0::DOUBLE, least(5.0::DOUBLE, {sql_vary(value, sql_uniform('rating', *keys), 0.1)}))"


@query(
    "g1_varied_price",
    f"SELECT p_partkey, {sql_price('p_retailprice', 'p_partkey')} AS price FROM part",
)
def price_variation(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", varied_price("p_retailprice", "p_partkey").alias("price")
    )


@query(
    "g2_varied_rating",
    f"SELECT p_partkey, round({sql_rating('(p_size / 10.0::DOUBLE)', 'p_partkey')}, 6) AS rating FROM part",
)
def rating_variation(spark, folder):
    rows = table(spark, folder, "part").withColumn("rating", F.col("p_size") / 10)
    return rounded(rows.select("p_partkey", varied_rating("rating", "p_partkey").alias("rating")))


@query(
    "g3_draws",
    f"""WITH drawn AS (SELECT o_orderkey, {sql_uniform('a', 'o_orderkey')} AS a,
  {sql_uniform('b', 'o_orderkey')} AS b FROM orders),
brands AS (SELECT p_brand, row_number() OVER (ORDER BY md5(p_brand), p_brand) - 1 AS i
  FROM (SELECT DISTINCT p_brand FROM part) d)
SELECT o_orderkey, CAST(floor(a * 200) AS BIGINT) AS reviews, a < 0.4 AS on_sale,
  CASE WHEN a < 0.9 THEN 'reg' ELSE 'was' END AS comparison,
  CASE CAST(floor(b * 3) AS INT) WHEN 0 THEN 'x' WHEN 1 THEN 'y' ELSE 'z' END AS listed,
  p_brand
FROM drawn JOIN brands ON i = floor(b * (SELECT count(*) FROM brands))""",
)
def all_draws(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        draws.uniform("a", "o_orderkey").alias("a"),
        draws.uniform("b", "o_orderkey").alias("b"),
    )
    chosen = choose_observed(rows, "b", table(spark, folder, "part"), "p_brand")
    return chosen.select(
        "o_orderkey",
        draws.integer(F.col("a"), 0, 200).alias("reviews"),
        draws.bernoulli(F.col("a"), 0.4).alias("on_sale"),
        draws.weighted_choice(F.col("a"), [("reg", 0.9), ("was", 0.1)]).alias("comparison"),
        draws.choice(F.col("b"), ["x", "y", "z"]).alias("listed"),
        "p_brand",
    )


# --- search snapshot ----------------------------------------------------------------------------------

TEXTS = {
    "url_prefix": "https://shop.example/p/",
    "category": "Seasonal Decor",
    "keyword": "seasonal_decor",
    "default_brand": "House Brand",
}


def seed_products(spark, folder):
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") / 10).alias("rating"),
    )


def store_list(spark, folder):
    return table(spark, folder, "nation").select(F.col("n_nationkey").cast("long").alias("store_id"))


def search_rows(spark, folder):
    return search_snapshot(
        seed_products(spark, folder), store_list(spark, folder), NOW.date(), NOW, **TEXTS
    )


KEYS = ("store_id", "product_id", "load_date")


def search_sql(stores: str, key: str) -> str:
    return f"""
grid AS (
  SELECT CAST({key} AS BIGINT) AS store_id, CAST(p_partkey AS VARCHAR) AS product_id, p_name AS title,
    p_retailprice AS base_price, p_size / 10.0::DOUBLE AS base_rating, '{DAY}' AS load_date FROM {stores}, part
),
search AS (
  SELECT store_id, product_id, title, {sql_price('base_price', *KEYS)} AS price,
    {sql_rating('base_rating', *KEYS)} AS rating, 'House Brand' AS brand,
    CAST(floor({sql_uniform('availability', *KEYS)} * 2) AS BIGINT) AS availability,
    CAST(floor({sql_uniform('reviews', *KEYS)} * 200) AS BIGINT) AS reviews,
    'https://shop.example/p/' || product_id AS url, 'Seasonal Decor' AS category,
    'seasonal_decor' AS keyword, load_date, '{STAMP}' AS load_timestamp, '{STAMP}' AS record_date
  FROM grid
)"""


SEARCH_SQL = search_sql("nation", "n_nationkey")


@query(
    "g4_search_snapshot",
    f"WITH {SEARCH_SQL} SELECT * REPLACE (round(rating, 6) AS rating) FROM search",
)
def search_snapshot_rows(spark, folder):
    return rounded(search_rows(spark, folder))


# --- price snapshot -----------------------------------------------------------------------------------

PRICE_KEYS = ("store_id", "product_id", "searched_at", "days_back")
CENTS = ("CAST(round(price * 100, 0) AS BIGINT)",)


def sql_threshold() -> str:
    noise = (
        f"sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {sql_uniform('threshold-1', *CENTS)})) "
        f"* cos(2.0::DOUBLE * pi() * {sql_uniform('threshold-2', *CENTS)})"
    )
    mean = "CASE WHEN price < 150 THEN 15.0::DOUBLE WHEN price < 200 THEN 12.0::DOUBLE ELSE 18.0::DOUBLE END"
    return f"CAST(floor(greatest(1.0::DOUBLE, least(20.0::DOUBLE, {mean} + {noise} * 5.0::DOUBLE))) AS BIGINT)"


def sql_spread(salt: str, low: float, high: float) -> str:
    drawn = sql_between(sql_uniform(salt, *PRICE_KEYS), low, high)
    return f"round(CASE WHEN is_current_price_range THEN price * {drawn} ELSE price END, 2)"


def sql_markup(value: str, salt: str) -> str:
    draw = sql_uniform(salt, *PRICE_KEYS)
    return (
        f"round({value} * CASE WHEN formatted_current_price_type = 'sale' THEN {sql_between(draw, 1.1, 1.3)} "
        f"ELSE {sql_between(draw, 1.0, 1.05)} END, 2)"
    )


def sql_label(low: str, high: str) -> str:
    return (
        f"CASE WHEN is_current_price_range THEN printf('$%.2f - $%.2f', {low}, {high}) "
        f"ELSE printf('$%.2f', {low}) END"
    )


PRICES_SQL = f"""
days AS (
  SELECT store_id, product_id, price, record_date AS searched_at, unnest(range(1, 8)) AS days_back
  FROM search WHERE price IS NOT NULL
),
drawn AS (
  SELECT *, {sql_uniform('range', *PRICE_KEYS)} < 0.4 AS is_current_price_range,
    CASE WHEN {sql_uniform('sale', *PRICE_KEYS)} < 0.4 THEN 'sale' ELSE 'reg' END AS formatted_current_price_type,
    CASE WHEN {sql_uniform('comparison', *PRICE_KEYS)} < 0.9 THEN 'reg' ELSE 'was' END
      AS formatted_comparison_price_type
  FROM days
),
spread AS (
  SELECT *, {sql_spread('low', 0.90, 0.98)} AS current_retail_min,
    {sql_spread('high', 1.02, 1.10)} AS current_retail_max FROM drawn
),
marked AS (
  SELECT *, {sql_markup('current_retail_min', 'regular-low')} AS a,
    {sql_markup('current_retail_max', 'regular-high')} AS b FROM spread
),
prices AS (
  SELECT store_id, product_id, price,
    CAST('{STAMP}' AS TIMESTAMP) - INTERVAL 1 DAY * days_back AS record_date, is_current_price_range,
    formatted_current_price_type, formatted_comparison_price_type, current_retail_min, current_retail_max,
    least(a, b) AS reg_retail_min, greatest(a, b) AS reg_retail_max,
    {sql_threshold()} AS cart_add_on_threshold,
    {sql_label('current_retail_min', 'current_retail_max')} AS formatted_current_price,
    {sql_label('least(a, b)', 'greatest(a, b)')} AS formatted_comparison_price
  FROM marked
)"""


@query("g5_price_snapshot", f"WITH {SEARCH_SQL}, {PRICES_SQL} SELECT * FROM prices")
def price_snapshot_rows(spark, folder):
    return price_snapshot(search_rows(spark, folder))


@query("g5_price_unparsable_date", f"WITH {SEARCH_SQL}, {PRICES_SQL} SELECT * FROM prices")
def price_snapshot_beside_unreadable_times(spark, folder):
    """Old priced rows whose time cannot be read change nothing."""
    rows = search_rows(spark, folder)
    unread = rows.withColumn("record_date", F.lit("unknown")).withColumn("load_date", F.lit("2000-01-01"))
    return price_snapshot(rows.unionByName(unread))


@query(
    "g6_cart_threshold",
    f"SELECT p_partkey, {sql_threshold()} AS threshold FROM "
    "(SELECT p_partkey, p_retailprice / 5 AS price FROM part) p",
)
def threshold_of_price(spark, folder):
    rows = table(spark, folder, "part").withColumn("price", F.col("p_retailprice") / 5)
    return rows.select("p_partkey", cart_threshold("price").alias("threshold"))


# --- trends, fulfillment ------------------------------------------------------------------------------

def trend_sql(keywords: str) -> str:
    return f"""
steps AS (
  SELECT keyword, region, CAST(step AS INT) AS step, CAST(DATE '{DAY}' - 89 + CAST(step AS INT) AS DATE) AS day
  FROM (SELECT keyword, region, unnest(range(0, 90)) AS step FROM ({keywords}) k) x
),
trend AS (
  SELECT CAST(day AS TIMESTAMP) AS dt, keyword, region,
    CAST(round_even(greatest(0.0::DOUBLE, least(100.0::DOUBLE, 20.0::DOUBLE + step / 90.0::DOUBLE * 40.0::DOUBLE
      + CASE WHEN step > 76 THEN 25.0::DOUBLE ELSE 0.0::DOUBLE END
      + {sql_between(sql_uniform('trend', 'keyword', 'region', 'day'), -5.0, 5.0)})), 0) AS BIGINT)
      AS interest_score,
    FALSE AS isPartial, '{DAY}' AS load_date, '{STAMP}' AS load_timestamp FROM steps
)"""


@query(
    "g7_trend_series",
    f"WITH {trend_sql('SELECT DISTINCT p_name AS keyword, p_brand AS region FROM part')} SELECT * FROM trend",
)
def trend_series(spark, folder):
    """A series per product name and brand."""
    keywords = table(spark, folder, "part").select(
        F.col("p_name").alias("keyword"), F.col("p_brand").alias("region")
    )
    return generated_trends(keywords.distinct(), NOW.date(), NOW)


def sql_dates(source: str) -> str:
    day = sql_uniform("day", "row_id")
    early, late = sql_uniform("earliest", "row_id"), sql_uniform("latest", "row_id")
    return f"""
dated AS (
  SELECT *, CAST(DATE '{DAY}' - 6 + CAST(floor({day} * 7) AS INT) AS DATE) AS day,
    CAST(1 + floor({early} * 2) AS INT) AS d1, CAST(1 + floor({late} * 2) AS INT) AS d2 FROM {source}
)"""


DATES_SQL = (
    "CAST(day AS VARCHAR) AS record_date, CAST(day + d1 AS TIMESTAMP) AS min_delivery_date, "
    "CAST(day + d1 + d2 AS TIMESTAMP) AS max_delivery_date"
)


@query(
    "g8_delivery_dates",
    f"WITH ids AS (SELECT o_orderkey AS row_id FROM orders), {sql_dates('ids')} "
    f"SELECT row_id, {DATES_SQL} FROM dated",
)
def delivery_dates(spark, folder):
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").alias("row_id"))
    return ff.with_delivery_dates(rows, NOW.date())


@query(
    "g9_row_count_rule",
    "WITH pairs AS (SELECT DISTINCT user_id, event_type FROM events) "
    "SELECT unnest(range(greatest((SELECT count(*) FROM pairs) * 7, 1000))) AS row_id",
)
def row_count_rule(spark, folder):
    pairs = table(spark, folder, "events").select("user_id", "event_type").distinct()
    return ff.row_ids(spark, ff.rows_needed(pairs.count()))


def fulfillment_sql(pairs: str) -> str:
    """Rows for the (store_id, tcin) pairs in a CTE of that name."""
    u = sql_uniform
    return f"""
numbered AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(store_id AS VARCHAR), tcin)),
    store_id, tcin) - 1 AS pair FROM {pairs}),
ids AS (SELECT unnest(range(greatest((SELECT count(*) FROM {pairs}) * 7, 1000))) AS row_id),
assigned AS (SELECT row_id, store_id, tcin FROM ids
  JOIN numbered ON row_id % (SELECT count(*) FROM {pairs}) = pair),
{sql_dates('assigned')},
fulfillment AS (
  SELECT store_id, tcin, tcin AS product_tcin, {DATES_SQL}, '{DAY}' AS load_date, '{STAMP}' AS load_timestamp,
    CASE WHEN {u('empty', 'row_id')} < 0.15 THEN 0.0::DOUBLE
      ELSE CAST(1 + floor({u('qty', 'row_id')} * 60) AS DOUBLE) END AS available_to_promise_qty,
    CASE WHEN {u('sold', 'row_id')} < 0.1 THEN 'true' WHEN {u('sold', 'row_id')} < 0.95 THEN 'false'
      ELSE '' END AS is_sold_out,
    CASE WHEN {u('everywhere', 'row_id')} < 0.02 THEN 'true' ELSE 'false' END AS is_out_of_stock_in_all_stores,
    CASE WHEN {u('two-day', 'row_id')} < 0.5 THEN 'true' ELSE 'false' END AS is_two_day_shipping,
    CASE WHEN {u('base', 'row_id')} < 0.5 THEN 'true' ELSE 'false' END AS is_base_shipping_method,
    CASE CAST(floor({u('method', 'row_id')} * 3) AS INT) WHEN 0 THEN 'Standard' WHEN 1 THEN 'Express'
      ELSE 'Same Day' END AS shipping_method_short_description,
    CASE WHEN {u('status', 'row_id')} < 0.85 THEN 'IN_STOCK' ELSE 'OUT_OF_STOCK' END
      AS shipping_availability_status,
    CASE CAST(floor({u('charge', 'row_id')} * 3) AS INT) WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 5.99::DOUBLE
      ELSE 9.99::DOUBLE END AS charge_one_day
  FROM dated
)"""


FULFILLMENT_COLUMNS = [
    "store_id",
    "tcin",
    "product_tcin",
    "record_date",
    "min_delivery_date",
    "max_delivery_date",
    "load_date",
    "load_timestamp",
    "available_to_promise_qty",
    "is_sold_out",
    "is_out_of_stock_in_all_stores",
    "is_two_day_shipping",
    "is_base_shipping_method",
    "shipping_method_short_description",
    "shipping_availability_status",
    "charge_one_day",
]


@query(
    "g13_fulfillment_load",
    "WITH pairs AS (SELECT DISTINCT user_id AS store_id, event_type AS tcin FROM events "
    "WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)), "
    f"{fulfillment_sql('pairs')} SELECT {', '.join(FULFILLMENT_COLUMNS)} FROM fulfillment",
)
def fulfillment_loader(spark, folder):
    """Pairs of the latest load (day), rows, dates, ids, and the append to the table."""
    search = table(spark, folder, "events").select(
        F.col("user_id").alias("store_id"),
        F.col("event_type").alias("product_id"),
        F.col("ts").cast("date").cast("string").alias("load_date"),
    )
    pairs = ff.latest_pairs(search)
    sampled = ff.drawn_attributes(ff.row_ids(spark, ff.rows_needed(pairs.count())))
    rows = ff.fulfillment_load(sampled, pairs, NOW.date(), NOW)
    written = append_aligned(spark, fresh_name("fulfillment"), rows, fresh_path(spark, "tables"))
    return written.select(*FULFILLMENT_COLUMNS)


# --- copula: checked by its statistics in the unit tests ----------------------------------------------

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


SHARES_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS name, {c} AS value, round(count(*) / sum(count(*)) OVER (), 9) AS share "
    f"FROM lineitem GROUP BY {c}"
    for c in ("l_returnflag", "l_linestatus")
)


@query("g10_category_shares", SHARES_SQL)
def category_shares(spark, folder):
    """The fitted shares of categories, as steps of their cumulative shares."""
    model = fit_copula(table(spark, folder, "lineitem"), [], ["l_returnflag", "l_linestatus"])
    rows = [
        (m.name, value, high - low)
        for m in model.marginals
        for value, low, high in zip(m.categories, [0.0, *m.reached], m.reached)
    ]
    fitted = spark.createDataFrame(rows, "name string, value string, share double")
    return fitted.withColumn("share", F.round("share", 9))


def ranks_near(lines, marginals, error):
    """A row a column and quantile: whether its rank among all rows is within ``error`` of its share.

    A task counts its rows below and up to each quantile, a sorted batch at a time; the counts are summed. NaN is
    the largest value, as in Spark's order.
    """
    grids = [(m.name, list(m.quantiles)) for m in marginals]
    columns = [as_number(m.name, lines.schema[m.name].dataType).alias(m.name) for m in marginals]

    def counted(batches):
        counts = [np.zeros((2, len(grid)), np.int64) for _, grid in grids]
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for (name, grid), own in zip(grids, counts):
                values = np.sort(batch.column(name).drop_null().to_numpy(zero_copy_only=False))
                own += [np.searchsorted(values, grid, side) for side in ("left", "right")]
        for (name, grid), (below, upto) in zip(grids, counts):
            size = len(grid)
            arrays = [pa.array([name] * size), pa.array(range(size), pa.int32()), pa.array(below), pa.array(upto)]
            names = ["name", "position", "below", "upto", "rows"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([rows] * size, pa.int64())], names)

    parts = lines.select(*columns).mapInArrow(counted, "name string, position int, below long, upto long, rows long")
    n, share = F.sum("rows"), F.col("position") / 200
    near = (F.sum("below") / n <= share + error) & (F.sum("upto") / n >= share - error)
    return parts.groupBy("name", "position").agg(near.alias("near"), n.alias("rows"))


@query(
    "g10_quantile_ranks",
    "SELECT name, CAST(i AS INT) AS position, TRUE AS near, n.rows FROM (VALUES "
    + ", ".join(f"('{c}')" for c in MEASURES)
    + ") t(name), generate_series(0, 200) s(i), (SELECT count(*) AS rows FROM lineitem) n",
)
def quantile_ranks(spark, folder):
    """Each fitted quantile has its rank in the table, within the stated error of the quantile sketch."""
    lines = table(spark, folder, "lineitem")
    return ranks_near(lines, fit_copula(lines, MEASURES).marginals, 2e-4)


def closeness(sample, lines, names):
    """A row a column: how many rows were sampled, and whether mean, deviation and relation fit."""
    def stats(df):
        values = [f(c) for c in names for f in (F.avg, F.stddev_pop)]
        pairs = [F.corr(a, b) for a, b in zip(names, [*names[1:], names[0]])]
        return list(df.agg(F.count(F.lit(1)), *values, *pairs).first())

    (n, *got), (_, *real) = stats(sample), stats(lines)
    rows = []
    for i, name in enumerate(names):
        scale = real[2 * i + 1] or 1.0
        mean = abs(got[2 * i] - real[2 * i]) <= 0.1 * scale
        spread = abs(got[2 * i + 1] - real[2 * i + 1]) <= 0.1 * scale
        relation = abs(got[2 * len(names) + i] - real[2 * len(names) + i]) <= 0.1
        rows.append((name, n, bool(mean), bool(spread), bool(relation)))
    return sample.sparkSession.createDataFrame(
        rows, "name string, rows long, mean_fits boolean, spread_fits boolean, relation_fits boolean"
    )


def closeness_sql(names):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS name, count(*) AS rows, TRUE AS mean_fits, TRUE AS spread_fits, TRUE AS relation_fits "
        "FROM lineitem"
        for c in names
    )


@query("g11_sample_fits", closeness_sql(MEASURES))
def sample_fits(spark, folder):
    return closeness(copula_sample(spark, folder), table(spark, folder, "lineitem"), MEASURES)


@query("g12_mixed_sample_fits", closeness_sql([*MEASURES, "l_linenumber"]))
def mixed_sample_fits(spark, folder):
    names = [*MEASURES, "l_linenumber"]
    return closeness(mixed_copula_sample(spark, folder), table(spark, folder, "lineitem"), names)


@query(
    "g12_many_categories",
    "SELECT count(*) AS rows, TRUE AS all_known, TRUE AS most_seen FROM lineitem",
)
def many_categories(spark, folder):
    """A column of thousands of codes, kept as a table, beside a day and a number."""
    lines = table(spark, folder, "lineitem").select(
        F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias("code"),
        F.col("l_shipdate").cast("date").alias("day"),
        "l_quantity",
    )
    model = fit_copula(lines, ["l_quantity"], ["code"], listed=100, datetimes=["day"])
    sample = sample_copula(spark, model, lines.count())
    codes = lines.select("code").distinct()
    marked = sample.join(codes.withColumn("known", F.lit(True)), "code", "left")
    return marked.agg(
        F.count(F.lit(1)).alias("rows"),
        F.every(F.coalesce("known", F.lit(False))).alias("all_known"),
        (F.count_distinct("code") >= 0.8 * codes.count()).alias("most_seen"),
    )


@query(
    "g10_merged_sketches",
    "SELECT name, CAST(i AS INT) AS position, TRUE AS near, n.rows FROM (VALUES "
    + ", ".join(f"('{c}')" for c in MEASURES)
    + ") t(name), generate_series(0, 200) s(i), (SELECT count(*) AS rows FROM lineitem) n",
)
def merged_sketches(spark, folder):
    """Quantiles merged from the sketches of each month's load have their ranks in the whole table."""
    lines = table(spark, folder, "lineitem").withColumn("month", F.trunc("l_shipdate", "month"))
    path = fresh_path(spark, "load-sketches")
    load_sketches(lines, "month", MEASURES).write.parquet(path)
    return ranks_near(lines, merged_marginals(lines, spark.read.parquet(path), numeric=MEASURES), 5e-3)


DEPENDENT = """SELECT l_returnflag AS flag, l_linestatus AS status, l_returnflag || (l_linenumber % 2) AS service,
  CASE WHEN l_quantity < 10 THEN 'few' WHEN l_linestatus = 'O' THEN 'open' END AS size FROM lineitem"""
DEPENDENT_COLUMNS = ("flag", "status", "service", "size")


@query(
    "g12_pairwise_shares",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {a} AS u, {b} AS v, TRUE AS fits FROM ({DEPENDENT}) x GROUP BY ALL"
        for i, a in enumerate(DEPENDENT_COLUMNS)
        for b in DEPENDENT_COLUMNS[i + 1 :]
    ),
)
def pairwise_shares(spark, folder):
    """Each pair of values that meet in the table meets as often in the sample, and no other pair does."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.concat("l_returnflag", (F.col("l_linenumber") % 2).cast("string")).alias("service"),
        F.when(F.col("l_quantity") < 10, "few").when(F.col("l_linestatus") == "O", "open").alias("size"),
        "l_quantity",
    )
    model = fit_tree(lines, DEPENDENT_COLUMNS, ["l_quantity"])
    n = lines.count()
    sample = sample_tree(spark, model, n)
    missing = "\x00"

    def met(df, name):
        texts = df.select(*[F.coalesce(c, F.lit(missing)).alias(c) for c in DEPENDENT_COLUMNS])
        return pair_counts(texts, DEPENDENT_COLUMNS).withColumnRenamed("n", name)

    both = met(lines, "real").join(met(sample, "drawn"), ["a", "b", "u", "v"], "full")
    close = F.abs(F.coalesce("real", F.lit(0)) - F.coalesce("drawn", F.lit(0))) <= 0.02 * n
    # Two columns that both depend on a third may meet by chance where they never met.
    seen = F.col("drawn").isNotNull() & F.col("real").isNotNull()
    known = lambda c: F.when(F.col(c) != missing, F.col(c)).alias(c)
    return both.where("real IS NOT NULL OR drawn > 0").select("a", "b", known("u"), known("v"), (close & seen).alias("fits"))


@query("g10_copula_fit")
def copula_fit(spark, folder):
    """The fitted correlation of each pair of columns."""
    model = fit_copula(table(spark, folder, "lineitem"), MEASURES)
    pairs = [
        (a, b, float(model.correlation[i, j]))
        for i, a in enumerate(model.names)
        for j, b in enumerate(model.names)
        if i < j
    ]
    return spark.createDataFrame(pairs, "first string, second string, correlation double")


@query("g11_copula_sample")
def copula_sample(spark, folder):
    """As many sampled rows as the table has."""
    lines = table(spark, folder, "lineitem")
    return sample_copula(spark, fit_copula(lines, MEASURES), lines.count())


@query("g12_mixed_copula_sample")
def mixed_copula_sample(spark, folder):
    """Clean-up, fit and sample with categorical columns beside the numbers."""
    lines = table(spark, folder, "lineitem").select(
        *MEASURES, "l_linenumber", "l_returnflag", "l_linestatus"
    )
    model = fit_copula(
        cleaned_for_fit(lines), [*MEASURES, "l_linenumber"], ["l_returnflag", "l_linestatus"]
    )
    return sample_copula(spark, model, lines.count())
