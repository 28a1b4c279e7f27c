"""Features, model and alerts.

The fitted model depends on an iterative solver, so its queries are checked by row count here and
against an independent solver in the unit tests.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans import model as lr
from ..plans.alerts import alert_messages, candidates, new_alerts, send_alerts
from ..plans.daily_run import Run, run_all, update_features, update_scores
from ..plans.features import feature_table, loader_rows, prepared
from ..plans.trends import generated_trends
from ..schemas import DATASET, EVENT_KEY, FEATURES, LOADER_FEATURES
from ..session import fresh_path
from ..sources.tables import append_aligned, replace_table
from .q_generators import (
    NOW,
    PRICES_SQL,
    STAMP,
    TEXTS,
    fulfillment_sql,
    search_sql,
    seed_products,
    trend_sql,
)
from .q_sinks import fresh_name
from .registry import query, table
from .standins import (
    GOLD_DOUBLES,
    GOLD_SQL,
    LOG_SQL,
    PREDICTIONS_SQL,
    ROLLED_SQL,
    alert_log_rows,
    gold_rows,
    prediction_rows,
    rounded,
)

SIDE = "CASE WHEN percent_rank() OVER (ORDER BY ds) < 0.70 THEN 'train' ELSE 'test' END"
FEATURES_SQL = f"{GOLD_SQL}, sided AS (SELECT *, {SIDE} AS split FROM gold)"


def shown(columns):
    return ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" if c in GOLD_DOUBLES else c for c in columns)


@query(
    "m2_feature_table",
    f"WITH {FEATURES_SQL} SELECT store_id, product_id, ds AS event_date, {shown(FEATURES)}, brand, category, "
    "stockout_next_7d AS stockout_label, split FROM sided",
)
def features(spark, folder):
    return rounded(feature_table(gold_rows(spark, folder)))


for _side, _split in (("train", "train"), ("valid", "test")):

    @query(
        f"m3_load_{_side}",
        f"WITH {FEATURES_SQL} SELECT store_id, product_id, ds, stockout_next_7d AS label, "
        f"{shown(LOADER_FEATURES)} FROM sided WHERE split = '{_split}'",
    )
    def load_side(spark, folder, side=_side):
        return rounded(loader_rows(gold_rows(spark, folder), side))


PREPARED_SQL = (
    f"{FEATURES_SQL}, prepared AS (SELECT store_id, product_id, ds AS event_date, split, "
    + ", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0) AS {c}" for c in FEATURES)
    + ", CAST(stockout_next_7d AS INT) AS label FROM sided)"
)


def rounded_features(source: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in FEATURES) + f", label FROM {source}"


@query(
    "m4_prepared_features",
    f"WITH {PREPARED_SQL} SELECT store_id, product_id, event_date, {rounded_features('prepared')}",
)
def prepared_features(spark, folder):
    return rounded(prepared(feature_table(gold_rows(spark, folder)), *EVENT_KEY))


SCALED_SQL = (
    f"{PREPARED_SQL}, stats AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES)
    + " FROM prepared WHERE split = 'train'), scaled AS (SELECT store_id, product_id, event_date, label, "
    + ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END AS {c}" for c in FEATURES)
    + " FROM prepared, stats)"
)


@query(
    "m5_standardised_features",
    f"WITH {SCALED_SQL} SELECT store_id, product_id, event_date, {rounded_features('scaled')}",
)
def standardised(spark, folder):
    rows = prepared(feature_table(gold_rows(spark, folder)), *EVENT_KEY, "split")
    scaler, _ = lr.fit_scaler(rows.filter(F.col("split") == "train"))
    return rounded(rows.select(*EVENT_KEY, *scaler.columns(), "label"))


def stored_features(spark, folder):
    """The feature table, written once: fitting reads it many times."""
    path = fresh_path(spark, "features")
    feature_table(gold_rows(spark, folder)).write.parquet(path)
    return spark.read.parquet(path)


@query("m6_logistic_regression")
def logistic_regression(spark, folder):
    model = lr.fit(stored_features(spark, folder))
    rows = [*zip(FEATURES, model.coefficients, strict=True), ("intercept", model.intercept)]
    return spark.createDataFrame(rows, "term string, weight double")


@query(
    "m6_gradient_at_the_fit",
    f"WITH {SCALED_SQL} SELECT t.term, 0.0 AS gradient, n.rows FROM (VALUES "
    + ", ".join(f"('{name}')" for name in [*FEATURES, "intercept"])
    + ") t(term), (SELECT count(*) AS rows FROM prepared WHERE split = 'train') n",
)
def gradient_at_the_fit(spark, folder):
    """The problem is convex: the weights are right where the penalised loss has no slope."""
    rows = stored_features(spark, folder).filter(F.col("split") == "train")
    model = lr.fit(rows)
    train = prepared(rows)
    miss = model.probability() - F.col("label")
    slopes = [F.sum(miss * model.scaler.scaled(i)) + F.lit(w) for i, w in enumerate(model.coefficients)]
    n = F.count(F.lit(1))
    terms = [
        F.struct(F.lit(name).alias("term"), F.round(F.abs(slope / n), 4).alias("gradient"), n.alias("rows"))
        for name, slope in zip([*FEATURES, "intercept"], [*slopes, F.sum(miss)], strict=True)
    ]
    return train.agg(F.array(*terms).alias("terms")).select(F.inline("terms"))


@query("m7_probability_and_flag")
def probability_and_flag(spark, folder):
    rows = stored_features(spark, folder)
    scored = lr.with_scores(prepared(rows, *EVENT_KEY), lr.fit(rows))
    return scored.select(*EVENT_KEY, "predicted_stockout_proba", "predicted_stockout_flag")


# Weights that need no fitting, so that SQL can apply them too.
WEIGHTS = {name: (-1.0) ** i / (i + 1) for i, name in enumerate(FEATURES)}
INTERCEPT = -0.5


def model_of_given_weights(rows):
    scaler, _ = lr.fit_scaler(prepared(rows.filter(F.col("split") == "train")))
    return lr.StockoutModel(scaler, list(WEIGHTS.values()), INTERCEPT)


GIVEN_PROBA = (
    f"1 / (1 + exp(-({INTERCEPT}::DOUBLE + "
    + " + ".join(f"{w!r}::DOUBLE * {c}" for c, w in WEIGHTS.items())
    + ")))"
)


@query(
    "m7_probability_of_given_weights",
    f"WITH {SCALED_SQL} SELECT store_id, product_id, event_date, round(p, 9) AS predicted_stockout_proba, "
    f"CAST(p >= 0.5 AS INT) AS predicted_stockout_flag FROM (SELECT *, {GIVEN_PROBA} AS p FROM scaled) x",
)
def probability_of_given_weights(spark, folder):
    rows = stored_features(spark, folder)
    scored = lr.with_scores(prepared(rows, *EVENT_KEY), model_of_given_weights(rows))
    return rounded(scored.select(*EVENT_KEY, "predicted_stockout_proba", "predicted_stockout_flag"), 9)


@query("m8_predictions_table")
def predictions_table(spark, folder):
    rows = stored_features(spark, folder)
    return lr.predictions(rows, lr.fit(rows))


@query(
    "m8_predictions_consistency",
    f"WITH {GOLD_SQL} SELECT store_id, product_id, ds AS event_date, stockout_next_7d AS stockout_label, "
    "TRUE AS flag_agrees, TRUE AS proba_in_range FROM gold",
)
def predictions_consistency(spark, folder):
    """Every gold row is scored once; its flag follows from its probability."""
    rows = stored_features(spark, folder)
    proba = F.col("predicted_stockout_proba")
    return lr.predictions(rows, lr.fit(rows)).select(
        *EVENT_KEY,
        "stockout_label",
        ((proba >= 0.5).cast("int") == F.col("predicted_stockout_flag")).alias("flag_agrees"),
        ((proba > 0) & (proba < 1)).alias("proba_in_range"),
    )


def two_loads_of_gold(spark, folder):
    """A run whose features were made of all but the last days, then of those."""
    base = fresh_path(spark, "by-day")
    run = Run(spark, base, fresh_name("days"), NOW)
    gold = replace_table(spark, run.name("gold"), gold_rows(spark, folder), base, ["ds"])
    last = gold.agg(F.max("ds")).first()[0] - dt.timedelta(days=5)
    update_features(run, gold.filter(F.col("ds") < F.lit(last)))
    return run, gold, last


@query(
    "m2_features_by_day",
    f"WITH {FEATURES_SQL} SELECT store_id, product_id, ds AS event_date, {shown(FEATURES)}, brand, category, "
    "stockout_next_7d AS stockout_label, split FROM sided",
)
def features_by_day(spark, folder):
    """New days are added, and the split of all days follows the new counts."""
    run, gold, last = two_loads_of_gold(spark, folder)
    return rounded(update_features(run, gold, last).drop("created_at"))


@query(
    "m8_new_days_only",
    f"WITH {SCALED_SQL} SELECT store_id, product_id, event_date, round(p, 9) AS predicted_stockout_proba, "
    f"CAST(p >= 0.5 AS INT) AS predicted_stockout_flag FROM (SELECT *, {GIVEN_PROBA} AS p FROM scaled) x",
)
def scores_of_new_days(spark, folder):
    """A model scores the old days, then only the new ones; together they are the whole table."""
    run, gold, last = two_loads_of_gold(spark, folder)
    features = update_features(run, gold, last)
    model = model_of_given_weights(features)
    update_scores(run, features.filter(F.col("event_date") < F.lit(last)), model)
    scored = update_scores(run, features, model, last)
    return rounded(scored.select(*EVENT_KEY, "predicted_stockout_proba", "predicted_stockout_flag"), 9)


@query("m9_evaluation_record")
def evaluation_record(spark, folder):
    rows = stored_features(spark, folder)
    return lr.metrics_json(lr.evaluation(rows, lr.fit(rows)))


@query(
    "m9_evaluation_of_scores",
    f"""WITH {PREDICTIONS_SQL},
scored AS (SELECT CAST(stockout_label AS INT) AS y, predicted_stockout_flag AS z, predicted_stockout_proba AS s,
  {SIDE.replace('ds', 'event_date')} AS split FROM predictions),
sides AS (SELECT split, avg(CAST(y = z AS DOUBLE)) AS acc, 2.0 * sum(y * z) / (sum(y) + sum(z)) AS f1
  FROM scored GROUP BY split),
ranked AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r
  FROM scored WHERE split = 'test'),
sums AS (SELECT sum(CASE WHEN y = 1 THEN r END) AS ranks, CAST(sum(y) AS DOUBLE) AS p,
  CAST(count(*) - sum(y) AS DOUBLE) AS n FROM ranked)
SELECT round(a.acc, 9) AS train_acc, round(a.f1, 9) AS train_f1, round(b.acc, 9) AS valid_acc,
  round(b.f1, 9) AS valid_f1, round((ranks - p * (p + 1) / 2) / (p * n), 9) AS valid_roc_auc
FROM sides a, sides b, sums WHERE a.split = 'train' AND b.split = 'test'""",
)
def evaluation_of_scores(spark, folder):
    """The record of scores that SQL knows; read back from its JSON."""
    sides = feature_table(gold_rows(spark, folder)).select(*EVENT_KEY, "split")
    scored = prediction_rows(spark, folder).join(sides, EVENT_KEY)
    record = lr.metrics_json(
        lr.evaluation_of(scored.withColumn("label", F.col("stockout_label").cast("int")))
    )
    names = ["train_acc", "train_f1", "valid_acc", "valid_f1", "valid_roc_auc"]
    values = [F.get_json_object("metrics", f"$.{n}").cast("double").alias(n) for n in names]
    return rounded(record.select(*values), 9)


RUN_ID, VERSION_ID = (
    f"'{prefix}' || substr(md5('F|{STAMP}|{what}'), 1, 8)" for prefix, what in (("run_", "run"), ("mv_", "version"))
)


@query(
    "m10_registry_rows",
    f"""WITH latest AS (SELECT {RUN_ID} AS run_id, {VERSION_ID} AS version_id,
  lpad(CAST(arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS VARCHAR), 12, '0') AS dataset_id,
  'train_acc,train_f1,valid_acc,valid_f1,valid_roc_auc' AS metric_names FROM orders WHERE o_orderstatus = 'F')
SELECT run_id AS id, 'F' AS model_id, dataset_id AS parent,
  '{{"model":"logistic_regression","scaler":"standard"}}' AS params, metric_names, 'success' AS status FROM latest
UNION ALL SELECT version_id, 'F', run_id, NULL, metric_names, 'candidate' FROM latest""",
)
def registry(spark, folder):
    """The dataset of each order status is its latest order; the model's one is looked up."""
    rows = stored_features(spark, folder)
    metrics = lr.metrics_json(lr.evaluation(rows, lr.fit(rows)))
    datasets = table(spark, folder, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("dataset_id"),
        F.col("o_orderstatus").alias("model_id"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )
    dataset_id = lr.latest_dataset(datasets.select(*DATASET.fieldNames()), "F")
    run, version = lr.registry_rows(metrics, "F", dataset_id, "predictions", STAMP)
    names = "concat_ws(',', json_object_keys({})) AS metric_names"
    rows = run.selectExpr(
        "run_id AS id", "model_id", "dataset_id AS parent", "params", names.format("metrics"), "status"
    )
    return rows.unionByName(
        version.selectExpr(
            "model_version_id AS id",
            "model_id",
            "training_run_id AS parent",
            "CAST(NULL AS STRING) AS params",
            names.format("metrics_json"),
            "status",
        )
    )


CANDIDATE = "predicted_stockout_flag = 1 AND predicted_stockout_proba >= 0.8"

@query("m11_alert_candidates", f"WITH {PREDICTIONS_SQL} SELECT * FROM predictions WHERE {CANDIDATE}")
def alert_candidates(spark, folder):
    return candidates(prediction_rows(spark, folder))


@query(
    "m12_new_alerts",
    f"WITH {PREDICTIONS_SQL}{LOG_SQL} SELECT * FROM predictions p WHERE {CANDIDATE} AND NOT EXISTS "
    "(SELECT 1 FROM alert_log l WHERE l.store_id = p.store_id AND l.product_id = p.product_id "
    "AND l.event_date = p.event_date)",
)
def unsent_alerts(spark, folder):
    return new_alerts(prediction_rows(spark, folder), alert_log_rows(spark, folder))


@query(
    "m13_alert_batch",
    f"WITH {PREDICTIONS_SQL}{LOG_SQL} SELECT store_id, product_id, event_date, "
    "printf('🚨 *Stock-out Alert*\nStockout risk detected (no text returned).\n\n_Details:_ store=%d, "
    "product=%d, date=%s, prob=%.2f, flag=%d', store_id, product_id, CAST(event_date AS VARCHAR), "
    "predicted_stockout_proba, predicted_stockout_flag) AS message "
    f"FROM predictions p WHERE {CANDIDATE} AND NOT EXISTS (SELECT 1 FROM alert_log l WHERE "
    "l.store_id = p.store_id AND l.product_id = p.product_id AND l.event_date = p.event_date)",
)
def alert_batch(spark, folder):
    """Sent twice against a log with earlier alerts: the outbox holds each new alert once."""
    base, log, outbox = fresh_path(spark, "alerts"), fresh_name("log"), fresh_name("outbox")
    append_aligned(spark, log, alert_log_rows(spark, folder), base)
    rows = replace_table(spark, fresh_name("predictions"), prediction_rows(spark, folder), base)
    send_alerts(spark, rows, NOW, base, outbox, log)
    send_alerts(spark, rows, NOW + dt.timedelta(days=1), base, outbox, log)
    return spark.table(outbox).select(*EVENT_KEY, "message")


# --- the whole run ------------------------------------------------------------------------------------

KEYWORD = ("seasonal decor", "R1")
RUN_SQL = f"""
pairs AS (SELECT store_id, product_id AS tcin FROM search),
{fulfillment_sql('pairs')},
{trend_sql(f"SELECT '{KEYWORD[0]}' AS keyword, '{KEYWORD[1]}' AS region")},
joined AS (
  SELECT CAST(f.store_id AS INT) AS store_id, CAST(f.product_tcin AS INT) AS product_id,
    CAST(f.record_date AS DATE) AS ds, p.title, p.price, r_name AS location_name,
    CAST(round_even(p.rating, 0) AS INT) AS rating, CAST(p.reviews AS INT) AS number_of_reviews,
    pp.current_retail_min, pp.reg_retail_max, f.available_to_promise_qty,
    CAST(g.interest_score AS INT) AS google_trend_score, f.is_sold_out = 'true' AS is_sold_out,
    f.is_out_of_stock_in_all_stores = 'true' AS is_out_of_stock_in_all_stores,
    f.shipping_availability_status, lower(f.shipping_method_short_description) AS shipping_method,
    f.is_two_day_shipping = 'true' AS is_two_day_shipping,
    f.is_base_shipping_method = 'true' AS is_base_shipping_method,
    CAST(f.min_delivery_date AS DATE) AS min_delivery_date,
    CAST(f.max_delivery_date AS DATE) AS max_delivery_date
  FROM fulfillment f
  LEFT JOIN search p ON p.store_id = f.store_id AND p.product_id = f.product_tcin
  LEFT JOIN region ON r_regionkey = f.store_id
  LEFT JOIN trend g ON CAST(g.dt AS DATE) = CAST(f.record_date AS DATE)
  LEFT JOIN prices pp ON pp.store_id = f.store_id AND pp.product_id = f.product_tcin
    AND CAST(pp.record_date AS DATE) = CAST(f.record_date AS DATE)
),
daily AS (
  SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY store_id, product_id, ds
    ORDER BY shipping_availability_status, shipping_method, available_to_promise_qty,
      is_out_of_stock_in_all_stores, is_sold_out, is_two_day_shipping, is_base_shipping_method,
      min_delivery_date, max_delivery_date) AS n FROM joined) j WHERE n = 1
),
{ROLLED_SQL}"""
RUN_COLUMNS = [
    "store_id",
    "product_id",
    "ds",
    "title",
    "location_name",
    "price",
    "rating",
    "number_of_reviews",
    "current_retail_min",
    "reg_retail_max",
    "available_to_promise_qty",
    "google_trend_score",
    "is_sold_out",
    "shipping_method",
    "min_delivery_date",
    "max_delivery_date",
    "inv_7d_avg",
    "inv_7d_std",
    "trend_7d_avg",
    "is_oos_today",
    "stockout_next_7d",
]


def whole_run(spark, folder, times=1):
    """Every region a store, every part a product; a day's run into tables of its own.

    ``times``: run so often, incrementally, as of the same time.
    """
    region = table(spark, folder, "region")
    store_data = region.select(
        F.col("r_regionkey").cast("string").alias("store_id"),
        F.col("r_name").alias("location_name"),
        F.col("r_name").alias("city"),
        F.lit("").alias("state"),
        F.lit("").alias("postal_code"),
    )
    keyword = spark.createDataFrame([KEYWORD], "keyword string, region string")
    run = Run(spark, fresh_path(spark, "run"), fresh_name("run"), NOW)
    for _ in range(times):
        written = run_all(
            run,
            seed_products(spark, folder),
            store_data,
            region.select(F.col("r_regionkey").cast("long").alias("store_id")),
            None,
            generated_trends(keyword, NOW.date(), NOW),
            incremental=times > 1,
            **TEXTS,
        )
    return written


@query(
    "m14_end_to_end",
    f"WITH {search_sql('region', 'r_regionkey')}, {PRICES_SQL}, {RUN_SQL} SELECT {shown(RUN_COLUMNS)} FROM gold",
)
def end_to_end(spark, folder):
    """The gold table of the whole run (its alerts depend on the fitted model)."""
    return rounded(whole_run(spark, folder)["gold"].select(*RUN_COLUMNS))


@query(
    "m14_incremental_rerun",
    f"WITH {search_sql('region', 'r_regionkey')}, {PRICES_SQL}, {RUN_SQL} SELECT {shown(RUN_COLUMNS)} FROM gold",
)
def incremental_rerun(spark, folder):
    """The same run twice: the second takes the incremental route, and adds and changes nothing."""
    return rounded(whole_run(spark, folder, times=2)["gold"].select(*RUN_COLUMNS))
