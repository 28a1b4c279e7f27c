"""Dashboard aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import model as lr
from ..plans import reports
from ..schemas import EVENT_KEY
from .q_model import SCALED_SQL, WEIGHTS, model_of_given_weights, stored_features
from .registry import query
from .standins import GOLD_SQL, PREDICTIONS_SQL, gold_rows, prediction_rows, rounded


@query(
    "d1_pricing_trend",
    f"WITH {GOLD_SQL} SELECT ds, category, count(*) AS rows, round(avg(price), 9) AS avg_price, "
    "round(avg(current_retail_min), 9) AS avg_current_min, round(avg(current_retail_max), 9) AS avg_current_max, "
    "round(avg(price_change_7d), 9) AS avg_price_change_7d FROM gold GROUP BY ds, category",
)
def pricing_trend(spark, folder):
    return rounded(reports.pricing_trend(gold_rows(spark, folder)), 9)


@query(
    "d2_availability",
    f"WITH {GOLD_SQL} SELECT store_id, ds, count(*) AS products, count(is_oos_today) AS products_known, "
    "round(avg(CAST(is_oos_today AS DOUBLE)), 6) AS oos_rate, "
    "round(avg(available_to_promise_qty), 6) AS avg_qty FROM gold GROUP BY store_id, ds",
)
def availability(spark, folder):
    return rounded(reports.availability(gold_rows(spark, folder)))


@query(
    "d3_category_performance",
    f"WITH {GOLD_SQL} SELECT category, count(*) AS rows, round(avg(price), 6) AS avg_price, "
    "round(avg(rating), 6) AS avg_rating, round(avg(number_of_reviews), 6) AS avg_reviews, "
    "round(avg(CAST(is_oos_today AS DOUBLE)), 6) AS oos_rate, "
    "round(avg(CAST(stockout_next_7d AS DOUBLE)), 6) AS stockout_rate FROM gold GROUP BY category",
)
def category_performance(spark, folder):
    return rounded(reports.category_performance(gold_rows(spark, folder)))


@query(
    "d4_riskiest_per_store",
    f"WITH {PREDICTIONS_SQL}, ranked AS (SELECT store_id, CAST(row_number() OVER (PARTITION BY store_id "
    "ORDER BY predicted_stockout_proba DESC, event_date, product_id) AS INT) AS risk_rank, product_id, "
    "event_date, predicted_stockout_proba FROM predictions) SELECT * FROM ranked WHERE risk_rank <= 5",
)
def riskiest_per_store(spark, folder):
    return reports.riskiest_per_store(prediction_rows(spark, folder))


@query(
    "d5_availability_shift",
    f"WITH {GOLD_SQL}, pairs AS (SELECT store_id, product_id, ds, is_oos_today, lag(is_oos_today) OVER "
    "(PARTITION BY store_id, product_id ORDER BY ds) AS was_oos FROM gold) "
    "SELECT *, CASE WHEN is_oos_today AND NOT was_oos THEN 'went_out' WHEN NOT is_oos_today AND was_oos "
    "THEN 'came_back' WHEN is_oos_today = was_oos THEN 'same' END AS availability_shift FROM pairs",
)
def availability_shift(spark, folder):
    return reports.availability_shift(gold_rows(spark, folder))


@query("d6_contributing_factors")
def contributing_factors(spark, folder):
    rows = stored_features(spark, folder)
    return lr.contributing_factors(rows, lr.fit(rows))


EFFECTS_SQL = " UNION ALL ".join(
    f"SELECT store_id, product_id, event_date, '{name}' AS feature, {weight!r}::DOUBLE * {name} AS effect FROM scaled"
    for name, weight in WEIGHTS.items()
)


@query(
    "d6_factors_of_given_weights",
    f"WITH {SCALED_SQL}, effects AS ({EFFECTS_SQL}), ranked AS (SELECT *, row_number() OVER (PARTITION BY "
    "store_id, product_id, event_date ORDER BY -abs(effect), feature) AS n FROM effects) "
    "SELECT store_id, product_id, event_date, "
    + ", ".join(
        f"max(CASE WHEN n = {i} THEN feature END) AS factor_{i}, "
        f"round(max(CASE WHEN n = {i} THEN effect END), 6) AS effect_{i}"
        for i in (1, 2, 3)
    )
    + " FROM ranked GROUP BY store_id, product_id, event_date",
)
def factors_of_given_weights(spark, folder):
    rows = stored_features(spark, folder)
    found = lr.contributing_factors(rows, model_of_given_weights(rows))
    columns = []
    for i in range(3):
        factor = F.get("factors", F.lit(i))
        columns += [factor["feature"].alias(f"factor_{i + 1}"), factor["effect"].alias(f"effect_{i + 1}")]
    return rounded(found.select(*EVENT_KEY, *columns))
