import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.checks.q_model import stored_features
from shelfcast.plans import model as lr
from shelfcast.plans.features import prepared
from shelfcast.schemas import DATASET, EVENT_KEY, FEATURES


@pytest.fixture(scope="module")
def features(spark, small):
    return stored_features(spark, small)


@pytest.fixture(scope="module")
def model(features):
    return lr.fit(features)


def newton(x, y, steps=100):
    """Half squared norm of the weights plus the summed log loss; the intercept is free."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([1.0] * (x.shape[1] - 1) + [0.0])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-12:
            break
    return w


def matrix(frame):
    data = np.array([tuple(r) for r in frame.select(*FEATURES, "label").collect()], dtype=float)
    return data[:, :-1], data[:, -1]


def test_coefficients_match_an_independent_solver(features, model):
    x, y = matrix(prepared(features.filter("split = 'train'")))
    std = x.std(axis=0)
    scaled = (x - x.mean(axis=0)) / np.where(std == 0, 1, std)
    expected = newton(scaled, y)
    assert np.allclose([*model.coefficients, model.intercept], expected, atol=1e-4)


def test_probability_equals_the_formula(features, model):
    rows = lr.with_scores(prepared(features), model)
    x, _ = matrix(rows)
    got = np.array([r[0] for r in rows.select("predicted_stockout_proba").collect()])
    std = np.array(model.scaler.deviations)
    scaled = (x - np.array(model.scaler.means)) / np.where(std == 0, 1, std)
    expected = 1 / (1 + np.exp(-(scaled @ np.array(model.coefficients) + model.intercept)))
    assert np.allclose(got, expected, atol=1e-9)


def test_constant_input_scales_to_zero(spark):
    frame = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "a double, b double")
    scaler, n = lr.fit_scaler(frame, ["a", "b"])
    assert n == 2
    assert [tuple(r) for r in frame.select(*scaler.columns()).collect()] == [(0.0, -1.0), (0.0, 1.0)]


def test_flag_is_one_at_exactly_one_half(spark):
    flat = lr.StockoutModel(lr.Scaler(["a"], [0.0], [1.0]), [0.0], 0.0)
    row = lr.with_scores(spark.createDataFrame([(1.0,)], "a double"), flat).first()
    assert row["predicted_stockout_proba"] == 0.5
    assert row["predicted_stockout_flag"] == 1


def test_predictions_cover_every_row_once(features, model):
    scored = lr.predictions(features, model)
    assert scored.count() == features.count()
    assert scored.select(*EVENT_KEY).distinct().count() == scored.count()


def test_evaluation(features, model):
    record = json.loads(lr.metrics_json(lr.evaluation(features, model)).first()[0])
    assert list(record) == ["train_acc", "train_f1", "valid_acc", "valid_f1", "valid_roc_auc"]
    rows = lr.with_scores(prepared(features, "split"), model).collect()
    test = [r for r in rows if r["split"] == "test"]
    hits = sum(r["label"] == r["predicted_stockout_flag"] for r in test)
    assert record["valid_acc"] == pytest.approx(hits / len(test))
    pos = [r["predicted_stockout_proba"] for r in test if r["label"] == 1]
    neg = [r["predicted_stockout_proba"] for r in test if r["label"] == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert record["valid_roc_auc"] == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)


def test_no_training_rows_is_an_error(features):
    with pytest.raises(ValueError, match="no training rows"):
        lr.fit(features.filter("split = 'none'"))


def test_missing_dataset_is_a_clear_error(spark):
    with pytest.raises(ValueError, match="no dataset is registered"):
        lr.latest_dataset(spark.createDataFrame([], DATASET), "stockout_v1")


def test_registry_ids_repeat_for_the_same_run(spark):
    metrics = spark.createDataFrame([("{}",)], "metrics string")
    first = [f.first() for f in lr.registry_rows(metrics, "m", "d", "t", "2024-03-01")]
    again = [f.first() for f in lr.registry_rows(metrics, "m", "d", "t", "2024-03-01")]
    other = [f.first() for f in lr.registry_rows(metrics, "m", "d", "t", "2024-03-02")]
    assert first == again and first != other
    run, version = first
    assert run["run_id"].startswith("run_") and len(run["run_id"]) == 12
    assert version["training_run_id"] == run["run_id"]
    assert json.loads(run["params"]) == {"model": "logistic_regression", "scaler": "standard"}


def test_factors_are_the_largest_effects(features, model):
    row = lr.contributing_factors(features, model).first()
    effects = [abs(f["effect"]) for f in row["factors"]]
    assert len(effects) == 3 and effects == sorted(effects, reverse=True)
    source = prepared(features, *EVENT_KEY).filter(
        (F.col("store_id") == row["store_id"]) & (F.col("product_id") == row["product_id"])
        & (F.col("event_date") == F.lit(row["event_date"]))
    ).select(*[c.alias(n) for n, c in zip(FEATURES, model.contributions(), strict=True)]).first()
    assert effects[0] == pytest.approx(max(abs(v) for v in source))
