"""Standardised logistic regression: fitted by Spark ML, applied as column expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import short_id
from ..operators.aggregates import feature_stats, latest_row
from ..operators.metrics import accuracy, f1, roc_auc
from ..schemas import EVENT_KEY, FEATURES, MODEL_WEIGHTS
from .features import prepared

FLAG_THRESHOLD = 0.5
MAX_ITERATIONS = 5000

# What the registry rows say about a run.
MODEL_NAME = "logistic_regression"
SCALER_NAME = "standard"
METRICS = ["train_acc", "train_f1", "valid_acc", "valid_f1", "valid_roc_auc"]
RUN_STATUS = "success"
VERSION_STATUS = "candidate"


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per input; a constant input scales to 0."""

    names: Sequence[str]
    means: Sequence[float]
    deviations: Sequence[float]

    def scaled(self, position: int) -> Column:
        deviation = self.deviations[position] or 1.0
        return (F.col(self.names[position]) - F.lit(self.means[position])) / F.lit(deviation)

    def columns(self) -> list[Column]:
        return [self.scaled(i).alias(name) for i, name in enumerate(self.names)]


@dataclass(frozen=True)
class StockoutModel:
    scaler: Scaler
    coefficients: Sequence[float]
    intercept: float

    def contributions(self) -> list[Column]:
        return [F.lit(c) * self.scaler.scaled(i) for i, c in enumerate(self.coefficients)]

    def probability(self) -> Column:
        """The logistic function of the weighted inputs; stays inside generated code."""
        score = F.lit(self.intercept)
        for term in self.contributions():
            score = score + term
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def fit_scaler(train: DataFrame, names: Sequence[str] = FEATURES) -> tuple[Scaler, int]:
    """Scaler and row count of the training rows: one aggregate, two numbers per input come back."""
    row = train.agg(F.count(F.lit(1)).alias("n"), *feature_stats(train, names)).first()
    if row["n"] == 0:
        raise ValueError("no training rows")
    scaler = Scaler(
        list(names), [row[f"{c}__mean"] for c in names], [row[f"{c}__std"] for c in names]
    )
    return scaler, row["n"]


def fit(features: DataFrame, max_iter: int = MAX_ITERATIONS, tol: float = 1e-8) -> StockoutModel:
    """Fit on the 'train' side. The penalty is half the squared norm against the summed log loss."""
    train = prepared(features.filter(F.col("split") == "train"))
    scaler, n_train = fit_scaler(train)
    vectors = VectorAssembler(inputCols=list(scaler.names), outputCol="inputs").transform(
        train.select(*scaler.columns(), F.col("label").cast("double"))
    )
    fitted = LogisticRegression(
        featuresCol="inputs",
        labelCol="label",
        regParam=1.0 / n_train,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tol,
        family="binomial",
    ).fit(vectors.select("inputs", "label"))
    return StockoutModel(scaler, [float(c) for c in fitted.coefficients], float(fitted.intercept))


def weight_rows(spark: SparkSession, model: StockoutModel, version_id: str, trained_at: dt.datetime) -> DataFrame:
    """A fitted model as a row an input."""
    scaler = model.scaler
    rows = zip(scaler.names, scaler.means, scaler.deviations, model.coefficients, strict=True)
    return spark.createDataFrame(
        [(version_id, trained_at, i, *row, model.intercept) for i, row in enumerate(rows)], MODEL_WEIGHTS
    )


def stored_model(weights: DataFrame) -> StockoutModel | None:
    """The model trained last; None if none is stored."""
    last = latest_row(weights, "trained_at", ["trained_at", "model_version_id"]).first()
    if last is None:
        return None
    rows = weights.filter(F.col("model_version_id") == last["model_version_id"]).sort("position").collect()
    scaler = Scaler([r["name"] for r in rows], [r["mean"] for r in rows], [r["deviation"] for r in rows])
    return StockoutModel(scaler, [r["coefficient"] for r in rows], rows[0]["intercept"])


def with_scores(rows: DataFrame, model: StockoutModel, threshold: float = FLAG_THRESHOLD) -> DataFrame:
    """Add probability and 0/1 flag to prepared rows."""
    return rows.withColumn("predicted_stockout_proba", model.probability()).withColumn(
        "predicted_stockout_flag", (F.col("predicted_stockout_proba") >= threshold).cast("int")
    )


def predictions(features: DataFrame, model: StockoutModel) -> DataFrame:
    """Scores of all rows, both sides."""
    rows = prepared(features, *EVENT_KEY, "stockout_label")
    return with_scores(rows, model).select(
        *EVENT_KEY, "stockout_label", "predicted_stockout_proba", "predicted_stockout_flag"
    )


def evaluation(features: DataFrame, model: StockoutModel) -> DataFrame:
    return evaluation_of(with_scores(prepared(features, "split"), model))


def evaluation_of(scored: DataFrame) -> DataFrame:
    """One row: accuracy and F1 of both sides, ROC AUC of the later one."""
    label, flag = "label", "predicted_stockout_flag"
    by_side = scored.groupBy("split").agg(accuracy(label, flag).alias("acc"), f1(label, flag).alias("f1"))
    rates = by_side.agg(
        *[
            F.max(F.when(F.col("split") == side, F.col(metric))).alias(f"{name}_{metric}")
            for name, side in (("train", "train"), ("valid", "test"))
            for metric in ("acc", "f1")
        ]
    )
    auc = roc_auc(scored.filter(F.col("split") == "test"), label, "predicted_stockout_proba")
    # One row each, stacked and folded into one: no join.
    stacked = rates.unionByName(
        auc.withColumnRenamed("roc_auc", "valid_roc_auc"), allowMissingColumns=True
    )
    return stacked.agg(*[F.max(name).alias(name) for name in METRICS])


def metrics_json(evaluated: DataFrame) -> DataFrame:
    return evaluated.select(
        F.to_json(F.struct(*evaluated.columns), {"ignoreNullFields": "false"}).alias("metrics")
    )


def latest_dataset(datasets: DataFrame, model_id: str) -> str:
    """Id of the model's latest dataset, or a clear error where none is registered."""
    rows = datasets.filter(F.col("model_id") == model_id)
    found = latest_row(rows, "created_at", ["dataset_id", "created_at"]).first()
    if found is None:
        raise ValueError(f"no dataset is registered for model {model_id!r}")
    return found["dataset_id"]


def registry_rows(
    metrics: DataFrame, model_id: str, dataset_id: str, artifact: str, run_key: str
) -> tuple[DataFrame, DataFrame]:
    """The training-run and the model-version row of one run; ids follow from the run key."""
    run_id = short_id("run_", F.lit(model_id), F.lit(run_key), F.lit("run"))
    version_id = short_id("mv_", F.lit(model_id), F.lit(run_key), F.lit("version"))
    params = F.to_json(F.struct(F.lit(MODEL_NAME).alias("model"), F.lit(SCALER_NAME).alias("scaler")))
    run = metrics.select(
        run_id.alias("run_id"),
        F.lit(model_id).alias("model_id"),
        F.lit(dataset_id).alias("dataset_id"),
        params.alias("params"),
        F.col("metrics"),
        F.lit(artifact).alias("artifact"),
        F.lit(RUN_STATUS).alias("status"),
    )
    version = metrics.select(
        version_id.alias("model_version_id"),
        F.lit(model_id).alias("model_id"),
        run_id.alias("training_run_id"),
        F.lit(artifact).alias("artifact_path"),
        F.col("metrics").alias("metrics_json"),
        F.lit(VERSION_STATUS).alias("status"),
    )
    return run, version


def contributing_factors(features: DataFrame, model: StockoutModel, top: int = 3) -> DataFrame:
    """Per row the inputs that moved its score most, largest effect first."""
    rows = with_scores(prepared(features, *EVENT_KEY), model)
    effects = F.array(
        *[
            F.struct(
                (-F.abs(effect)).alias("order"),
                F.lit(name).alias("feature"),
                effect.alias("effect"),
            )
            for name, effect in zip(model.scaler.names, model.contributions(), strict=True)
        ]
    )
    ranked = F.slice(F.array_sort(effects), 1, top)
    named = F.transform(ranked, lambda e: F.struct(e["feature"].alias("feature"), e["effect"].alias("effect")))
    return rows.select(*EVENT_KEY, "predicted_stockout_proba", named.alias("factors"))
