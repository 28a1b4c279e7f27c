"""Gaussian copula over a table's columns: fit by Spark aggregates, sample row by row id.

Each column gets a marginal: a quantile table (numbers and times) or cumulative shares (categories).
Values are mapped to normal scores through their marginal, and the correlation matrix of the scores is
what joins the columns. Marginals of up to ``LISTED`` categories and the matrix come to the driver;
a column with more keeps its marginal as a table, which rows look up by joins, with the same result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.draws import uniform
from ..functions.numeric import finite_or_null, sentinel_date
from ..functions.casting import try_timestamp
from ..operators.bounds import broadcast_if_small
from ..operators.columns import fill_by_type
from ..session import fresh_path

QUANTILES = 200
LISTED = 1000

# The normal distribution function on a fine grid; both directions are interpolated from it.
_SCORES = np.linspace(-6.0, 6.0, 4801)
_SHARES = np.array([0.5 * math.erfc(-z / math.sqrt(2.0)) for z in _SCORES])


def normal_score(share: np.ndarray) -> np.ndarray:
    return np.interp(share, _SHARES, _SCORES)


def normal_share(score: np.ndarray) -> np.ndarray:
    return np.interp(score, _SCORES, _SHARES)


@dataclass(frozen=True)
class Marginal:
    """How one column is distributed. Categories hold their cumulative shares, as a list or, where
    there are many, as the table (v, lo, hi) at ``wide``."""

    name: str
    data_type: T.DataType
    null_share: float
    quantiles: Sequence[float] = ()
    categories: Sequence[str] = ()
    reached: Sequence[float] = ()
    wide: str = ""
    n_wide: int = 0


@dataclass(frozen=True)
class Copula:
    marginals: Sequence[Marginal]
    correlation: np.ndarray = field(repr=False)

    @property
    def names(self) -> list[str]:
        return [m.name for m in self.marginals]


_TIMES = (T.TimestampType, T.TimestampNTZType)


def as_number(column: str, kind: T.DataType) -> Column:
    """Times as seconds, dates as days."""
    if isinstance(kind, _TIMES):
        return F.unix_micros(F.col(column).cast("timestamp")) / 1e6
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    return F.col(column).cast("double")


def from_number(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, _TIMES):
        return F.timestamp_micros((column * 1e6).cast("long")).cast(kind)
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.rint(column).cast("int"))
    if isinstance(kind, T.IntegralType):
        return F.rint(column).cast(kind)
    return column.cast(kind)


def numeric_marginals(df: DataFrame, names: Sequence[str], points: int) -> list[Marginal]:
    shares = [i / points for i in range(points + 1)]
    aggregates = [F.count(F.lit(1)).alias("n")]
    for name in names:
        value = as_number(name, df.schema[name].dataType)
        aggregates += [
            F.percentile_approx(value, shares, 50 * points).alias(f"q_{name}"),
            F.count(value).alias(f"n_{name}"),
        ]
    row = df.agg(*aggregates).first()
    marginals = []
    for name in names:
        if not row[f"n_{name}"]:
            raise ValueError(f"column {name!r} has no known value to fit")
        missing = 1.0 - row[f"n_{name}"] / row["n"]
        marginals.append(
            Marginal(name, df.schema[name].dataType, missing, quantiles=list(row[f"q_{name}"]))
        )
    return marginals


def _running_shares(counts: DataFrame, known: int) -> DataFrame:
    """v, lo, hi: cumulative shares in the order of ``v``, by ranges of values and the ranges' sums.

    ``counts``: v (known values, each once) and n. There is a row a range in the one-task window.
    """
    spark, path = counts.sparkSession, fresh_path(counts.sparkSession, "copula-ranges")
    ranged = counts.select("v", "n").repartitionByRange("v").withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_range").agg(F.sum("n").alias("s"))
    starts = sums.select("_range", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("_start"))
    inside = F.sum("n").over(Window.partitionBy("_range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    upto = F.col("_start") + F.col("_inside")
    rows = ranged.withColumn("_inside", inside).join(broadcast_if_small(starts), "_range")
    return rows.select("v", ((upto - F.col("n")) / known).alias("lo"), (upto / known).alias("hi"))


def categorical_marginals(
    df: DataFrame, names: Sequence[str], listed: int, counts: DataFrame | None = None
) -> list[Marginal]:
    """All columns' value counts in one pass, or those given (c, v, n), kept as a table."""
    spark = df.sparkSession
    path = fresh_path(spark, "copula-counts")
    if counts is None:
        cells = F.array(*[F.struct(F.lit(n).alias("c"), F.col(n).cast("string").alias("v")) for n in names])
        stacked = df.select(F.explode(cells).alias("cell")).select("cell.*")
        counts = stacked.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    counts.write.parquet(path)
    counts = spark.read.parquet(path)
    sizes = counts.groupBy("c").agg(
        F.count("v").alias("values"),
        F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("known"),
        F.sum("n").alias("rows"),
    )
    size_of = {r["c"]: r for r in sizes.collect()}  # a row a column
    narrow = [n for n in names if n in size_of and size_of[n]["values"] <= listed]
    rows: dict[str, list] = {n: [] for n in narrow}
    for r in counts.filter(F.col("c").isin(narrow) & F.col("v").isNotNull()).collect():
        rows[r["c"]].append((r["v"], r["n"]))
    marginals = []
    for name in names:
        if name not in size_of or not size_of[name]["known"]:
            raise ValueError(f"column {name!r} has no known value to fit")
        known, total = size_of[name]["known"], size_of[name]["rows"]
        kind, missing = df.schema[name].dataType, 1.0 - known / total
        if name in rows:
            own = sorted(rows[name])
            reached = [float(x) for x in np.cumsum([n for _, n in own]) / known]
            marginals.append(
                Marginal(name, kind, missing, categories=[v for v, _ in own], reached=reached)
            )
        else:
            # One row a value: as large as the column has values, not rows.
            table = fresh_path(spark, "copula-wide")
            own = counts.filter((F.col("c") == name) & F.col("v").isNotNull())
            _running_shares(own, known).write.parquet(table)
            marginals.append(Marginal(name, kind, missing, wide=table, n_wide=size_of[name]["values"]))
    return marginals


def _nearest_correlation(matrix: np.ndarray) -> np.ndarray:
    """A valid correlation matrix close to the pairwise one (small eigenvalues lifted)."""
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    lifted = vectors @ np.diag(np.maximum(values, 1e-6)) @ vectors.T
    scale = np.sqrt(np.diag(lifted))
    return lifted / np.outer(scale, scale)


def _correlation(a: str, b: str) -> Column:
    """Over rows that have both; NULL where one of them is constant there."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    spread = F.stddev_pop(F.when(both, F.col(a))) * F.stddev_pop(F.when(both, F.col(b)))
    return F.try_divide(F.covar_pop(a, b), spread)


def _share_columns(df: DataFrame, marginals: Sequence[Marginal]) -> DataFrame:
    """Columns c0, c1, ...: numbers, category texts, and for wide columns the looked-up share."""
    rows = df.select(
        *[
            (as_number(m.name, m.data_type) if m.quantiles else F.col(m.name).cast("string")).alias(f"c{i}")
            for i, m in enumerate(marginals)
        ]
    )
    for i, m in enumerate(marginals):
        if m.wide:
            table = df.sparkSession.read.parquet(m.wide)
            middle = table.select(F.col("v").alias(f"c{i}"), ((F.col("lo") + F.col("hi")) / 2).alias("_mid"))
            rows = rows.join(middle, f"c{i}", "left").withColumn(f"c{i}", F.col("_mid")).drop("_mid")
    return rows.select(*[f"c{i}" for i in range(len(marginals))])


def fit_copula(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    points: int = QUANTILES,
    listed: int = LISTED,
    datetimes: Sequence[str] = (),
    marginals: Sequence[Marginal] | None = None,
) -> Copula:
    """Quantiles of all numbers and times, counts of all categories, then all correlations: a pass each.

    ``marginals`` that are known already (``load_marginals``) stand in for the columns named and the first
    two passes; then ``df`` may be a part of the rows, from which the correlations are taken.
    """
    numbers = [*numeric, *datetimes]
    marginals = list(marginals) if marginals is not None else (
        (numeric_marginals(df, numbers, points) if numbers else [])
        + (categorical_marginals(df, categorical, listed) if categorical else [])
    )
    names = [f"c{i}" for i in range(len(marginals))]
    # Executors get plain lists and functions of numpy and pandas, nothing of this package.
    known = [(list(m.quantiles), list(m.categories), list(m.reached), bool(m.wide)) for m in marginals]
    grid_of_scores, grid_of_shares = _SCORES, _SHARES

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def share_of(values, quantiles, categories, reached, wide):
            """Middle of the ranks that a value takes; the ends are half a step from 0 and 1."""
            if wide:
                return values.to_numpy(dtype=float)
            if categories:
                upper = np.asarray(reached)
                middle = (np.concatenate([[0.0], upper[:-1]]) + upper) / 2
                return values.map(dict(zip(categories, middle))).to_numpy(dtype=float)
            grid = np.asarray(quantiles)
            shares = np.linspace(0.0, 1.0, len(grid))
            x = values.to_numpy(dtype=float)
            seen = ~np.isnan(x)
            result = np.full(len(x), np.nan)
            inside = x[seen]
            left = np.searchsorted(grid, inside, side="left")
            right = np.searchsorted(grid, inside, side="right")
            middle = (shares[np.minimum(left, len(grid) - 1)] + shares[np.maximum(right - 1, 0)]) / 2
            result[seen] = np.where(right - left > 1, middle, np.interp(inside, grid, shares))
            half = 0.5 / max(len(grid) - 1, 1)
            return np.clip(result, half, 1 - half)

        for batch in batches:
            yield pd.DataFrame(
                {
                    name: np.interp(share_of(batch[name], *own), grid_of_shares, grid_of_scores)
                    for name, own in zip(names, known)
                }
            )

    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    scored = _share_columns(df, marginals).mapInPandas(scores, schema)
    # pandas writes a missing value as NaN, which corr would take as a number.
    clean = scored.select(*[F.when(~F.isnan(n), F.col(n)).alias(n) for n in names])
    matrix = np.eye(len(names))
    pairs = [(i, j) for i in range(len(names)) for j in range(i)]
    if pairs:
        row = clean.agg(*[_correlation(names[i], names[j]).alias(f"{i}_{j}") for i, j in pairs]).first()
        for i, j in pairs:
            r = row[f"{i}_{j}"]
            matrix[i, j] = matrix[j, i] = 0.0 if r is None or math.isnan(r) else r
    return Copula(marginals, _nearest_correlation(matrix))


def _look_up(spark: SparkSession, rows: DataFrame, column: str, m: Marginal) -> DataFrame:
    """The category whose range holds the share in ``column``, by an equi join on buckets of shares.

    There are a few buckets a value, so a bucket holds few values and an even share of the rows.
    """
    buckets = 4 * m.n_wide
    bucket = lambda x: F.least(F.floor(x * buckets), F.lit(buckets - 1)).cast("long")
    table = spark.read.parquet(m.wide).withColumn(
        "_bucket", F.explode(F.sequence(bucket(F.col("lo")), bucket(F.col("hi"))))
    )
    share = F.least(F.col(column), F.lit(1 - 1e-12))
    own = rows.withColumn("_share", share).withColumn("_bucket", bucket(F.col("_share")))
    inside = (F.col("_share") >= F.col("lo")) & (F.col("_share") < F.col("hi"))
    found = own.join(table, (own["_bucket"] == table["_bucket"]) & inside, "left")
    return found.select(*[F.col("v").alias(c) if c == column else F.col(c) for c in rows.columns])


def sample_copula(spark: SparkSession, model: Copula, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows with a ``row_id``. A row depends on its id and the seed only, so retries repeat it.

    Whether a value is missing is drawn for the columns that have missing values only.
    """
    marginals = list(model.marginals)
    root = np.linalg.cholesky(model.correlation)
    size = len(marginals)
    draws = spark.range(n).select(
        F.col("id").alias("row_id"),
        *[uniform(f"copula-{seed}-{i}", "id").alias(f"u{i}") for i in range(size)],
        *[uniform(f"missing-{seed}-{i}", "id").alias(f"m{i}") for i, m in enumerate(marginals) if m.null_share > 0],
    )
    known = [(list(m.quantiles), list(m.categories), list(m.reached), m.null_share) for m in marginals]
    grid_of_scores, grid_of_shares = _SCORES, _SHARES

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            uniforms = batch[[f"u{i}" for i in range(size)]].to_numpy()
            normal = np.interp(uniforms + 2.0**-33, grid_of_shares, grid_of_scores) @ root.T
            shares = np.interp(normal, grid_of_scores, grid_of_shares)
            result = {"row_id": batch["row_id"]}
            for i, (quantiles, categories, reached, missing) in enumerate(known):
                share = shares[:, i]
                if categories:
                    at = np.minimum(np.searchsorted(np.asarray(reached), share, side="right"), len(categories) - 1)
                    values = np.asarray(categories, dtype=object)[at]
                elif quantiles:
                    values = np.interp(share, np.linspace(0.0, 1.0, len(quantiles)), np.asarray(quantiles))
                else:
                    values = share
                column = pd.Series(values, index=batch.index)
                result[f"c{i}"] = column.mask(batch[f"m{i}"] < missing) if missing > 0 else column
            yield pd.DataFrame(result)

    fields = [T.StructField(f"c{i}", T.StringType() if m.categories else T.DoubleType()) for i, m in enumerate(marginals)]
    schema = T.StructType([T.StructField("row_id", T.LongType()), *fields])
    drawn = draws.mapInPandas(rows, schema)
    # pandas writes a missing number as NaN.
    numbers = {f"c{i}": F.when(~F.isnan(f"c{i}"), F.col(f"c{i}")) for i, m in enumerate(marginals) if not m.categories}
    drawn = drawn.withColumns(numbers) if numbers else drawn
    for i, m in enumerate(marginals):
        if m.wide:
            drawn = _look_up(spark, drawn, f"c{i}", m)
    return drawn.select(
        "row_id",
        *[
            (from_number(F.col(f"c{i}"), m.data_type) if m.quantiles else F.col(f"c{i}").cast(m.data_type)).alias(m.name)
            for i, m in enumerate(marginals)
        ],
    )


def cleaned_for_fit(df: DataFrame, timestamps: Sequence[str] = ()) -> DataFrame:
    """Missing values by type, then infinities to NULL, then bad timestamps to the sentinel day."""
    filled = fill_by_type(df)
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    finite = filled.withColumns({c: finite_or_null(c) for c in floats}) if floats else filled
    dated = {c: sentinel_date(try_timestamp(c)) for c in timestamps}
    return finite.withColumns(dated) if dated else finite
