import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.plans.copula import cleaned_for_fit, fit_copula, normal_score, sample_copula

N = 20000


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    z = rng.multivariate_normal([0, 0], [[1, 0.7], [0.7, 1]], N)
    rows = [
        (
            float(np.exp(a)),
            int(round(10 * b)),
            "hot" if u < 1 / 3 else ("warm" if u < 0.6 else "cold"),
            None if v < 0.2 else float(v),
        )
        for (a, b), u, v in zip(z, rng.random(N), rng.random(N), strict=True)
    ]
    return spark.createDataFrame(rows, "x double, n int, c string, m double")


def test_sample_keeps_marginals_and_correlation(spark, table):
    model = fit_copula(table, ["x", "n", "m"], ["c"])
    assert abs(model.correlation[0, 1] - 0.7) < 0.03
    assert abs(model.correlation[0, 3]) < 0.05
    sample = sample_copula(spark, model, N)
    assert sample.schema["n"].dataType == table.schema["n"].dataType
    for name in ("x", "n"):
        a = table.approxQuantile(name, [0.1, 0.5, 0.9], 0.001)
        b = sample.approxQuantile(name, [0.1, 0.5, 0.9], 0.001)
        assert np.allclose(a, b, rtol=0.08, atol=0.6)
    shares = {r["c"]: r["count"] / N for r in sample.groupBy("c").count().collect()}
    assert shares == pytest.approx({"hot": 1 / 3, "warm": 0.267, "cold": 0.4}, abs=0.02)
    assert abs(sample.filter(F.col("m").isNull()).count() / N - 0.2) < 0.02
    rank_corr = fit_copula(sample, ["x", "n"]).correlation[0, 1]
    assert abs(rank_corr - 0.7) < 0.04


def test_sample_is_repeatable(spark, table):
    model = fit_copula(table, ["x", "n"], ["c"])
    first = sorted(map(tuple, sample_copula(spark, model, 500).collect()))
    again = sorted(map(tuple, sample_copula(spark, model, 500).repartition(3).collect()))
    other = sorted(map(tuple, sample_copula(spark, model, 500, seed=7).collect()))
    assert first == again and first != other


def test_a_wide_column_gives_what_a_listed_one_gives(spark, table):
    listed = fit_copula(table, ["x"], ["c"])
    wide = fit_copula(table, ["x"], ["c"], listed=2)
    assert np.allclose(listed.correlation, wide.correlation) and wide.marginals[1].wide
    one, other = (sorted(map(tuple, sample_copula(spark, m, 2000).collect())) for m in (listed, wide))
    assert one == other


def test_thousands_of_categories(spark):
    rows = spark.range(6000).select(
        F.concat(F.lit("id-"), (F.col("id") % 1500).cast("string")).alias("code"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 1500).cast("int").alias("n"),
    )
    sample = sample_copula(spark, fit_copula(rows, ["n"], ["code"]), 6000)
    assert sample.count() == 6000 and sample.filter(F.col("code").isNull()).isEmpty()
    assert sample.select("code").distinct().count() > 1300
    assert sample.join(rows, "code", "left_anti").isEmpty()


def test_times_and_typed_categories(spark):
    rows = spark.range(3000).select(
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).alias("t"),
        F.timestamp_seconds(1_700_000_000 + F.col("id")).cast("timestamp_ntz").alias("z"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("d"),
        (F.col("id") % 2 == 0).alias("b"),
        (F.col("id") % 3).alias("k"),
    )
    model = fit_copula(rows, [], ["b", "k"], datetimes=["t", "z", "d"])
    sample = sample_copula(spark, model, 3000)
    assert [f.dataType for f in sample.schema][1:] == [rows.schema[n].dataType for n in model.names]
    bounds = lambda df: df.agg(F.min("t"), F.max("d"), F.count("z")).first()
    got, real = bounds(sample), bounds(rows)
    assert abs((got[0] - real[0]).total_seconds()) < 3600 and abs((got[1] - real[1]).days) <= 1 and got[2] == 3000
    assert model.correlation[0, 1] > 0.95
    assert {r["k"] for r in sample.select("k").distinct().collect()} == {0, 1, 2}


def test_tied_ends_do_not_pull_the_correlation(spark):
    rng = np.random.default_rng(2)
    z = rng.multivariate_normal([0, 0], [[1, 0.7], [0.7, 1]], N)
    x = np.clip(z[:, 0], *np.quantile(z[:, 0], [0.004, 0.996]))
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, z[:, 1])], "x double, y double")
    assert abs(fit_copula(rows, ["x", "y"]).correlation[0, 1] - 0.7) < 0.015


def test_executors_need_nothing_of_the_package(spark, table):
    """The functions that are sent hold plain data, so they load where the package is not installed."""
    from pyspark.cloudpickle import dumps

    import shelfcast.plans.copula as module

    sent = []
    original = type(table).mapInPandas
    try:
        type(table).mapInPandas = lambda self, f, s, *a, **k: (sent.append(dumps(f)), original(self, f, s, *a, **k))[1]
        module.sample_copula(spark, module.fit_copula(table, ["x"], ["c"]), 10)
    finally:
        type(table).mapInPandas = original
    assert len(sent) == 2 and not any(b"shelfcast.plans" in s.replace(b"__module__", b"") and b"Marginal" in s for s in sent)


def test_column_without_values_is_an_error(spark):
    empty = spark.createDataFrame([(None, 1.0)], "a double, b double")
    with pytest.raises(ValueError, match="'a' has no known value"):
        fit_copula(empty, ["a", "b"])


def test_normal_score():
    assert normal_score(np.array([0.5, 0.975]))[0] == pytest.approx(0.0, abs=1e-9)
    assert normal_score(np.array([0.5, 0.975]))[1] == pytest.approx(1.959964, abs=1e-4)


def test_clean_up(spark):
    rows = [(None, None, float("inf"), "soon"), ("a", 2, 1.0, "2024-01-02 03:04:05")]
    frame = spark.createDataFrame(rows, "s string, n int, d double, cutoff_time string")
    got = cleaned_for_fit(frame, ["cutoff_time"]).orderBy("n").collect()
    assert got[0]["s"] == "" and got[0]["n"] == 0 and got[0]["d"] is None
    assert got[0]["cutoff_time"].year == 1900
    assert got[1]["cutoff_time"].year == 2024


def test_no_draw_of_missing_values_for_complete_columns(spark, table):
    model = fit_copula(table, ["x", "m"], ["c"])
    sample = sample_copula(spark, model, 2000)
    plan = sample._jdf.queryExecution().optimizedPlan().toString()
    assert "missing-42-1" in plan and "missing-42-0" not in plan and "missing-42-2" not in plan
    assert sample.filter("x IS NULL OR c IS NULL").count() == 0
    assert abs(sample.filter("m IS NULL").count() / 2000 - 0.2) < 0.04


def test_ranks_near_counts_as_comparisons_do(spark):
    """Against a comparison of every row with every quantile; nulls count as rows, NaN is the largest."""
    from shelfcast.checks.q_generators import ranks_near
    from shelfcast.plans.copula import Marginal

    values = [None, float("nan"), float("inf"), -1.0, *[float(i % 7) for i in range(40)]]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x double, n int").repartition(3)
    kinds = [f.dataType for f in df.schema.fields]
    grids = {"x": [-1.0, 0.0, 2.0, 2.0, 6.5, float("nan")], "n": [0.0, 20.5, 100.0]}
    marginals = [Marginal(c, k, 0.0, quantiles=grids[c]) for c, k in zip(df.columns, kinds)]
    for error in (2e-4, 0.3, 0.6):
        got = {(r["name"], r["position"]): (r["near"], r["rows"]) for r in ranks_near(df, marginals, error).collect()}
        for name, grid in grids.items():
            for i, q in enumerate(grid):
                below, upto = df.agg(*[F.sum(c.cast("int")) / F.count(F.lit(1)) for c in (F.col(name) < q, F.col(name) <= q)]).first()
                assert got.pop((name, i)) == (below <= i / 200 + error and upto >= i / 200 - error, len(values))
        assert not got
