"""Trees of dependent columns, and marginals merged from loads."""

import datetime as dt
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators.bounds import estimated_bytes
from shelfcast.plans import copula, dependence, load_marginals


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    found = []
    for _ in range(8000):
        status = ["IN", "OUT", None][rng.choice(3, p=[0.5, 0.3, 0.2])]
        service = {"IN": ["ground", "air"], "OUT": ["none"], None: ["ask", "ground"]}[status]
        service = service[rng.integers(len(service))]
        qty = 0 if status == "OUT" else int(rng.integers(1, 60))
        cost = None if service == "none" else float(5 + (service == "air") * 10 + rng.random())
        day = dt.date(2024, 1, 1) + dt.timedelta(days=int(rng.integers(90)))
        found.append((status, service, qty, cost, day, None))
    return found


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "status string, service string, qty int, cost double, day date, never double")


NAMES = ["status", "service"]


def test_information_is_that_of_the_definition(frame, rows):
    coded = frame.select(*[F.coalesce(c, F.lit("?")).alias(c) for c in NAMES])
    got = dependence.mutual_information(dependence.pair_counts(coded, NAMES))[("status", "service")]
    both = Counter((r[0], r[1]) for r in rows)
    first, second, n = Counter(r[0] for r in rows), Counter(r[1] for r in rows), len(rows)
    want = sum(c / n * math.log(c * n / (first[a] * second[b])) for (a, b), c in both.items())
    assert got == pytest.approx(want, rel=1e-9)


def test_the_tree_is_the_heaviest():
    information = {("a", "b"): 0.1, ("a", "c"): 0.5, ("a", "d"): 0.0, ("b", "c"): 0.4, ("b", "d"): 0.3, ("c", "d"): 0.2}
    assert dependence.strongest_tree("abcd", information) == {"a": None, "c": "a", "b": "c", "d": "b"}
    even = dict.fromkeys(information, 0.0)
    assert dependence.strongest_tree("abcd", even) == {"a": None, "b": "a", "c": "a", "d": "a"}


def test_values_that_never_meet_are_never_drawn_together(spark, frame, rows):
    model = dependence.fit_tree(frame, NAMES, ["qty", "cost", "never"], ["day"])
    sample = dependence.sample_tree(spark, model, 8000)
    assert dict(sample.drop("row_id").dtypes) == dict(frame.dtypes)
    got = Counter((r.status, r.service) for r in sample.collect())
    want = Counter((r[0], r[1]) for r in rows)
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 0.03 * len(rows) for k in want)
    drawn = sample.collect()
    assert all(r.never is None for r in drawn)
    assert all((r.cost is None) == (r.service == "none") for r in drawn)
    air = [r.cost for r in drawn if r.service == "air"]  # but for the range between both costs
    assert sum(c > 14.9 for c in air) > 0.9 * len(air)
    assert 0.25 < sum(r.qty == 0 for r in drawn) / len(drawn) < 0.35
    assert all((r.qty == 0) == (r.status == "OUT") for r in drawn)
    assert {r.day for r in drawn} <= {r[4] for r in rows}


def test_samples_repeat(spark, frame):
    model = dependence.fit_tree(frame, NAMES, ["qty"])
    first, again = (sorted(map(str, dependence.sample_tree(spark, model, 300).repartition(n).collect())) for n in (2, 3))
    assert first == again
    assert sorted(map(str, dependence.sample_tree(spark, model, 300, seed=7).collect())) != first


def test_too_little_to_fit(spark, frame):
    with pytest.raises(ValueError, match="two columns"):
        dependence.fit_tree(frame, ["status"])
    with pytest.raises(ValueError, match="no rows"):
        dependence.fit_tree(frame.limit(0), NAMES)


def test_merged_loads_have_the_marginals_of_all_rows(spark, frame):
    loads = frame.withColumn("month", F.month("day"))
    sketches = load_marginals.load_sketches(loads, "month", ["qty", "cost"], ["day"])
    counts = load_marginals.load_counts(loads, "month", NAMES)
    assert sketches.count() == 9
    merged = load_marginals.merged_marginals(frame, sketches, counts, ["qty", "cost", "day"], NAMES)
    whole = copula.fit_copula(frame, ["qty", "cost"], NAMES, datetimes=["day"]).marginals
    for a, b in zip(merged, whole):
        assert (a.name, a.data_type, list(a.categories)) == (b.name, b.data_type, list(b.categories))
        assert a.null_share == pytest.approx(b.null_share) and list(a.reached) == pytest.approx(list(b.reached))
        if b.quantiles:
            values = sorted(v for v in frame.select(copula.as_number(b.name, b.data_type).alias("v")).toPandas()["v"] if v == v and v is not None)
            for i, q in enumerate(a.quantiles):
                at = i / (len(a.quantiles) - 1) * len(values)
                assert np.searchsorted(values, q, "left") - 0.005 * len(values) <= at <= np.searchsorted(values, q, "right") + 0.005 * len(values)
    model = copula.fit_copula(frame, [], marginals=merged)
    assert model.names == ["qty", "cost", "day", *NAMES]
    with pytest.raises(ValueError, match="no known value"):
        load_marginals.merged_marginals(frame, load_marginals.load_sketches(loads, "month", ["never"]), numeric=["never"])


def test_running_shares_of_many_values_use_no_window_over_them(spark):
    counts = spark.range(5000).select(F.format_string("v%05d", "id").alias("v"), (F.col("id") % 7 + 1).alias("n"))
    total = counts.agg(F.sum("n")).first()[0]
    got = [(r.v, r.lo, r.hi) for r in copula._running_shares(counts.repartition(5), total).sort("v").collect()]
    sums = np.cumsum([i % 7 + 1 for i in range(5000)])
    assert [g[2] for g in got] == pytest.approx(list(sums / total))
    assert [g[1] for g in got] == pytest.approx([0.0, *(sums[:-1] / total)])


def test_nested_values_count_with_what_they_hold(spark):
    frame = spark.range(10).select(F.array_repeat(F.lit("x" * 100), 50).alias("a"), F.lit(b"y" * 1000).alias("b"))
    assert estimated_bytes(frame) > 10 * 6000
    assert estimated_bytes(spark.range(10)) == 160
