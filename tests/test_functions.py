import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import casting, draws, flags, numeric, text


def values(spark, rows, schema, *columns):
    frame = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in frame.select(*columns).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("given", "expected"), [(2.5, 2), (3.5, 4), (-2.5, -2), (3.67, 4), (1e12, None), (None, None)])
def test_number_to_int_rounds_half_even(spark, given, expected):
    assert values(spark, [(given,)], "x double", casting.number_to_int("x")) == [(expected,)]


@pytest.mark.parametrize(
    ("given", "expected"),
    [("2.5", 3), ("-2.5", -3), ("3.67", 4), (" 7 ", 7), ("", None), ("x", None), (None, None)],
)
def test_text_to_int_rounds_half_away(spark, given, expected):
    assert values(spark, [(given,)], "x string", casting.text_to_int("x")) == [(expected,)]


def test_hard_int_fails_on_junk(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, [("x",)], "x string", casting.hard_int("x"))


@pytest.mark.parametrize(
    ("given", "expected"),
    [("2024-01-02", dt.date(2024, 1, 2)), ("2024-01-02T03:04:05.678901", dt.date(2024, 1, 2)), ("", None), ("soon", None)],
)
def test_try_date(spark, given, expected):
    assert values(spark, [(given,)], "x string", casting.try_date("x")) == [(expected,)]


@pytest.mark.parametrize(
    ("given", "expected"),
    [("TRUE", True), ("1", True), ("T", True), ("Yes", True), ("False", False), ("0", False), ("f", False),
     ("NO", False), ("", False), ("maybe", None), (None, None)],
)
def test_parse_flag(spark, given, expected):
    assert values(spark, [(given,)], "x string", flags.parse_flag("x")) == [(expected,)]


@pytest.mark.parametrize(
    ("row", "expected"),
    [((5.0, None, False), None), ((None, None, None), True), ((0.0, False, False), True), ((5.0, True, None), True),
     ((5.0, False, False), False)],
)
def test_out_of_stock_is_three_valued(spark, row, expected):
    column = flags.out_of_stock("q", "a", "b")
    assert values(spark, [row], "q double, a boolean, b boolean", column) == [(expected,)]


@pytest.mark.parametrize(
    ("parts", "expected"),
    [((" 1 Main St ", "Town", "MA", "02215"), "1 Main St, Town, MA, 02215"), ((None, "Town", "", "02215"), "Town, 02215"),
     (("a", "  ", None, "b"), "a, , b"), ((None, None, None, None), "")],
)
def test_address_line(spark, parts, expected):
    column = text.address_line(["a", "b", "c", "d"])
    assert values(spark, [parts], "a string, b string, c string, d string", column) == [(expected,)]


def test_business_key(spark):
    rows = [("12", "x"), ("  ", "x"), (None, "x"), (None, None)]
    keys = [r[0] for r in values(spark, rows, "s string, a string", text.business_key("s", "a"))]
    assert keys[0] == "12"
    assert keys[1] == keys[2] and keys[1].startswith("addr_") and len(keys[1]) == 37
    assert keys[3] != keys[2]


def test_clean_id(spark):
    rows = [("12.0",), ("12",), ("1.05",), (None,)]
    assert values(spark, rows, "x string", text.clean_id("x")) == [("12",), ("12",), ("1.05",), (None,)]


def test_price_text(spark):
    rows = [(1.5, 2.25, True), (1.5, 2.25, False), (None, 2.0, False), (0.5, 0.5, True)]
    got = values(spark, rows, "a double, b double, r boolean", text.price_text("a", "b", "r"))
    assert got == [("$1.50 - $2.25",), ("$1.50",), (None,), ("$0.50 - $0.50",)]


def test_alert_text_shows_two_decimals(spark):
    row = (7, 9, dt.date(2024, 3, 1), 0.8056, 1)
    schema = (
        "store_id int, product_id int, event_date date, predicted_stockout_proba double, predicted_stockout_flag int"
    )
    [(message,)] = values(spark, [row], schema, text.alert_text(F.lit("soon out")))
    assert "soon out" in message
    assert message.endswith("store=7, product=9, date=2024-03-01, prob=0.81, flag=1")


@pytest.mark.parametrize(("given", "expected"), [(1.25, 1.0), (1.75, 2.0), (1.3, 1.5), (None, None)])
def test_round_to_half(spark, given, expected):
    assert values(spark, [(given,)], "x double", numeric.round_to_half("x")) == [(expected,)]


@pytest.mark.parametrize(("given", "expected"), [(-1.0, 0.0), (7.0, 5.0), (3.0, 3.0), (None, None)])
def test_clip_keeps_null(spark, given, expected):
    assert values(spark, [(given,)], "x double", numeric.clip("x", 0.0, 5.0)) == [(expected,)]


def test_ordered_pair(spark):
    rows = [(2.0, 1.0), (1.0, None)]
    assert values(spark, rows, "a double, b double", *numeric.ordered_pair("a", "b")) == [(1.0, 2.0), (None, None)]


def test_finite_or_null(spark):
    rows = [(math.inf,), (-math.inf,), (1.0,), (None,)]
    got = values(spark, rows, "x double", numeric.finite_or_null("x"))
    assert got == [(None,), (None,), (1.0,), (None,)]


def test_uniform_is_repeatable_and_even(spark):
    frame = spark.range(20000).select(draws.uniform("salt", "id").alias("u"), "id")
    first = frame.repartition(3).orderBy("id").collect()
    assert first == frame.repartition(7).orderBy("id").collect()
    mean = sum(r["u"] for r in first) / len(first)
    assert abs(mean - 0.5) < 0.01
    assert all(0 <= r["u"] < 1 for r in first)


def test_standard_normal_moments(spark):
    u, v = draws.uniform("a", "id"), draws.uniform("b", "id")
    frame = spark.range(20000).select(draws.standard_normal(u, v).alias("z"))
    row = frame.agg(F.avg("z"), F.stddev_pop("z")).first()
    assert abs(row[0]) < 0.03 and abs(row[1] - 1) < 0.03


def test_vary_keeps_null(spark):
    assert one(spark, draws.vary(F.lit(None).cast("double"), F.lit(0.3), 0.1)) is None
    assert abs(one(spark, draws.vary(F.lit(100.0), F.lit(0.75), 0.1)) - 105.0) < 1e-9
