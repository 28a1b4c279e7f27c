"""Sources, sinks and whole jobs on small frames."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from shelfcast.checks.q_generators import seed_products
from shelfcast.plans import fulfillment as ff
from shelfcast.plans.alerts import candidates, send_alerts
from shelfcast.plans.copula import fit_copula, sample_copula
from shelfcast.plans.daily_run import Run, extend_silver, run_all
from shelfcast.plans.price_snapshot import latest_record, price_snapshot
from shelfcast.plans.search_snapshot import search_snapshot
from shelfcast.plans.silver import SILVER_COLUMNS, silver
from shelfcast.plans.trends import generated_trends, landed_trends, trends
from shelfcast.schemas import GOLD_KEY, PRICE_DETAILS, PRODUCT_FULFILLMENT, PRODUCT_SEARCH, SERIES_KEY, STORE_DATA, TRENDS
from shelfcast.session import fresh_path, shared_dir
from shelfcast.sources import tables
from shelfcast.sources.column_roles import detect_roles
from shelfcast.sources.csv_files import read_seed_products
from shelfcast.sources.landed_json import fulfillment_rows, store_rows
from shelfcast.streaming.silver_intake import take_new_facts

NOW = dt.datetime(2024, 3, 1, 6, 30)
PREDICTION = (
    "store_id int, product_id int, event_date date, stockout_label boolean, "
    "predicted_stockout_proba double, predicted_stockout_flag int"
)


def test_shared_dir_is_the_checkpoint_dir(spark):
    folder = shared_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir") == folder
    assert fresh_path(spark, "x").startswith(folder)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_seed_csv(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text(
        'product_id,title,price,rating\n'
        '007,"Wreath, 20"" with ""lights""",12.5,4\n'
        "8,Star &#34;big&#34;﻿,n/a,\n"
        ",no id,1,1\n"
        "9,,1,1\n",
        encoding="utf-8",
    )
    got = {r["product_id"]: r for r in read_seed_products(spark, str(path)).collect()}
    assert set(got) == {"007", "8"}
    assert got["007"]["title"] == 'Wreath, 20" with "lights"'
    assert got["8"]["title"] == "Star &#34;big&#34;﻿"
    assert got["8"]["price"] is None and got["8"]["rating"] is None


def service_schema():
    def struct(**fields):
        return T.StructType([T.StructField(k, v) for k, v in fields.items()])

    service = struct(method=T.StringType(), days=T.IntegerType())
    options = struct(services=T.ArrayType(service), status=T.StringType())
    return struct(data=struct(product=struct(fulfillment=struct(shipping_options=options))))


def test_fulfillment_rows_keep_responses_without_services(spark):
    def body(services):
        return json.dumps({"data": {"product": {"fulfillment": {"shipping_options": services}}}})

    rows = [
        (1, body({"services": [{"method": "A", "days": 1}, {"method": "B"}], "status": "OK"})),
        (2, body({"services": []})),
        (3, json.dumps({"data": {"product": {}}})),
        (4, body({"services": "none", "status": "OK"})),
        (5, "not json"),
    ]
    frame = spark.createDataFrame(rows, "id int, Body string")
    out = fulfillment_rows(frame, "Body", service_schema(), {"store_id": "id"})
    assert "data_product_fulfillment_shipping_options_status" in out.columns
    got = sorted(((r["store_id"], r["services_method"], r["services_days"]) for r in out.collect()), key=str)
    assert got == [(1, "A", 1), (1, "B", None), (2, None, None), (3, None, None), (4, None, None), (5, None, None)]


def test_store_rows(spark):
    stores = [
        {"store_id": "12", "location_name": "North", "distance": "1.5", "mailing_address": {"city": "Town", "region": "MA"}},
        {"store_id": " ", "location_name": "South", "distance": "far", "mailing_address": {"address_line1": "1 Main St"}},
        {"location_name": "East"},
    ]
    bodies = [(json.dumps({"data": {"nearby_stores": {"stores": stores}}}),), ("{}",)]
    frame = spark.createDataFrame(bodies, "body string")
    got = {r["location_name"]: r for r in store_rows(frame, "body", F.lit("2024-03-01")).collect()}
    assert got["North"]["business_key"] == "12" and got["North"]["address"] == "Town, MA"
    assert got["South"]["business_key"].startswith("addr_") and got["South"]["distance"] is None
    assert got["East"]["address"] == "" and got["East"]["store_id"] is None
    assert list(got["East"].asDict()) == STORE_DATA.fieldNames()


def test_replace_keeps_the_old_rows_if_the_write_fails(spark, tmp_path):
    base = str(tmp_path)
    tables.replace_table(spark, "keep_me", spark.range(3), base)
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        tables.replace_table(spark, "keep_me", broken, base)
    assert spark.table("keep_me").count() == 3
    grown = spark.table("keep_me").unionByName(spark.range(10, 12).toDF("id"))
    assert tables.replace_table(spark, "keep_me", grown, base).count() == 5


def test_generated_rows_obey_the_rules(spark):
    products = spark.createDataFrame(
        [(str(i), f"t{i}", float(20 + 9 * i), 4.9) for i in range(40)] + [("x", "t", None, None)],
        "product_id string, title string, price double, rating double",
    )
    search = search_snapshot(products, [1, 2, 3], NOW.date(), NOW, default_brand="House")
    assert search.schema.fieldNames() == PRODUCT_SEARCH.fieldNames()
    assert search.count() == 123
    assert search.filter("price * 2 <> round(price * 2)").isEmpty()
    assert search.filter("rating > 5 or rating < 0").isEmpty()
    assert search.filter("product_id = 'x' and (price is not null or rating is not null)").isEmpty()
    assert latest_record(search) == NOW
    prices = price_snapshot(search)
    assert prices.schema.fieldNames() == PRICE_DETAILS.fieldNames()
    assert prices.count() == 120 * 7  # without the product that has no price
    days = [r[0] for r in prices.select("record_date").distinct().orderBy("record_date").collect()]
    assert days == [NOW - dt.timedelta(days=i) for i in range(7, 0, -1)]
    assert prices.filter("current_retail_min > current_retail_max or reg_retail_min > reg_retail_max").isEmpty()
    assert prices.filter("not is_current_price_range and current_retail_min <> price").isEmpty()
    assert prices.filter("cart_add_on_threshold not between 1 and 20").isEmpty()
    per_price = prices.groupBy("price").agg(F.count_distinct("cart_add_on_threshold").alias("n"))
    assert per_price.filter("n > 1").isEmpty()
    assert sorted(map(str, prices.collect())) == sorted(map(str, price_snapshot(search.repartition(5)).collect()))


def test_price_snapshot_of_nothing(spark):
    empty = price_snapshot(spark.createDataFrame([], PRODUCT_SEARCH))
    assert empty.count() == 0 and empty.schema.fieldNames() == PRICE_DETAILS.fieldNames()


def test_brands_are_drawn_from_observed_values(spark):
    products = spark.createDataFrame([(str(i), "t", 10.0, 4.0) for i in range(60)], "product_id string, title string, price double, rating double")
    brands = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "brand string")
    got = search_snapshot(products, [1, 2], NOW.date(), NOW, brands=brands)
    assert got.count() == 120
    assert {r["brand"] for r in got.select("brand").distinct().collect()} == {"a", "b"}


def test_trend_series_rises_and_peaks(spark):
    keyword = spark.createDataFrame([("k", "r")], "keyword string, region string")
    rows = generated_trends(keyword, NOW.date(), NOW).orderBy("dt").collect()
    assert len(rows) == 90 and rows[-1]["dt"].date() == NOW.date()
    scores = [r["interest_score"] for r in rows]
    assert all(0 <= s <= 100 for s in scores)
    assert min(scores[-13:]) > max(scores[:60])


def test_landed_trends_win_over_generated_ones(spark):
    schema = "date timestamp_ntz, score int, isPartial boolean"
    landed = landed_trends(spark.createDataFrame([(NOW, 7, False)], schema), "score", "k", "r", NOW)
    none = landed_trends(spark.createDataFrame([], schema), "score", "k", "r", NOW)
    keyword = spark.createDataFrame([("k", "r")], "keyword string, region string")
    generated = generated_trends(keyword, NOW.date(), NOW)
    assert landed.schema.fieldNames() == generated.schema.fieldNames() == TRENDS.fieldNames()
    assert trends(landed, generated).count() == 1
    assert trends(none, generated).count() == 90
    assert trends(None, generated).count() == 90


def test_fulfillment_load(spark):
    pairs = spark.createDataFrame([(s, str(p)) for s in range(3) for p in range(4)], "store_id long, tcin string")
    n = ff.rows_needed(pairs.count())
    assert n == 1000 and ff.rows_needed(1000) == 7000
    sampled = ff.drawn_attributes(ff.row_ids(spark, n)).withColumn("product_id", F.lit("77.0"))
    rows = ff.fulfillment_load(sampled, pairs, NOW.date(), NOW)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in PRODUCT_FULFILLMENT]
    assert rows.count() == 1000
    assert rows.filter("product_tcin <> tcin or product_id <> '77'").isEmpty()
    days = {r[0] for r in rows.select("record_date").distinct().collect()}
    assert days == {f"2024-02-{d}" for d in range(24, 30)} | {"2024-02-24", "2024-03-01"}
    late = F.datediff("min_delivery_date", "record_date"), F.datediff("max_delivery_date", "min_delivery_date")
    assert rows.filter(~late[0].isin(1, 2) | ~late[1].isin(1, 2)).isEmpty()


def bronze(spark, search_loads=1):
    search = spark.createDataFrame(
        [
            (1, "10", f" title {load} ", 5.0, 2.5, "b", 1, 3, "", "c", "", f"2024-02-0{load + 1}", "", "")
            for load in range(search_loads)
        ],
        PRODUCT_SEARCH,
    )
    stores = spark.createDataFrame(
        [("k1", "1", " North ", "", "Town", "MA", "02215", "", 1.0, "", NOW)] * 2
        + [("k2", None, "South", "", "", "", "", "", None, "", NOW)],
        STORE_DATA,
    )
    trend = spark.createDataFrame(
        [(dt.datetime(2024, 2, 1), "k", "r", 40, False, "", "")], TRENDS
    )
    prices = spark.createDataFrame([], PRICE_DETAILS)
    return {"search": search, "stores": stores, "trends": trend, "prices": prices}


def facts(spark, rows):
    """(store_id, product_tcin, record_date, qty) as full fulfillment rows."""
    frame = spark.createDataFrame(rows, "store_id long, product_tcin string, record_date string, available_to_promise_qty double")
    return tables.align_to(frame, PRODUCT_FULFILLMENT)


def test_silver_edges(spark):
    rows = facts(
        spark,
        [(1, "10", "2024-02-01", 3.0), (1, "10", "junk", 3.0), (1, "10", "", 3.0), (1, "11", "2024-02-01", 1.0),
         (1, None, "2024-02-01", 1.0), (None, "10", "2024-02-01", 1.0)],
    )
    out = silver(rows, load_ts=F.lit(NOW).cast("timestamp"), **bronze(spark))
    assert out.columns == SILVER_COLUMNS
    got = sorted(((r["product_id"], str(r["record_date"]), r["title"], r["rating"], r["google_trend_score"], r["location_name"])
                  for r in out.collect()))
    assert got == [
        (10, "2024-02-01", "title 0", 2, 40, "North"),  # rating 2.5 rounds to even
        (10, "None", "title 0", 2, None, "North"),
        (10, "None", "title 0", 2, None, "North"),
        (11, "2024-02-01", None, None, 40, "North"),
    ]


def test_silver_repeats_facts_per_load_unless_told_otherwise(spark):
    rows = facts(spark, [(1, "10", "2024-02-01", 3.0)])
    stamp = F.lit(NOW).cast("timestamp")
    assert silver(rows, load_ts=stamp, **bronze(spark, 3)).count() == 3
    latest = silver(rows, load_ts=stamp, latest_product_only=True, **bronze(spark, 3)).collect()
    assert [r["title"] for r in latest] == ["title 2"]


def test_extend_silver_adds_new_days_only(spark, tmp_path):
    path = str(tmp_path / "silver")
    run = Run(spark, str(tmp_path), "db", NOW)
    inputs = bronze(spark)
    first = facts(spark, [(1, "10", "2024-02-01", 3.0), (1, "10", "2024-02-02", 4.0)])
    assert extend_silver(run, {"fulfillment": first, **inputs}, path).count() == 2
    more = first.unionByName(facts(spark, [(1, "10", "2024-02-03", 5.0)]))
    changed = more.withColumn("available_to_promise_qty", F.lit(9.0))
    got = {str(r["record_date"]): r["available_to_promise_qty"]
           for r in extend_silver(run, {"fulfillment": changed, **inputs}, path).collect()}
    assert got == {"2024-02-01": 3.0, "2024-02-02": 4.0, "2024-02-03": 9.0}


def test_stream_takes_each_file_once(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "silver", "checkpoint"))
    inputs, stamp = bronze(spark), F.lit(NOW).cast("timestamp")

    def take():
        take_new_facts(spark, landing, inputs, target, checkpoint, stamp)
        return sorted((str(r["record_date"]), r["available_to_promise_qty"]) for r in spark.read.parquet(target).collect())

    facts(spark, [(1, "10", "2024-02-02", 3.0)]).write.parquet(landing)
    assert take() == [("2024-02-02", 3.0)]
    assert take() == [("2024-02-02", 3.0)]
    facts(spark, [(1, "10", "2024-02-01", 4.0)]).write.mode("append").parquet(landing)  # late day
    assert take() == [("2024-02-01", 4.0), ("2024-02-02", 3.0)]


def test_alerts_are_sent_once(spark, tmp_path):
    day = dt.date(2024, 3, 1)
    rows = [(1, 1, day, True, 0.80, 1), (1, 2, day, True, 0.7999, 1), (1, 3, day, False, 0.95, 0), (2, 1, day, True, 0.50, 1)]
    predictions = spark.createDataFrame(rows, PREDICTION)
    assert candidates(predictions).count() == 1
    base, names = str(tmp_path), ("outbox_once", "log_once")
    assert send_alerts(spark, predictions, NOW, base, *names) == 1
    assert send_alerts(spark, predictions, NOW + dt.timedelta(days=1), base, *names) == 0
    assert spark.table("outbox_once").count() == spark.table("log_once").count() == 1
    # a run that wrote its outbox and then failed: the next one logs it and sends nothing twice
    more = spark.createDataFrame([(3, 1, day, True, 0.9, 1)], PREDICTION)
    from shelfcast.plans.alerts import alert_messages

    tables.append_aligned(spark, "outbox_once", alert_messages(more), base)
    assert send_alerts(spark, more, NOW + dt.timedelta(days=2), base, *names) == 1
    assert spark.table("outbox_once").count() == spark.table("log_once").count() == 2


def test_roles(spark):
    frame = spark.range(200).select(
        F.col("id"),
        (F.col("id") % 3).cast("string").alias("color"),
        (F.col("id") * 1.5).alias("price"),
        F.lit("x").alias("is_new"),
        F.lit("2024-01-01").alias("record_date"),
        F.col("id").alias("store_id"),
        F.current_date().alias("today"),
    )
    got = {r["column_name"]: r["sdtype"] for r in detect_roles(frame, ["record_date"], ["is_"], ["store_id"]).collect()}
    assert got == {
        "id": "id", "color": "categorical", "price": "numerical", "is_new": "boolean",
        "record_date": "datetime", "store_id": "categorical", "today": "datetime",
    }


def test_whole_run_twice_with_a_fitted_sampler(spark, small):
    base = fresh_path(spark, "run")
    seed = seed_products(spark, small)
    observed = spark.read.parquet(f"{small}/lineitem.parquet").select(
        F.when(F.col("l_quantity") < 8, 0.0).otherwise(F.col("l_quantity")).alias("available_to_promise_qty"),
        F.when(F.col("l_returnflag") == "R", "true").otherwise("false").alias("is_sold_out"),
        F.col("l_linestatus").alias("shipping_availability_status"),
    )
    model = fit_copula(observed, ["available_to_promise_qty"], ["is_sold_out", "shipping_availability_status"])
    stores = spark.createDataFrame([("k", "1", "North", "", "", "", "", "", 1.0, "", NOW)], STORE_DATA)
    keyword = spark.createDataFrame([("k", "r")], "keyword string, region string")
    log_size = 0
    for days in (0, 1):
        run = Run(spark, base, "twice", NOW + dt.timedelta(days=days))
        written = run_all(
            run, seed, stores, [1, 2], None, generated_trends(keyword, run.now.date(), run.now),
            sampler=lambda n: sample_copula(spark, model, n),
        )
        gold = written["gold"]
        assert gold.groupBy(*GOLD_KEY).count().filter("count > 1").isEmpty()
        assert gold.select(*SERIES_KEY).distinct().count() == seed.count() * 2
        assert written["predictions"].count() == gold.count()
        keys = ["store_id", "product_id", "event_date"]
        assert written["log"].groupBy(*keys).count().filter("count > 1").isEmpty()
        assert written["log"].count() == written["outbox"].count() >= log_size
        log_size = written["log"].count()
    assert written["search"].count() == seed.count() * 2 * 2
    assert spark.table("twice.trends").count() == 90
    assert spark.table("twice.training_run").count() == spark.table("twice.model_version").count() == 2


def test_thresholds_and_keys_are_made_before_prices_are_repeated_by_day(spark):
    """Days share a price's threshold; a row's draws are those of its joined keys, nulls left out."""
    from shelfcast.functions.draws import joined_key, uniform
    from shelfcast.plans.price_snapshot import cart_threshold

    day = "2024-03-01T06:00:00"
    rows = [(1, "10", 50.0), (None, "11", 160.0), (2, None, 210.5), (None, "", 9.5)]
    full = [(s, p, "t", price, 2.5, "b", 1, 3, "", "c", "", "2024-03-01", day, day) for s, p, price in rows]
    search = spark.createDataFrame(full, PRODUCT_SEARCH)
    prices = price_snapshot(search)
    plan = prices._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate explode", 1)
    assert "threshold-1" in below and "threshold-1" not in above
    expected = {p: t for p, t in search.select("price", cart_threshold("price")).collect()}
    assert [r["cart_add_on_threshold"] for r in prices.collect()] == [expected[r["price"]] for r in prices.collect()]
    keys = ["store_id", "product_id"]
    frame = spark.createDataFrame([*[r[:2] for r in rows], (None, None)], "store_id long, product_id string")
    joined = frame.select(uniform("a", *keys, F.lit(3)), uniform("a", joined_key(joined_key(*keys), F.lit(3))))
    assert all(a == b for a, b in joined.collect())


def test_attributes_are_drawn_after_the_pairs_are_assigned(spark):
    pairs = spark.createDataFrame([(s, str(p)) for s in range(3) for p in range(4)], "store_id long, tcin string")
    ids = ff.row_ids(spark, 1000)
    plain = ff.fulfillment_load(ff.drawn_attributes(ids), pairs, NOW.date(), NOW)
    later = ff.fulfillment_load(ids, pairs, NOW.date(), NOW, ff.drawn_attributes)
    assert later.schema == plain.schema
    assert sorted(map(str, later.collect())) == sorted(map(str, plain.collect()))
