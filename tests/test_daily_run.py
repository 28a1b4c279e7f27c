"""Tables that outlive a session, landed rows, late facts, and runs that are repeated or incremental."""

import datetime as dt
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from shelfcast.plans.daily_run import (
    Run,
    extend_silver,
    land_responses,
    load_fulfillment,
    load_search,
    load_stores,
    run_all,
    update_features,
    update_scores,
)
from shelfcast.plans.gold import GOLD_COLUMNS, gold
from shelfcast.plans.model import fit
from shelfcast.plans.price_snapshot import latest_record
from shelfcast.plans.silver import latest_prices, one_trend_a_day, silver
from shelfcast.plans.trends import generated_trends
from shelfcast.schemas import PRODUCT_FULFILLMENT, PRODUCT_SEARCH, STORE_DATA
from shelfcast.session import ship_package
from shelfcast.sources import tables
from shelfcast.sources.column_roles import marginal_kinds, read_roles, write_role_document, write_roles
from shelfcast.sources.landed_json import as_fulfillment, store_rows
from shelfcast.streaming.silver_intake import take_new_facts
from tests.test_jobs import bronze, facts

NOW = dt.datetime(2024, 3, 1, 6, 30)
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SESSION = """
import sys, datetime as dt
sys.path.insert(0, sys.argv[1])
from shelfcast.session import build_session
from shelfcast.sources import tables
from shelfcast.plans.alerts import send_alerts
spark = build_session("other", "local[2]", 2, "1g")
base = sys.argv[2]
rows = spark.range(3)
tables.append_aligned(spark, "kept.numbers", rows, base)
if not tables.table_exists(spark, "kept.pairs", base):
    tables.replace_table(spark, "kept.pairs", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), base)
tables.upsert_table(spark, "kept.pairs", spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"], base)
scores = spark.createDataFrame([(1, 1, dt.date(2024, 3, 1), True, 0.9, 1)],
    "store_id int, product_id int, event_date date, stockout_label boolean, "
    "predicted_stockout_proba double, predicted_stockout_flag int")
sent = send_alerts(spark, scores, dt.datetime(2024, 3, int(sys.argv[3])), base, "kept.outbox", "kept.log")
print("RESULT", spark.table("kept.numbers").count(), spark.table("kept.pairs").count(), sent,
      spark.table("kept.outbox").count(), spark.table("kept.log").count())
"""


def test_tables_outlive_the_session(tmp_path):
    got = []
    for day in (1, 2):
        done = subprocess.run(
            [sys.executable, "-c", SESSION, ROOT, str(tmp_path / "tables"), str(day)],
            capture_output=True, text=True, timeout=240, cwd=tmp_path,
        )
        assert "RESULT" in done.stdout, done.stderr[-2000:]
        got.append(done.stdout.split("RESULT")[1].split())
    assert got == [["3", "3", "1", "1", "1"], ["6", "3", "0", "1", "1"]]


def test_schema_changes_and_old_versions(spark, tmp_path):
    base = str(tmp_path)
    tables.replace_table(spark, "changing", spark.range(3), base)
    changed = spark.table("changing").select(F.col("id").cast("string").alias("key"), F.lit(1).alias("n"))
    assert tables.replace_table(spark, "changing", changed, base).columns == ["key", "n"]
    tables.replace_table(spark, "changing", spark.table("changing").limit(2), base)
    spark.sql("DROP VIEW changing")
    assert not tables.table_exists(spark, "changing")
    assert tables.table_exists(spark, "changing", base) and spark.table("changing").count() == 2
    assert tables.drop_old_versions(spark, "changing", base, keep=1) == 2
    assert tables.drop_old_versions(spark, "changing", base, keep=1) == 0
    assert spark.table("changing").count() == 2


def test_days_are_replaced_from_the_table_itself(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.range(6).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("d"))
    tables.replace_days(spark, "by_day", rows, base, "d")
    again = spark.table("by_day").filter("d = DATE'2024-01-02'").withColumn("id", F.col("id") + 100)
    got = sorted(r["id"] for r in tables.replace_days(spark, "by_day", again, base, "d").collect())
    assert got == [0, 2, 3, 5, 101, 104]
    plan = spark.table("by_day").filter("d = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
    late = spark.createDataFrame([(7,)], "id long").withColumn("d", F.lit("2024-02-01").cast("date"))
    assert tables.append_aligned(spark, "by_day", late, base).count() == 7
    with pytest.raises(ValueError, match="not partitioned"):
        tables.replace_days(spark, "by_day", late, base, "id")


def test_appending_a_load_once(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.createDataFrame([(1, "t1"), (2, "t1")], "k int, load string")
    for _ in range(2):
        assert tables.append_aligned(spark, "once_only", rows, base, once=["load"]).count() == 2
    more = rows.withColumn("load", F.lit("t2"))
    assert tables.append_aligned(spark, "once_only", more, base, once=["load"]).count() == 4


def test_the_shared_folder_is_never_local_on_a_cluster(spark, monkeypatch):
    from shelfcast import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())


def test_package_archive(spark):
    import zipfile

    names = zipfile.ZipFile(ship_package(spark)).namelist()
    assert "shelfcast/__init__.py" in names and "shelfcast/plans/gold.py" in names


def test_unreadable_times_do_not_empty_the_prices(spark):
    rows = [(1.0, "2024-02-01T00:00:00"), (2.0, "unknown"), (3.0, None)]
    frame = spark.createDataFrame(rows, "price double, record_date string")
    assert latest_record(frame) == dt.datetime(2024, 2, 1)
    with pytest.raises(ValueError, match="readable"):
        latest_record(frame.filter("price > 1"))
    assert latest_record(frame.limit(0)) is None


def test_one_price_and_one_trend_a_day(spark):
    search = spark.createDataFrame(
        [(1, "7", 2.0, "2024-01-01T00"), (1, "7", 3.0, "2024-01-02T00"), (1, "7", None, "2024-01-03T00")],
        "store_id long, product_id string, price double, load_timestamp string",
    )
    assert [r["price"] for r in latest_prices(search).collect()] == [3.0]
    trend = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "a", "r", 5), (dt.datetime(2024, 1, 1), "b", "r", 9), (dt.datetime(2024, 1, 1), "a", "q", None)],
        "dt timestamp, keyword string, region string, interest_score long",
    )
    assert [r["interest_score"] for r in one_trend_a_day(trend).collect()] == [9]
    assert [r["interest_score"] for r in one_trend_a_day(trend, "a").collect()] == [5]


def test_stores_without_an_id_do_not_stop_silver(spark):
    body = {"data": {"nearby_stores": {"stores": [{"store_id": " ", "location_name": "Blank"}, {"store_id": "1", "location_name": "North"}]}}}
    stores = store_rows(spark.createDataFrame([(json.dumps(body),)], "body string"), "body", F.lit("2024-03-01"))
    inputs = {**bronze(spark), "stores": stores}
    rows = facts(spark, [(1, "10", "2024-02-01", 3.0)])
    got = silver(rows, load_ts=F.lit(NOW).cast("timestamp"), latest_product_only=True, **inputs).collect()
    assert [r["location_name"] for r in got] == ["North"]


def test_the_newest_observation_wins(spark):
    rows = facts(spark, [(1, "10", "2024-02-01", 3.0)]).withColumn("load_timestamp", F.lit("2024-02-01T10:00:00"))
    newer = facts(spark, [(1, "10", "2024-02-01", 8.0)]).withColumn("load_timestamp", F.lit("2024-02-02T10:00:00"))
    stamp = F.lit(NOW).cast("timestamp")
    both = silver(rows.unionByName(newer), load_ts=stamp, latest_product_only=True, with_load_time=True, **bronze(spark))
    assert [r["available_to_promise_qty"] for r in gold(both, stamp).collect()] == [8.0]


def test_late_facts_are_taken_within_the_trailing_days(spark, tmp_path):
    path, inputs = str(tmp_path / "silver"), bronze(spark)
    run = Run(spark, str(tmp_path), "db", dt.datetime(2024, 2, 10))
    first = facts(spark, [(1, "10", "2024-02-01", 3.0), (1, "10", "2024-02-08", 4.0), (1, "10", "2031-01-01", 1.0)])
    extend_silver(run, {"fulfillment": first, **inputs}, path)
    late = first.unionByName(facts(spark, [(2, "10", "2024-02-08", 5.0), (1, "10", "2024-02-09", 6.0)]))
    got = extend_silver(run, {"fulfillment": late, **inputs}, path, trailing_days=7).collect()
    assert sorted((str(r["record_date"]), r["store_id"]) for r in got) == [
        ("2024-02-01", 1), ("2024-02-08", 1), ("2024-02-08", 2), ("2024-02-09", 1), ("2031-01-01", 1),
    ]


def test_a_new_checkpoint_does_not_overwrite_old_batches(spark, tmp_path):
    landing, target = (str(tmp_path / n) for n in ("landing", "silver"))
    inputs, stamp = bronze(spark), F.lit(NOW).cast("timestamp")
    facts(spark, [(1, "10", "2024-02-02", 3.0)]).write.parquet(landing)
    for n in ("a", "b"):
        take_new_facts(spark, landing, inputs, target, str(tmp_path / n), stamp)
    assert spark.read.parquet(target).count() == 2


def landed(spark, days, load, qty):
    """Facts of three series as landed rows of one load."""
    rows = [
        (store, str(product), (dt.date(2024, 1, 1) + dt.timedelta(days=d)).isoformat(), float((qty * (d + 1) * product) % 7), load)
        for d in days for store, product in ((1, 10), (1, 11), (2, 10)) if (d + product + store) % 4
    ]
    frame = spark.createDataFrame(rows, "store_id long, product_tcin string, record_date string, available_to_promise_qty double, load_timestamp string")
    return frame.withColumn("load_date", F.substring("load_timestamp", 1, 10)).withColumn("is_sold_out", F.lit("false"))


def search_of(spark):
    rows = [(s, p, f"title {p}", 10.0 + int(p), "2024-01-05", "2024-01-05T00:00:00") for s in (1, 2) for p in ("10", "11")]
    frame = spark.createDataFrame(rows, "store_id long, product_id string, title string, price double, load_date string, load_timestamp string")
    return frame.withColumn("record_date", F.col("load_timestamp"))


def test_incremental_equals_full(spark, tmp_path):
    """Landed loads day after day, one of them late for old days; then all at once."""
    stores = spark.createDataFrame([("k", "1", "North", "", "", "", "", "", 1.0, "", NOW)], STORE_DATA)
    keyword = spark.createDataFrame([("k", "r")], "keyword string, region string")
    loads = [(range(0, 20), 3), (range(18, 24), 5), (range(5, 7), 4), (range(24, 26), 2)]
    undated = {1: ["someday", None], 3: ["someday"]}  # the last but one load has readable days only
    shown = [c for c in gold_columns() if c not in ("silver_load_ts", "gold_load_ts")]
    written = None
    for i, (days, qty) in enumerate(loads):
        now = dt.datetime(2024, 2, 1 + i)
        rows = landed(spark, days, now.isoformat(), qty)
        for day in undated.get(i, []):
            rows = rows.unionByName(rows.limit(1).withColumn("record_date", F.lit(day).cast("string")))
        for _ in range(2 if i == 1 else 1):  # repeated as of the same time: nothing changes
            written = run_all(
                Run(spark, str(tmp_path / "inc"), "inc", now), None, stores, [], None,
                generated_trends(keyword, dt.date(2024, 2, 1), NOW), landed_search=search_of(spark),
                landed_fulfillment=rows, incremental=True,
            )
    step = sorted(map(str, written["gold"].select(*shown).collect()))
    bronze_rows = {
        "fulfillment": spark.table("inc.product_fulfillment"), "search": spark.table("inc.product_search"),
        "stores": spark.table("inc.store_data"), "trends": spark.table("inc.trend_history"),
        "prices": spark.table("inc.price_history"),
    }
    stamp = F.lit(NOW).cast("timestamp")
    whole = silver(load_ts=stamp, latest_product_only=True, with_load_time=True, **bronze_rows)
    columns = [c for c in whole.columns if c != "silver_load_ts"]
    every = sorted(map(str, whole.select(*columns).collect()))
    assert sorted(map(str, spark.table("inc.silver").select(*columns).collect())) == every
    assert sum("record_date=None" in r for r in every) == 3
    whole = gold(whole, stamp)
    assert step == sorted(map(str, whole.select(*shown).collect())) and len(step) > 50
    assert spark.table("inc.training_run").count() == len(loads)
    assert spark.table("inc.product_fulfillment").count() == 3 + sum(landed(spark, d, "x", q).count() for d, q in loads)


def gold_columns():
    from shelfcast.plans.gold import GOLD_COLUMNS

    return GOLD_COLUMNS


def test_landed_fields_reach_the_table(spark, tmp_path):
    flat = spark.createDataFrame(
        [("9", 1, "2024-01-02", "2024-01-03T00", "Ground", "true", "IN_STOCK", 4.0, False)],
        "tcin string, store_id long, record_date string, load_timestamp string, "
        "services_shipping_method_short_description string, services_is_two_day_shipping string, "
        "data_product_fulfillment_shipping_options_shipping_availability_status string, "
        "data_product_fulfillment_shipping_options_available_to_promise_qty double, "
        "data_product_fulfillment_is_sold_out boolean",
    )
    row = as_fulfillment(flat).first()
    assert row["product_tcin"] == row["tcin"] == "9" and row["shipping_method_short_description"] == "Ground"
    assert row["available_to_promise_qty"] == 4.0 and row["is_sold_out"] == "false" and row["load_ts"] == "2024-01-03T00"
    assert row["shipping_availability_status"] == "IN_STOCK" and row["charge_one_day"] is None
    run = Run(spark, str(tmp_path), "landed", NOW)
    for _ in range(2):
        assert load_fulfillment(run, None, landed=as_fulfillment(flat)).count() == 1
    assert spark.table("landed.product_fulfillment").schema == PRODUCT_FULFILLMENT
    # nothing landed: the generator's rows, once a run
    products = spark.createDataFrame([("5", "t", 2.0, 4.0)], "product_id string, title string, price double, rating double")
    none = spark.createDataFrame([], PRODUCT_SEARCH)
    for _ in range(2):
        assert load_search(run, products, [1, 2], landed=none).count() == 2
    store = [("k", "1", "North", "", "", "", "", "", 1.0, "", NOW)]
    load_stores(run, spark.createDataFrame(store, STORE_DATA))
    moved = [("k", "1", "South", "", "", "", "", "", 1.0, "", NOW), ("l", "2", "East", "", "", "", "", "", 1.0, "", NOW)]
    got = load_stores(run, spark.createDataFrame(moved, STORE_DATA)).collect()
    assert sorted(r["location_name"] for r in got) == ["East", "South"]


def test_broken_responses_leave_no_facts(spark, tmp_path):
    """A broken body of a newer load doesn't stand in for the good row of its day."""
    run = Run(spark, str(tmp_path), "bodies", NOW)
    good = json.dumps({"data": {"product": {"fulfillment": {"is_sold_out": False, "shipping_options": {
        "available_to_promise_qty": 6.0, "services": [{"is_two_day_shipping": True, "shiny": 1}]}}}}})
    lineage = {c: c for c in ("store_id", "tcin", "record_date", "load_date", "load_timestamp")}
    loads = [("2024-02-01T10:00:00", good), ("2024-02-02T10:00:00", good[:-4]), ("2024-02-03T10:00:00", "[]")]
    for stamp, body in loads:
        frame = spark.createDataFrame(
            [(1, "10", "2024-02-01", stamp[:10], stamp, body)],
            "store_id long, tcin string, record_date string, load_date string, load_timestamp string, body string",
        )
        for _ in range(2):
            rows = land_responses(run, frame, "body", lineage)
            if not rows.isEmpty():
                load_fulfillment(run, None, landed=rows)
    assert sorted((r.load_timestamp[:10], r.reason) for r in spark.table("bodies.landed_rejects").collect()) == [
        ("2024-02-02", "not JSON"), ("2024-02-03", "not a JSON object"),
    ]
    kept = spark.table("bodies.product_fulfillment")
    assert [(r.available_to_promise_qty, r.is_two_day_shipping) for r in kept.collect()] == [(6.0, "true")]
    stamp = F.lit(NOW).cast("timestamp")
    made = gold(silver(kept, load_ts=stamp, latest_product_only=True, with_load_time=True, **bronze(spark)), stamp)
    assert [r["available_to_promise_qty"] for r in made.collect()] == [6.0]


def test_both_forms_of_role_files(spark, tmp_path):
    roles = spark.createDataFrame([("a", "numerical"), ("b", "id"), ("c", "datetime"), ("d", "boolean"), ("e", "numerical")], "column_name string, sdtype string")
    write_roles(roles, str(tmp_path / "lines"))
    write_role_document(roles, str(tmp_path / "document"))
    path = tmp_path / "given.json"
    path.write_text(json.dumps({"METADATA_SPEC_VERSION": "V1", "columns": {r["column_name"]: {"sdtype": r["sdtype"]} for r in roles.collect()}}, indent=2))
    for form in ("lines", "document", "given.json"):
        assert sorted(map(tuple, read_roles(spark, str(tmp_path / form)).collect())) == sorted(map(tuple, roles.collect())), form
    frame = spark.createDataFrame([], "a int, b string, c string, d boolean, e string, f string")
    assert marginal_kinds(roles, frame) == (["a"], ["d", "e"], ["c"])


def test_the_fact_load_shuffles_row_ids_only(spark, tmp_path, monkeypatch):
    plans = []
    write = tables._write_load

    def seen(session, root, df, folder, by):
        plans.append((root, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(session, root, df, folder, by)

    monkeypatch.setattr(tables, "_write_load", seen)
    search = spark.createDataFrame([(s, p, "2024-03-01") for s in range(3) for p in range(9)], "store_id long, product_id long, load_date string")
    load_fulfillment(Run(spark, str(tmp_path), "facts_by_id", NOW), search)
    plan = next(p for root, p in plans if root.endswith("product_fulfillment"))
    above, below = plan.split("Join", 1)
    assert "method" in above and "method" not in below.split("LocalRelation")[0]


def test_features_and_scores_are_written_as_gold_lies(spark, tmp_path, monkeypatch):
    plans = []
    write = tables._write_load

    def seen(session, root, df, folder, by):
        plans.append((root.rsplit("/", 1)[1], df._jdf.queryExecution().optimizedPlan().toString()))
        return write(session, root, df, folder, by)

    monkeypatch.setattr(tables, "_write_load", seen)
    rows = [(i % 5, i, dt.date(2024, 2, 1 + i % 9), i % 3 == 0, float(i % 7)) for i in range(90)]
    columns = {"store_id": 0, "product_id": 1, "ds": 2, "stockout_next_7d": 3}
    frame = spark.createDataFrame(rows, "store_id int, product_id int, ds date, stockout_next_7d boolean, v double")
    whole = [F.col(c) if c in columns else F.lit("x").alias(c) if c in ("brand", "category") else F.col("v").alias(c) for c in GOLD_COLUMNS]
    run = Run(spark, str(tmp_path), "as_it_lies", NOW)
    stored = tables.replace_table(spark, run.name("gold"), frame.select(*whole), run.base, ["ds"])
    for first in (None, dt.date(2024, 2, 5)):
        features = update_features(run, stored, first)
        update_scores(run, features, fit(features, max_iter=5), first)
    written = [p for name, p in plans if name in ("stockout_feature_rows", "stockout_predictions")]
    assert len(written) == 4 and not any("Rebalance" in p for p in written)
    assert spark.table(run.name("stockout_feature_rows")).count() == 90
    assert spark.table(run.name("stockout_predictions")).count() == 90
