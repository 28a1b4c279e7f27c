"""Loads and days of tables that writers left halfway."""

import datetime as dt
import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from shelfcast.sources import tables


def load(spark, name, n, first=0):
    return spark.range(first, first + n, 1, 4).select("id", F.lit(name).alias("load"), (F.col("id") % 3).alias("k"))


def ids(frame):
    return sorted(r.id for r in frame.select("id").collect())


def folders(base, name):
    return sorted(f for f in glob.glob(f"{base}/{name}/*") if not f.endswith("/log"))


@pytest.mark.parametrize("by", [[], ["k"]])
def test_a_load_that_lost_half_its_files_is_whole_after_a_rerun(spark, tmp_path, by):
    base, name = str(tmp_path), f"halved_{len(by)}"
    tables.replace_table(spark, name, load(spark, "a", 8), base, by, once=["load"])
    tables.append_aligned(spark, name, load(spark, "b", 8, 100), base, once=["load"])
    newest = max(glob.glob(f"{base}/{name}/*/_load=*"), key=os.path.getmtime)
    files = sorted(glob.glob(f"{newest}/**/*.parquet", recursive=True))
    for f in files[: len(files) // 2]:
        os.remove(f)
    assert len(ids(spark.table(name))) < 16
    got = tables.append_aligned(spark, name, load(spark, "b", 8, 100), base, once=["load"])
    assert ids(got) == [*range(8), *range(100, 108)]


def test_an_append_that_failed_before_its_state_is_not_seen(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    tables.append_aligned(spark, "failing", load(spark, "a", 4), base, once=["load"])
    with monkeypatch.context() as patched:
        patched.setattr(tables, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            tables.append_aligned(spark, "failing", load(spark, "b", 4, 10), base, once=["load"])
    assert tables.recover_table(spark, "failing", base) and ids(spark.table("failing")) == [0, 1, 2, 3]
    assert ids(tables.append_aligned(spark, "failing", load(spark, "b", 4, 10), base, once=["load"])) == [0, 1, 2, 3, 10, 11, 12, 13]
    assert tables.drop_old_versions(spark, "failing", base, keep=1) == 1  # what the failed write left
    assert len(ids(spark.table("failing"))) == 8


def test_a_broken_state_changes_nothing(spark, tmp_path):
    base = str(tmp_path)
    tables.replace_table(spark, "cut_off", spark.range(3), base)
    (tmp_path / "cut_off" / "log" / "000000000002.json").write_text('{"version": 2, "fol')
    assert tables.recover_table(spark, "cut_off", base) and spark.table("cut_off").count() == 3


def test_loads_written_together(spark, tmp_path):
    base = str(tmp_path)
    both = load(spark, "a", 3).unionByName(load(spark, "b", 3, 10))
    tables.append_aligned(spark, "together", both, base, once=["load"])
    again = load(spark, "b", 3, 10).unionByName(load(spark, "c", 2, 20))
    assert ids(tables.append_aligned(spark, "together", again, base, once=["load"])) == [0, 1, 2, 10, 11, 12, 20, 21]
    assert ids(tables.append_aligned(spark, "together", load(spark, "a", 3), base, once=["load"])) == [0, 1, 2, 10, 11, 12, 20, 21]
    assert ids(tables.append_aligned(spark, "together", load(spark, "z", 0), base, once=["load"])) == [0, 1, 2, 10, 11, 12, 20, 21]


def test_loads_of_a_table_that_never_told_them_apart(spark, tmp_path):
    base = str(tmp_path)
    tables.replace_table(spark, "untold", load(spark, "a", 3), base)
    assert ids(tables.append_aligned(spark, "untold", load(spark, "a", 3), base, once=["load"])) == [0, 1, 2]
    assert ids(tables.append_aligned(spark, "untold", load(spark, "b", 1, 5), base, once=["load"])) == [0, 1, 2, 5]


def test_days_stand_until_their_replacement_does(spark, tmp_path, monkeypatch):
    base, day = str(tmp_path), dt.date(2024, 1, 1)
    rows = spark.createDataFrame([(1, day), (2, None), (3, day + dt.timedelta(1))], "id long, d date")
    tables.replace_days(spark, "by_days", rows, base, "d")
    newer = spark.createDataFrame([(7, None), (8, day)], "id long, d date")
    with monkeypatch.context() as patched:
        patched.setattr(tables, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            tables.replace_days(spark, "by_days", newer, base, "d")
    assert ids(spark.table("by_days")) == [1, 2, 3]
    assert ids(tables.replace_days(spark, "by_days", newer, base, "d")) == [3, 7, 8]
    assert ids(tables.append_aligned(spark, "by_days", spark.createDataFrame([(9, day)], "id long, d date"), base)) == [3, 7, 8, 9]
    assert ids(tables.replace_days(spark, "by_days", newer, base, "d")) == [3, 7, 8]
    tables.drop_old_versions(spark, "by_days", base, keep=1)
    assert ids(spark.table("by_days")) == [3, 7, 8]


def test_an_empty_table_by_day_has_its_columns(spark, tmp_path):
    base, empty = str(tmp_path), spark.createDataFrame([], "id long, d date, s struct<a:int>")
    tables.ensure_table(spark, "nothing_yet", empty.schema, base, ["d"])
    assert spark.table("nothing_yet").dtypes == [("id", "bigint"), ("s", "struct<a:int>"), ("d", "date")]
    assert spark.table("nothing_yet").collect() == []


def test_two_writers_of_one_version(spark, tmp_path):
    base = str(tmp_path)
    tables.replace_table(spark, "raced", spark.range(2), base)
    state = tables._state(spark, "raced", base)
    tables.append_aligned(spark, "raced", spark.range(5, 6), base)
    late = tables._added(state, "lost", None, [], [])
    with pytest.raises(Exception, match="exist"):
        tables._commit(spark, "raced", base, late)
    assert ids(spark.table("raced")) == [0, 1, 5]


def test_the_log_is_read_without_a_job(spark, tmp_path):
    base = str(tmp_path)
    tables.replace_table(spark, "jobless", spark.range(2), base)
    spark.sparkContext.setJobGroup("log", "")
    assert tables._state(spark, "jobless", base).version == 1
    assert not list(spark.sparkContext.statusTracker().getJobIdsForGroup("log"))
    spark.sparkContext.setJobGroup("", "")


def test_names_with_quotes(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.createDataFrame([(1, "it's"), (2, "a\\b")], "id long, part string")
    tables.replace_table(spark, "quoted", rows, base, ["part"])
    assert ids(spark.table("quoted")) == [1, 2]
    assert ids(tables.replace_days(spark, "quoted", rows.where("id = 1").withColumn("id", F.lit(5).cast("long")), base, "part")) == [2, 5]
    shutil.rmtree(tmp_path / "quoted")
