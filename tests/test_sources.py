import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from starfold.operators.dedup import keep_first
from starfold.sources import files, jdbc, pages
from starfold.sources.store import Store
from starfold.streaming.landing import load_landed_pages

HARD_TEXT = ["", " blanks ", 'quote " and ; inside', "two\nlines", "cr\r\nlf", '"', '""', ";", "\\", "a\\", "\t", None, "é漢"]


def test_csv_keeps_every_text(spark, folder, as_rows):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(HARD_TEXT)], "k string, t string")
    files.write_csv(df, f"{folder}/csv")
    assert as_rows(files.read_csv(spark, f"{folder}/csv", ["k", "t"])) == as_rows(df)


def test_slices_replace_only_their_day(spark, folder, as_rows):
    path = f"{folder}/t"
    schema = "k int, day string"
    files.write_slices(spark.createDataFrame([(1, "2010-01-01"), (2, "2010-01-02")], schema), path, F.col("day"))
    files.write_slices(spark.createDataFrame([(3, "2010-01-02")], schema), path, F.col("day"))
    files.write_slice(spark.createDataFrame([(4, "2010-01-03")], schema), path, "2010-01-03")
    assert as_rows(spark.read.parquet(path).select("k")) == [(1,), (3,), (4,)]
    assert as_rows(files.read_slice(spark, path, "2010-01-02")) == [(3, "2010-01-02")]
    assert files.read_slice(spark, path, "2010-01-04") is None


def test_only_a_missing_path_is_no_data(spark, folder):
    os.makedirs(f"{folder}/bad")
    with open(f"{folder}/bad/part.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        files.read_or_none(spark, f"{folder}/bad").count()


@pytest.mark.parametrize("kind", ["string", "timestamp"])
def test_day_before(spark, as_rows, kind):
    times = ["2010-01-01 23:59:59.999", "2010-01-02 00:00:00.000", "2010-01-02 23:59:59.999", "2010-01-03 00:00:00.000", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "k int, t string")
    df = df.withColumn("t", F.col("t").cast(kind))
    assert as_rows(files.day_before(df, "t", "2010-01-03"), "k") == [(1,), (2,)]


def test_day_before_reaches_the_scan(spark, folder):
    spark.createDataFrame([(1, "2010-01-01 00:00:00.000")], "k int, t string").write.parquet(f"{folder}/t")
    df = files.day_before(spark.read.parquet(f"{folder}/t"), "t", "2010-01-03").select("k")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t,2010-01-02)" in plan and "LessThan(t,2010-01-03)" in plan


def test_jdbc_options():
    url, login = "jdbc:postgresql://host/db", {"user": "u", "password": "p"}
    plain = jdbc.read_options(url, login, table="t")
    assert plain == {"url": url, "user": "u", "password": "p", "fetchsize": "10000", "dbtable": "t"}
    assert jdbc.read_options(url, login, query="select 1")["query"] == "select 1"
    split = jdbc.read_options(url, login, query="select * from t", split=jdbc.Split("id", "0", "100", 8))
    assert split["dbtable"] == "(select * from t) rows_to_read" and "query" not in split
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "100", "8")
    with pytest.raises(ValueError):
        jdbc.read_options(url, login)
    assert jdbc.write_options(url, login, "t", keep_definition=True)["truncate"] == "true"
    assert "truncate" not in jdbc.write_options(url, login, "t")


def record(i, **fields):
    return {"milestone_id": i, "object_id": f"c:{i}", "milestone_at": "2010-01-01", **fields}


def land(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        json.dump(records, f, indent=1)


def test_pages_are_lists_of_records(spark, folder, as_rows):
    land(f"{folder}/p", "a", [record(1, description=' "x"\n'), record(2, description="nan", source_url="")])
    land(f"{folder}/p", "b", [])
    got = pages.read_pages(spark, f"{folder}/p")
    assert got.columns == list(pages.MILESTONE_FIELDS)
    assert as_rows(got, "milestone_id", "description", "source_url") == [("1", "'x'", None), ("2", None, None)]


def test_no_page_is_an_empty_table(spark, folder):
    os.makedirs(f"{folder}/none")
    got = pages.read_pages(spark, f"{folder}/none")
    assert got.columns == list(pages.MILESTONE_FIELDS) and got.count() == 0


@pytest.mark.parametrize(
    "first, last, expected",
    [
        ("2010-01-01", "2010-01-01", [("2010-01-01", "2010-01-02")]),
        ("2010-01-01", "2010-12-31", [("2010-01-01", "2011-01-01")]),
        ("2008-06-18", "2010-12-12", [("2008-06-18", "2009-06-18"), ("2009-06-18", "2010-06-18"), ("2010-06-18", "2010-12-13")]),
        ("2008-02-29", "2012-03-01", [("2008-02-29", "2009-02-28"), ("2009-02-28", "2010-02-28"), ("2010-02-28", "2011-02-28"), ("2011-02-28", "2012-02-29"), ("2012-02-29", "2012-03-02")]),
    ],
)
def test_windows_cover_the_range_without_overlap(spark, first, last, expected):
    bounds = spark.createDataFrame([(datetime.date.fromisoformat(first), datetime.date.fromisoformat(last))], "a date, b date")
    got = pages.backfill_windows(bounds, "a", "b").orderBy("window_no").collect()
    assert [(str(r.start_date), str(r.end_date)) for r in got] == expected


def test_windows_are_read_one_per_task(spark, as_rows):
    def fetch(start, end):
        year = int(start[:4])
        yield {"milestone_id": year, "milestone_at": start, "description": "None"}
        yield {"milestone_id": year, "milestone_at": start, "description": "None"}
        yield {"milestone_id": 1, "milestone_at": "shared"}

    windows = [("2008-01-01", "2009-01-01"), ("2009-01-01", "2010-01-01")]
    got = pages.read_windows(spark, windows, fetch)
    assert as_rows(got, "milestone_id", "milestone_at", "description") == [
        ("1", "shared", None), ("2008", "2008-01-01", None), ("2009", "2009-01-01", None)
    ]


def test_landed_files_are_loaded_once(spark, folder, as_rows):
    staging = Store(spark, f"{folder}/staging")

    def run():
        load_landed_pages(spark, f"{folder}/in", staging, "milestones", "milestone_id", f"{folder}/cp").awaitTermination(120)

    land(f"{folder}/in", "a", [record(1, description="x"), record(2, description="y"), record(2, description="y")])
    run()
    run()
    assert Store(spark, f"{folder}/staging").current("milestones").number == 1
    land(f"{folder}/in", "b", [record(2, description="new"), record(3)])
    run()
    assert as_rows(staging.read("milestones"), "milestone_id", "description") == [("1", "x"), ("2", "new"), ("3", None)]


def test_a_batch_that_is_replayed_changes_nothing(spark, folder, as_rows):
    staging, checkpoint = Store(spark, f"{folder}/staging"), f"{folder}/cp"

    def run():
        load_landed_pages(spark, f"{folder}/in", staging, "milestones", "milestone_id", checkpoint).awaitTermination(120)

    land(f"{folder}/in", "a", [record(1, description="x")])
    run()
    version = staging.current("milestones")
    # As if the run had stopped after the table's commit and before the stream's.
    os.remove(f"{checkpoint}/commits/0")
    os.path.exists(f"{checkpoint}/commits/.0.crc") and os.remove(f"{checkpoint}/commits/.0.crc")
    run()
    assert staging.current("milestones") == version and list(version.taken.values()) == [0]
    # A query with a checkpoint of its own starts from its first batch.
    land(f"{folder}/in", "b", [record(2)])
    checkpoint = f"{folder}/other"
    run()
    assert as_rows(staging.read("milestones"), "milestone_id") == [("1",), ("2",)] and len(staging.current("milestones").taken) == 2


def test_records_meet_their_window(spark, as_rows):
    day = lambda text: datetime.date.fromisoformat(text)
    windows = spark.createDataFrame(
        [(0, day("2008-02-29"), day("2009-02-28")), (1, day("2009-02-28"), day("2009-03-02"))], "window_no int, start_date date, end_date date")
    texts = ["2008-02-28", "2008-02-29", "2009-02-27", "2009-02-28", "2009-03-01", "2009-03-02", None, "bad"]
    records = spark.createDataFrame([(t,) for t in texts], "t string")
    found = pages.in_windows(records, F.col("t").try_cast("date"), windows)
    assert found.columns == ["t", "window_no", "start_date", "end_date"]
    assert as_rows(found, "t", "window_no") == [("2008-02-29", 0), ("2009-02-27", 0), ("2009-02-28", 1), ("2009-03-01", 1)]


def test_store_lists_tables(spark, folder, as_rows):
    store = Store(spark, folder)
    store.commit("a", spark.range(3))
    store.commit("a", keep_first(spark.range(5), ["id"]))
    assert as_rows(store.tables(["a", "b"])) == as_rows(store.tables()) == [("a", 2, 5)]


def test_a_store_keeps_to_one_state(spark, folder):
    Store(spark, folder).commit("a", spark.range(3))
    reader = Store(spark, folder)
    assert reader.read("a").count() == 3
    Store(spark, folder).commit("a", spark.range(5))
    assert reader.read("a").count() == 3
    assert Store(spark, folder).read("a").count() == 5
