import pytest
from pyspark.sql import functions as F

from starfold.operators import upsert
from starfold.operators.upsert import DuplicateKeys, duplicate_keys, load
from starfold.sources.store import CommitConflict, Store, Version

SCHEMA = "k int, a string, b string"


def stored(store, as_rows, *columns):
    return as_rows(store.read("t"), *columns)


@pytest.fixture(params=["few rows", "many rows"])
def size(request, monkeypatch):
    monkeypatch.setattr(upsert, "BROADCAST_RATIO", 0)
    if request.param == "many rows":
        monkeypatch.setattr(upsert, "BROADCAST_BYTES", -1)
    return request.param


def test_update_insert_and_kept_columns(spark, folder, as_rows, size):
    store = Store(spark, folder)
    load(store, "t", spark.createDataFrame([(1, "a", "b"), (2, "c", "d"), (3, "e", "f")], SCHEMA), ["k"], "id")
    first_seen = {r.k: r.created_at for r in store.read("t").collect()}
    load(store, "t", spark.createDataFrame([(2, None), (9, "n"), (7, "m")], "k int, a string"), ["k"], "id")
    assert stored(store, as_rows, "id", "k", "a", "b") == [
        (1, 1, "a", "b"), (2, 2, None, "d"), (3, 3, "e", "f"), (4, 7, "m", None), (5, 9, "n", None)
    ]
    now = {r.k: r.created_at for r in store.read("t").collect()}
    assert all(now[k] == first_seen[k] for k in first_seen) and now[9] > first_seen[1]


def test_twice_is_once(spark, folder, as_rows, size):
    store = Store(spark, folder)
    batch = spark.createDataFrame([(1, "a", None), (2, None, "d")], SCHEMA)
    load(store, "t", batch, ["k"], "id")
    once = stored(store, as_rows)
    load(store, "t", batch, ["k"], "id")
    assert stored(store, as_rows) == once
    assert store.current("t").number == 2


def test_null_part_of_a_key(spark, folder, as_rows, size):
    batch = spark.createDataFrame([(1, None, "x"), (1, "a", "y"), (None, None, "z")], SCHEMA)
    plain, safe = Store(spark, f"{folder}/p"), Store(spark, f"{folder}/s")
    for _ in range(2):
        load(plain, "t", batch, ["k", "a"])
        load(safe, "t", batch, ["k", "a"], null_safe=True)
    assert plain.read("t").count() == 5
    assert safe.read("t").count() == 3


def test_repeated_key_fails_and_changes_nothing(spark, folder, as_rows):
    store = Store(spark, folder)
    load(store, "t", spark.createDataFrame([(1, "a", "b")], SCHEMA), ["k"])
    twice = spark.createDataFrame([(2, "a", "b"), (2, "c", "d"), (None, "e", "f"), (None, "g", "h")], SCHEMA)
    with pytest.raises(DuplicateKeys, match="1 keys are repeated"):
        load(store, "t", twice, ["k"])
    assert as_rows(duplicate_keys(twice, ["k"])) == [(2, 2)]
    assert as_rows(duplicate_keys(twice, ["k"], null_safe=True)) == [(None, 2), (2, 2)]
    assert stored(store, as_rows, "k", "a") == [(1, "a")]


def test_failed_write_leaves_the_former_version(spark, folder, as_rows):
    store = Store(spark, folder)
    load(store, "t", spark.createDataFrame([(1, "a", "b")], SCHEMA), ["k"], stamped=False)
    broken = store.read("t").withColumn("a", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        store.commit("t", broken)
    assert stored(store, as_rows) == [(1, "a", "b")]
    store.commit("t", spark.createDataFrame([(5, "e", "f")], SCHEMA))
    assert stored(store, as_rows) == [(5, "e", "f")]


def test_scratch_and_old_versions_are_emptied(spark, folder, as_rows, monkeypatch):
    made = []
    monkeypatch.setattr(upsert, "new_folder", lambda spark, label: made.append(f"{folder}/{label}-{len(made)}") or made[-1])
    store = Store(spark, f"{folder}/s")
    for n in range(4):
        load(store, "t", spark.createDataFrame([(n, "a", "b"), (9, "c", str(n))], SCHEMA), ["k"], "id")
    want = [(1, 0, "b"), (2, 9, "3"), (3, 1, "b"), (4, 2, "b"), (5, 3, "b")]
    assert stored(store, as_rows, "id", "k", "b") == want
    second = store.version("t", 2)
    assert as_rows(store.read("t", version=second), "k", "b") == [(0, "b"), (1, "b"), (9, "1")]
    store.expire("t", older_than=3)
    assert stored(store, as_rows, "id", "k", "b") == want
    assert store.read("t", version=store.version("t", 3)).count() == 4
    assert store.read("t", version=second).count() < 3
    assert len(made) == 8
    for path in made:
        with pytest.raises(Exception, match="(?i)parquet|exist"):
            spark.read.parquet(path)


def files(store, table="t"):
    """For each bucket the files that the current version reads."""
    found = {}
    for path in store.read(table).inputFiles():
        found.setdefault(int(path.split("_bucket=")[1].split("/")[0]), set()).add(path)
    return found


def test_only_buckets_with_a_changed_row_are_written_anew(spark, folder):
    store = Store(spark, folder, bucket_rows=50)
    rows = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("a"), F.lit("b").alias("b"))
    rows.write.parquet(f"{folder}/rows")
    load(store, "t", spark.read.parquet(f"{folder}/rows"), ["k"], "id")
    before = files(store)
    assert store.current("t").n_buckets == len(before) == 32
    load(store, "t", spark.createDataFrame([(5, "x", "y"), (7, "x", "y")], SCHEMA), ["k"], "id")
    after = files(store)
    changed = {b for b in after if after[b] != before[b]}
    assert len(changed) <= 2 and not any(after[b] & before[b] for b in changed)
    assert store.read("t").filter("a = 'x'").count() == 2 and store.read("t").count() == 1000
    # Only new rows: every file stays, and folders are added to the buckets that gain rows.
    load(store, "t", spark.createDataFrame([(5000 + i, "n", "n") for i in range(4)], SCHEMA), ["k"], "id")
    assert all(files(store)[b] >= after[b] for b in after)
    assert sorted(r.id for r in store.read("t").filter("a = 'n'").collect()) == [1001, 1002, 1003, 1004]
    for n in range(upsert.MOST_FOLDERS):
        load(store, "t", spark.createDataFrame([(5000, "n", str(n)), (6000 + n, "n", "n")], SCHEMA), ["k"], "id")
    assert max(store.current("t").folders_of().values()) <= upsert.MOST_FOLDERS
    assert store.current("t").rows == store.read("t").count() == 1004 + upsert.MOST_FOLDERS


def test_a_table_is_dealt_anew_when_it_outgrows_its_buckets(spark, folder, as_rows):
    store = Store(spark, folder, bucket_rows=10)
    load(store, "t", spark.createDataFrame([(i, "a", "b") for i in range(10)], SCHEMA), ["k"], "id")
    assert store.current("t").n_buckets == 1
    load(store, "t", spark.createDataFrame([(i, "c", "d") for i in range(5, 100)], SCHEMA), ["k"], "id")
    assert store.current("t").n_buckets == 16
    assert stored(store, as_rows, "id", "k", "a") == sorted(
        ((i + 1, i, "a" if i < 5 else "c") for i in range(100)), key=lambda r: tuple(map(str, r)))


def test_second_writer_raises_and_loses_nothing(spark, folder, as_rows):
    first, second = Store(spark, folder), Store(spark, folder)
    load(first, "t", spark.createDataFrame([(1, "a", "b")], SCHEMA), ["k"], "id")
    assert second.current("t").number == 1
    load(first, "t", spark.createDataFrame([(2, "a", "b")], SCHEMA), ["k"], "id")
    late = spark.createDataFrame([(3, "a", "b"), (1, "z", "z")], SCHEMA)
    with pytest.raises(CommitConflict):
        load(second, "t", late, ["k"], "id")
    assert as_rows(Store(spark, folder).read("t"), "id", "k", "a") == [(1, 1, "a"), (2, 2, "a")]
    again = Store(spark, folder)
    load(again, "t", late, ["k"], "id")
    assert stored(again, as_rows, "id", "k", "a") == [(1, 1, "z"), (2, 2, "a"), (3, 3, "a")]
    empty = Store(spark, f"{folder}/e")
    assert empty.current("t") is None
    Store(spark, f"{folder}/e").commit("t", spark.range(1))
    with pytest.raises(CommitConflict):
        empty.publish("t", Version(1, 0, spark.range(1).schema.json()))


def test_a_batch_of_a_stream_is_taken_once(spark, folder, as_rows):
    store = Store(spark, folder)
    for number, value in ((0, "a"), (0, "again"), (1, "b"), (0, "late")):
        load(store, "t", spark.createDataFrame([(number, value, None)], SCHEMA), ["k"], "id", source=("s", number))
    assert stored(store, as_rows, "k", "a") == [(0, "a"), (1, "b")]
    load(store, "t", spark.createDataFrame([(7, "c", None)], SCHEMA), ["k"], "id", source=("other", 0))
    assert store.current("t").taken == {"s": 1, "other": 0} and store.current("t").number == 3


def test_null_keys_are_spread_over_buckets(spark, folder):
    store = Store(spark, folder, bucket_rows=10)
    rows = spark.createDataFrame([(None, str(i), "b") for i in range(200)] + [(1, "x", "y")], SCHEMA)
    rows.write.parquet(f"{folder}/rows")
    for n in (1, 2):
        load(store, "t", spark.read.parquet(f"{folder}/rows"), ["k"], "id")
        assert store.read("t").count() == 200 * n + 1 and len(files(store)) > 10
    assert sorted(r.id for r in store.read("t").collect()) == list(range(1, 402))


def test_unknown_column_is_refused(spark, folder):
    store = Store(spark, folder)
    load(store, "t", spark.createDataFrame([(1, "a", "b")], SCHEMA), ["k"])
    with pytest.raises(ValueError, match="extra"):
        load(store, "t", spark.createDataFrame([(1, "x")], "k int, extra string"), ["k"])


def test_target_is_not_shuffled_for_a_small_batch(spark, folder):
    spark.range(1000).select("id", F.lit("x").alias("a")).write.parquet(f"{folder}/t")
    batch = spark.createDataFrame([(1, "y")], "id long, a string")
    tagged = upsert._tagged(spark.read.parquet(f"{folder}/t").select("id"), batch, ["id"], 100, False)
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("LeftSemi") :].split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in scan


def test_store_without_versions(spark, folder):
    store = Store(spark, folder)
    assert store.current("none") is None
    with pytest.raises(LookupError):
        store.read("none")


def test_many_buckets_are_listed_in_few_tasks(spark, folder):
    store = Store(spark, folder, bucket_rows=10)
    load(store, "t", spark.range(2000).select(F.col("id").cast("int").alias("k")), ["k"])
    assert len(store.current("t").folders_of()) > 200
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        rows = store.read("t")
        tracker = spark.sparkContext.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
        assert stages and all(tracker.getStageInfo(s).numTasks <= 64 for s in stages)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert rows.count() == 2000
