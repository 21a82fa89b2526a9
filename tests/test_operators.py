import random

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from starfold.checks.oracles import _CTES
from starfold.operators.calendar import calendar
from starfold.operators.dedup import append_distinct, keep_first
from starfold.operators.lookup import hot_keys, insert_if_absent, lookup_id, salt_rows, spread_left_join
from starfold.operators.surrogate import assign_ids


def test_calendar_whole_range(spark):
    con = connect("/root/testdata/sf0.001")
    sql = f"with days as ({_CTES['days']}) {_CTES['dim_date']}"
    assert differences(calendar(spark), con, sql) is None
    assert calendar(spark).count() == 73414


def test_calendar_padded_names(spark):
    row = calendar(spark, "2010-05-03", "2010-05-03", padded=True).first()
    assert row.day_name == "Monday   " and row.month_name == "May      "


def test_keep_first_is_the_smallest_row(spark, as_rows):
    rng = random.Random(7)
    data = [(rng.choice(["a", "b", None, "c"]), rng.choice([None, 1, 2]), rng.choice([None, "x", "y"])) for _ in range(200)]
    expected = [
        min((r for r in data if r[0] == k), key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r[1:]))
        for k in {r[0] for r in data}
    ]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    for parts in (1, 7):
        df = spark.createDataFrame(data, "k string, a int, b string").repartition(parts)
        assert as_rows(keep_first(df, ["k"])) == sorted(expected, key=key)


def test_keep_first_reduces_a_hot_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_append_distinct_by_name(spark, as_rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "n int, s string")
    b = spark.createDataFrame([("x", 1), (None, 2), ("z", 3)], "s string, n int")
    assert as_rows(append_distinct(a, b)) == [(1, "x"), (2, None), (3, "z")]


def skewed(spark):
    """A third of the rows share a key, a third have none, and every row occurs twice."""
    n = 3000
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 50)
    return spark.range(n).select(key.cast("long").alias("k"), (F.col("id") % (n // 2)).alias("v"))


def test_spread_join_on_two_keys(spark, as_rows):
    left = skewed(spark).withColumn("j", F.col("v") % 2)
    right = spark.range(80).select((F.col("id") % 40).alias("k"), (F.col("id") % 2).alias("j"), F.col("id").alias("w"))
    expected = as_rows(left.join(right, ["k", "j"], "left"), "k", "j", "v", "w")
    hot = hot_keys(left, ["k", "j"], 10)
    assert as_rows(spread_left_join(left, right, ["k", "j"], hot), "k", "j", "v", "w") == expected


@pytest.mark.parametrize("part_rows", [1, 500, 10**9])
def test_spread_join_equals_plain_join(spark, as_rows, part_rows):
    left = skewed(spark)
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    expected = as_rows(left.join(right, "k", "left"), "k", "v", "w")
    hot = hot_keys(left, ["k"], part_rows)
    assert as_rows(spread_left_join(left, right, ["k"], hot), "k", "v", "w") == expected
    doubled = right.union(right)
    assert as_rows(spread_left_join(left, doubled, ["k"], hot), "k", "v", "w") == as_rows(
        left.join(doubled, "k", "left"), "k", "v", "w"
    )


def test_hot_and_missing_keys_are_split(spark):
    left = skewed(spark)
    salted = salt_rows(left, ["k"], hot_keys(left, ["k"], 100))
    largest = {r.k: r.n for r in salted.groupBy("k", "_salt").count().groupBy("k").agg(F.max("count").alias("n")).collect()}
    assert largest[1] <= 120 and largest[None] == 1
    assert salted.filter("k > 1 and _salt > 0").count() == 0


def test_spread_join_refuses_keys_of_different_types(spark):
    right = spark.range(3).select(F.col("id").cast("int").alias("k"))
    with pytest.raises(TypeError):
        spread_left_join(skewed(spark), right, ["k"])


def test_hot_keys_finds_the_frequent_key_only(spark):
    assert [r.k for r in hot_keys(skewed(spark), ["k"], 500).collect()] == [1]


def test_lookup_same_with_and_without_broadcast(spark, as_rows):
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(["a", "b", None, "zz", "a"])], "i int, nk string")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "company_id long, company_nk string")
    found = [
        as_rows(lookup_id(rows, dim, n, "nk", "company_nk", "company_id", "c"), "i", "c") for n in (2, None, 10**9)
    ]
    assert found[0] == found[1] == found[2] == [(0, 1), (1, 2), (2, None), (3, None), (4, 1)]


def test_insert_if_absent(spark, as_rows):
    target = spark.createDataFrame([(1,), (None,)], "k int")
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    assert as_rows(insert_if_absent(target, batch, ["k"])) == [(None, "c"), (2, "b")]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_ids_are_dense_in_key_order(spark, folder, parts):
    keys = [f"k{i}" for i in range(500)]
    shuffled = random.Random(parts).sample(keys, len(keys))
    df = spark.createDataFrame([(k,) for k in shuffled], "nk string").repartition(parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.nk: r.id for r in assign_ids(df, ["nk"], "id", f"{folder}/ids", after=10).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {k: 11 + i for i, k in enumerate(sorted(keys))}


def test_ids_without_keys_are_dense_too(spark, folder):
    df = spark.range(100).select(F.lit(None).cast("string").alias("nk"), F.col("id").alias("v"))
    ids = sorted(r.id for r in assign_ids(df, ["nk"], "id", f"{folder}/ids").collect())
    assert ids == list(range(1, 101))
    assert assign_ids(df.limit(0), ["nk"], "id", f"{folder}/none").count() == 0
