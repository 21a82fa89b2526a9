import pytest
from pyspark.sql import functions as F

from starfold.operators import profiling, quality
from starfold.operators.profiling import SKETCH_ERROR, column_sketches, exact_distinct, merged_sketches
from starfold.operators.quality import rule_violations

ROWS = [(1, "a", 20100101), (2, None, 21000101), (None, None, 21000101), (4, "d", None)]
SCHEMA = "k int, v string, d int"


def test_missing_summary_and_detail(spark, as_rows):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert as_rows(quality.missing_summary(df, ["k"], ["d"])) == [("d", 2), ("v", 2)]
    # A NULL is not the unknown date, and rows without a key are not listed.
    assert as_rows(quality.missing_detail(df, ["k"], ["d"])) == [("d", 2), ("v", 2)]
    assert as_rows(quality.missing_summary(df, ["k"])) == [("d", 1), ("v", 2)]


def test_missing_summary_scans_once(spark, folder):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    plan = quality.missing_summary(df, ["k"], ["d"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_missing_report_lists_every_key_in_bounded_lists(spark, folder):
    n = 20_000
    spark.range(0, n, 1, 1).select("id", F.lit(None).cast("string").alias("v"), F.lit("x").alias("full")).write.parquet(
        f"{folder}/t"
    )
    report = quality.missing_report(spark.read.parquet(f"{folder}/t"), "t", ["id"]).collect()
    listed = [r for r in report if r.column_name == "v"]
    assert {r.num_missing for r in listed} == {n}
    assert max(len(r.missing_rows) for r in listed) <= 8192
    assert sorted(k.id for r in listed for k in r.missing_rows) == list(range(n))
    (full,) = [r for r in report if r.column_name == "full"]
    assert full.num_missing == 0 and full.missing_rows is None


def test_constraint_violations(spark, as_rows):
    df = spark.createDataFrame([("a", "1"), ("a", "x"), (None, "12345678901"), ("bcd", None)], "k string, n string")
    found = quality.constraint_violations(df, ["k"], [["k"], ["k", "n"]], {"k": 2}, {"n": (10, 0)})
    assert as_rows(found, "rule", "column_name", "violations") == [
        ("fits_decimal", "n", 2), ("max_length", "k", 1), ("not_null", "k", 1), ("unique", "k", 1), ("unique", "k,n", 0)
    ]


def test_broken_references(spark, as_rows):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (3,)], "c int")
    dim = spark.createDataFrame([(1,), (3,)], "id long")
    for rows in (2, None, 10**9):
        assert as_rows(quality.broken_references(df, "c", dim, "id", rows)) == [("c", 2, 2)]


def test_valid_date_percent_is_anchored_at_the_start(spark, as_rows):
    values = ["2010-01-02", "2010-1-2 rest", " 2010-01-02", "2010-13-01", "2010-01-32", None, "2010-01-021", "x2010-01-02"]
    df = spark.createDataFrame([(v,) for v in values], "d string")
    assert as_rows(profiling.valid_date_percent(df, ["d"])) == [("d", 25.0)]


def test_percentages_of_an_empty_table(spark, as_rows):
    df = spark.createDataFrame([], "a int, b string")
    assert as_rows(profiling.missing_percent(df, ["a", "b"])) == [("a", None), ("b", None)]
    assert as_rows(profiling.has_negative(df, ["a"])) == [("a", False)]


def test_types_info_counts_and_lookups(spark, as_rows):
    df = spark.createDataFrame([(1, "a"), (-2, None), (1, "a")], "n int, s string")
    assert as_rows(profiling.column_types(df)) == [("n", "int"), ("s", "string")]
    assert as_rows(profiling.table_info(df)) == [("n", 3, 3, "int"), ("s", 3, 2, "string")]
    assert as_rows(profiling.distinct_values(df, "s")) == [(None,), ("a",)]
    assert as_rows(profiling.value_counts(df, "n")) == [(-2, 1), (1, 2)]
    assert as_rows(profiling.has_negative(df, ["n"])) == [("n", True)]
    assert as_rows(profiling.rows_with(df, "s", None)) == [(-2, None)]
    assert profiling.rows_with(df, "n", 1).count() == 2


def test_report_has_only_the_checks_asked_for(spark, as_rows):
    df = spark.createDataFrame([("2010-01-01", "a"), (None, "a"), ("bad", None)], "d string, s string")
    report = profiling.profile_report(df, types=["s"], unique=["s"], missing=["d"], dates=["d"])
    assert as_rows(report, "column_name", "check", "value") == [
        ("d", "percentage_missing_value", "33.33"),
        ("d", "percentage_valid_date", "33.33"),
        ("s", "data_type", "string"),
        ("s", "unique_value", None),
        ("s", "unique_value", "a"),
    ]
    with pytest.raises(ValueError):
        profiling.profile_report(df)


def test_rules_in_one_scan(spark, as_rows):
    rows = spark.createDataFrame(
        [(1, "a", None), (1, "a", "xx"), (2, "bbb", "y"), (None, "a", "y"), (None, None, "y")], "k int, a string, b string")
    found = rule_violations(rows, ["k", "b"], [["k"], ["k", "a"], ["b"], ["a", "b"]], {"a": 2, "b": 2})
    assert as_rows(found) == [
        ("max_length", "a", 1), ("max_length", "b", 0), ("not_null", "b", 1), ("not_null", "k", 2),
        ("unique", "a,b", 0), ("unique", "b", 2), ("unique", "k", 1), ("unique", "k,a", 1),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") == 2
    assert {r.violations for r in rule_violations(rows.filter("false"), ["k"], [["a"]]).collect()} == {0}


def test_sketches_of_slices_merge(spark):
    rows = spark.range(20_000).selectExpr("id % 7 ds", "id a", "id % 50 b", "if(id % 4 = 0, null, id % 3000) c")
    sliced = merged_sketches(column_sketches(rows, ["a", "b", "c"], ["ds"])).collect()
    whole = {r.column_name: r for r in merged_sketches(column_sketches(rows, ["a", "b", "c"])).collect()}
    exact = {r.column_name: r.n_distinct for r in exact_distinct(rows, ["a", "b", "c"]).collect()}
    assert len(sliced) == 3 and exact == {"a": 20_000, "b": 50, "c": 2250}
    for row in sliced:
        assert row.n_rows == 20_000 and row.n_missing == whole[row.column_name].n_missing == (5000 if row.column_name == "c" else 0)
        for found in (row, whole[row.column_name]):
            assert abs(found.n_distinct - exact[row.column_name]) <= 3 * SKETCH_ERROR * exact[row.column_name] + 1
