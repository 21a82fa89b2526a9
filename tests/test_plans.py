"""What reaches the file scans of the questions."""

from pyspark.sql import functions as F

from starfold.plans import analytics


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written(spark, folder, name, schema):
    spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")


ACQUISITIONS = (
    "acquisition_nk long, acquired_at int, price_amount decimal(15,2), term_code string, "
    "acquiring_company_id long, acquired_company_id long"
)


def test_date_filter_and_columns_reach_the_scan(spark, folder):
    sales = written(spark, folder, "a", ACQUISITIONS)
    ipos = written(spark, folder, "i", "ipo_nk long, public_at int, valuation_amount decimal(20,2), stock_symbol string")
    plan = physical(analytics.exit_comparison(sales, ipos))
    assert "Not(EqualTo(acquired_at,21000101))" in plan and "Not(EqualTo(public_at,21000101))" in plan
    assert "ReadSchema: struct<acquired_at:int,price_amount:decimal(15,2)>" in plan
    assert "term_code" not in plan and "stock_symbol" not in plan


def test_events_are_counted_before_they_are_shuffled(spark, folder):
    sales = written(spark, folder, "a", ACQUISITIONS)
    companies = written(spark, folder, "c", "company_id long, company_nk string, region string, description string")
    plan = physical(analytics.acquisition_rollup(sales, companies))
    below_the_shuffle = plan[plan.rindex("Exchange hashpartitioning(acquired_company_id") :]
    assert "partial_count" in below_the_shuffle and "description" not in plan


def test_the_calendar_is_broadcast(spark, folder):
    sales = written(spark, folder, "a", ACQUISITIONS)
    ipos = written(spark, folder, "i", "ipo_nk long, public_at int, valuation_amount decimal(20,2)")
    days = spark.range(3).select(
        F.col("id").cast("int").alias("date_id"),
        *[F.current_date().alias(f"first_day_of_{p}") for p in ("week", "month", "quarter", "year")],
    )
    plan = physical(analytics.exit_trend(sales, ipos, days))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
