"""The calendar dimension, one row per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The range of the calendar.
FIRST_DAY = "1900-01-01"
LAST_DAY = "2100-12-31"


def _ordinal(day: Column) -> Column:
    suffix = (
        F.when(day.between(11, 13), "th")
        .when(day % 10 == 1, "st")
        .when(day % 10 == 2, "nd")
        .when(day % 10 == 3, "rd")
        .otherwise("th")
    )
    return F.concat(day.cast("string"), suffix)


def calendar(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY, padded: bool = False) -> DataFrame:
    """All 25 calendar columns. `padded` fills day and month names to nine characters."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("d")
    )
    d = F.col("d")
    day = F.dayofmonth(d)
    quarter = F.quarter(d)
    week_start = F.trunc(d, "week")
    month_start = F.trunc(d, "month")
    quarter_start = F.trunc(d, "quarter")
    year_start = F.trunc(d, "year")

    def name(pattern: str) -> Column:
        text = F.date_format(d, pattern)
        return F.rpad(text, 9, " ") if padded else text

    return days.select(
        (F.year(d) * 10000 + F.month(d) * 100 + day).alias("date_id"),
        d.alias("date_actual"),
        _ordinal(day).alias("day_suffix"),
        name("EEEE").alias("day_name"),
        F.dayofyear(d).alias("day_of_year"),
        F.ceil(day / 7).cast("int").alias("week_of_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.concat_ws(
            "-",
            F.extract(F.lit("YEAROFWEEK"), d).cast("string"),
            F.lpad(F.weekofyear(d).cast("string"), 2, "0"),
        ).alias("week_of_year_iso"),
        F.month(d).alias("month_actual"),
        name("MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_abbreviated"),
        quarter.alias("quarter_actual"),
        F.element_at(F.array(*map(F.lit, ("First", "Second", "Third", "Fourth"))), quarter).alias("quarter_name"),
        F.year(d).alias("year_actual"),
        week_start.alias("first_day_of_week"),
        F.date_add(week_start, 6).alias("last_day_of_week"),
        month_start.alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        quarter_start.alias("first_day_of_quarter"),
        F.date_sub(F.add_months(quarter_start, 3), 1).alias("last_day_of_quarter"),
        year_start.alias("first_day_of_year"),
        F.date_sub(F.add_months(year_start, 12), 1).alias("last_day_of_year"),
        F.date_format(d, "MMyyyy").alias("mmyyyy"),
        F.date_format(d, "MM/dd/yyyy").alias("mmddyyyy"),
        F.when(F.weekday(d) >= 5, "Weekend").otherwise("Weekday").alias("weekend_indr"),
    )
