"""Column profiling. Every check returns rows, so no result grows in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the date pattern, matched at the start of the text only.
DATE_PATTERN = r"^\b\d{4}-(0?[1-9]|1[0-2])-(0?[1-9]|[12][0-9]|3[01])\b"


def column_types(df: DataFrame) -> DataFrame:
    """(column_name, data_type)."""
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, data_type string")


def table_info(df: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_non_null, data_type), counted in one pass."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    tall = counts.unpivot(["_rows"], df.columns, "column_name", "n_non_null")
    types = F.create_map(*[F.lit(part) for pair in df.dtypes for part in pair])
    return tall.select(
        "column_name", F.col("_rows").alias("n_rows"), "n_non_null", types[F.col("column_name")].alias("data_type")
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column; a missing value is one of them."""
    return df.select(column).distinct()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n_rows) per non-missing value."""
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_rows"))


def rows_with(df: DataFrame, column: str, value) -> DataFrame:
    """The rows that hold `value`, or that miss one when `value` is None."""
    c = F.col(column)
    return df.filter(c.isNull() if value is None else c == F.lit(value))


def _percent(hits: Column) -> Column:
    """Percent of rows for which `hits` is true; NULL for an empty table."""
    return F.count_if(hits) / F.nullif(F.count("*"), F.lit(0)) * 100


def _is_date_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string").rlike(DATE_PATTERN), F.lit(False))


def _tall(df: DataFrame, columns: Sequence[str], value) -> DataFrame:
    return df.agg(*[value(c).alias(c) for c in columns]).unpivot([], list(columns), "column_name", "value")


def missing_percent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value): percent of rows without a value."""
    return _tall(df, columns, lambda c: _percent(F.col(c).isNull()))


def valid_date_percent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value): percent of rows that start with a date; a missing one does not."""
    return _tall(df, columns, lambda c: _percent(_is_date_text(c)))


def has_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value): whether any value is below zero."""
    return _tall(df, columns, lambda c: F.coalesce(F.bool_or(F.col(c) < 0), F.lit(False)))


def profile_report(
    df: DataFrame,
    types: Sequence[str] = (),
    unique: Sequence[str] = (),
    missing: Sequence[str] = (),
    dates: Sequence[str] = (),
) -> DataFrame:
    """(column_name, check, value, created_at) with only the checks asked for.

    Percentages come from one aggregate. Distinct values are one row each.
    """
    kinds = dict(df.dtypes)
    aggregates = {f"percentage_missing_value:{c}": F.round(_percent(F.col(c).isNull()), 2) for c in missing}
    aggregates |= {f"percentage_valid_date:{c}": F.round(_percent(_is_date_text(c)), 2) for c in dates}
    order = ["column_name", "check", "value"]
    parts = []
    if types:
        rows = [(c, "data_type", kinds[c]) for c in types]
        parts.append(df.sparkSession.createDataFrame(rows, "column_name string, check string, value string"))
    if aggregates:
        tall = df.agg(*[value.alias(name) for name, value in aggregates.items()]).unpivot(
            [], list(aggregates), "name", "value"
        )
        name = F.split("name", ":")
        parts.append(tall.select(name[1].alias("column_name"), name[0].alias("check"), F.col("value").cast("string")))
    if unique:
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in unique])
        values = df.select(F.inline(pairs)).distinct()
        parts.append(values.select("column_name", F.lit("unique_value").alias("check"), "value"))
    if not parts:
        raise ValueError("no check was asked for")
    result = parts[0].select(*order)
    for part in parts[1:]:
        result = result.unionByName(part.select(*order))
    return result.withColumn("created_at", F.current_date())


# Bits by which a sketch's registers are numbered: 4,096 registers, a relative standard error of about 1.04 / 64.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def column_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column_name, n_rows, n_missing, sketch): for each slice and column counts and a HyperLogLog sketch of its values.

    Slices are profiled when they land and merged later, so a profile of many days does not read their rows again. One
    row for each slice and column, of a few kilobytes.
    """
    counts = df.groupBy(*by).agg(
        *[F.struct(
            F.count("*").alias("n_rows"), F.count_if(F.col(c).isNull()).alias("n_missing"),
            F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS).alias("sketch"),
        ).alias(c) for c in columns]
    )
    tall = counts.unpivot(list(by), list(columns), "column_name", "found")
    return tall.select(*by, "column_name", "found.*")


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_missing, n_distinct, sketch) of all slices together; `n_distinct` is estimated.

    The estimate equals that of a sketch over all rows up to the rounding of merged registers, and lies within three
    times `SKETCH_ERROR` of the exact count with a chance of over 99 %.
    """
    merged = sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_missing").alias("n_missing"), F.hll_union_agg("sketch").alias("sketch")
    )
    return merged.select("column_name", "n_rows", "n_missing", F.hll_sketch_estimate("sketch").alias("n_distinct"), "sketch")


def exact_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_distinct) of non-missing values, counted from one scan and one shuffle of distinct values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(pairs)).distinct()
    return values.groupBy("column_name").agg(F.count("value").alias("n_distinct"))
