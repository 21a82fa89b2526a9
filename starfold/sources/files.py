"""Text, columnar and JSON files, and daily slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Every value is quoted, quotes are doubled, and a NULL has its own text, so that
# empty strings, blanks at the ends, quotes and newlines come back as they were.
_CSV = {
    "sep": ";",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# The column that slices are named by.
DAY = "ds"
# A file with newlines inside values cannot be split, so files are kept small.
CSV_ROWS_PER_FILE = 1_000_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """`;`-separated text with a header. The text `\\N` is reserved for NULL."""
    options = dict(_CSV, quoteAll="true", maxRecordsPerFile=str(CSV_ROWS_PER_FILE))
    df.write.mode(mode).options(**options).csv(path)


def read_csv(spark: SparkSession, path: str, columns: list[str], newlines: bool = True) -> DataFrame:
    """Staged text files as strings, with declared columns.

    A file whose values may hold newlines is read by one task. Without `newlines` large files are split.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).options(**_CSV, multiLine=str(newlines).lower()).csv(path)


def write_slice(df: DataFrame, path: str, ds: str) -> None:
    """The rows of one day as `ds=<day>`; a second write of the day replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/ds={ds}")


def write_slices(df: DataFrame, path: str, ds: Column) -> None:
    """All days of `df`; days that are not in it stay as they are.

    The rebalance hint groups rows by day, splits a day that is too large for one
    task and joins small ones, so files come out near the advisory size.
    """
    (
        df.withColumn("ds", ds)
        .hint("rebalance", "ds")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ds")
        .parquet(path)
    )


def read_slices(spark: SparkSession, path: str, schema: T.StructType, other: Sequence[T.StructField] = ()) -> DataFrame:
    """All days of slices of rows of `schema`, with the day as a date; `other` are partition columns beside it.

    A filter on the day leaves out the files of other days.
    """
    partitions = [*other, T.StructField(DAY, T.DateType())]
    fields = [f for f in schema.fields if f.name not in {p.name for p in partitions}]
    return spark.read.schema(T.StructType([*fields, *partitions])).parquet(path)


def read_slice(spark: SparkSession, path: str, ds: str) -> DataFrame | None:
    """One day's rows, or None when that day was never written."""
    return read_or_none(spark, f"{path}/ds={ds}")


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet path, or None when it does not exist; any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def created_on_day_before(df: DataFrame, created_at: str, run_date: str) -> Column:
    """Whether a row was created on the day before `run_date`, as a half-open range.

    Works for timestamps and for ISO text; both forms reach the file scan. Rows landed by day are taken by their slice,
    so files of other days are not opened.
    """
    run = F.to_date(F.lit(run_date))
    if DAY in df.columns:
        return F.col(DAY) == F.date_sub(run, 1)
    column = F.col(created_at)
    if isinstance(df.schema[created_at].dataType, T.StringType):
        low, high = F.date_sub(run, 1).cast("string"), run.cast("string")
    else:
        low, high = F.date_sub(run, 1), run
    return (column >= low) & (column < high)


def day_before(df: DataFrame, created_at: str, run_date: str) -> DataFrame:
    """Rows created on the day before `run_date`."""
    return df.filter(created_on_day_before(df, created_at, run_date))


def write_json(df: DataFrame, path: str) -> None:
    # Reports repeat names and keys, which takes a tenth of the space when packed.
    df.write.mode("overwrite").option("ignoreNullFields", "false").option("compression", "gzip").json(path)
