"""Pages of a record API: landed JSON files, and date windows read one per task."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from starfold.functions.text import null_tokens, repair_frame

# The fields of a milestone record.
MILESTONE_FIELDS = (
    "created_at",
    "description",
    "milestone_at",
    "milestone_code",
    "milestone_id",
    "object_id",
    "source_description",
    "source_url",
    "updated_at",
)
MILESTONE_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in MILESTONE_FIELDS])


def clean_page(df: DataFrame) -> DataFrame:
    """Repaired text, then NULL for the tokens that mean missing."""
    return null_tokens(repair_frame(df))


def read_pages(spark: SparkSession, path: str, schema: T.StructType = MILESTONE_SCHEMA, whole_lists: bool = True) -> DataFrame:
    """Landed pages with a declared schema, so that an empty folder is an empty table.

    `whole_lists` is for files that each hold one JSON list; such a file is read by
    one task, so land one page per file. Use False for one record per line.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return clean_page(reader.json(path, multiLine=whole_lists))


def backfill_windows(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Half-open windows of one year that cover [first, last] of a one-row frame; the last may be shorter."""
    starts = F.sequence(F.col(first), F.col(last), F.expr("interval 1 year"))
    end = F.date_add(F.col(last), 1)
    return (
        bounds.select(starts.alias("starts"), end.alias("end"))
        .select("starts", "end", F.posexplode("starts").alias("window_no", "start_date"))
        .select("window_no", "start_date", F.coalesce(F.get("starts", F.col("window_no") + 1), "end").alias("end_date"))
    )


def in_windows(records: DataFrame, day: Column, windows: DataFrame) -> DataFrame:
    """Records with the columns of the window (`start_date` to before `end_date`) that their day lies in, once for each.

    Both sides meet by month: a window stands under each month that it touches, a record under its own. So the join is
    on equal months, however long the range of dates is, and the dates decide within a month. Others are left out.
    """
    month = lambda c: F.trunc(c, "month")
    last = F.date_sub("end_date", 1)
    months = windows.withColumn("_month", F.explode(F.sequence(month(F.col("start_date")), month(last), F.expr("interval 1 month"))))
    dated = records.withColumn("_day", day).withColumn("_month", month(F.col("_day")))
    within = (F.col("_day") >= F.col("start_date")) & (F.col("_day") < F.col("end_date"))
    return dated.join(months, "_month").filter(within).drop("_month", "_day")


class _Window(InputPartition):
    def __init__(self, start_date: str, end_date: str) -> None:
        self.start_date = start_date
        self.end_date = end_date


class _WindowReader(DataSourceReader):
    def __init__(self, schema, windows, fetch) -> None:
        self.fields = schema.fieldNames()
        self.windows = windows
        self.fetch = fetch

    def partitions(self):
        return [_Window(start, end) for start, end in self.windows]

    def read(self, partition) -> Iterator[tuple]:
        for record in self.fetch(partition.start_date, partition.end_date):
            values = (record.get(field) for field in self.fields)
            yield tuple(None if value is None else str(value) for value in values)


def read_windows(
    spark: SparkSession,
    windows: list[tuple[str, str]],
    fetch: Callable[[str, str], Iterator[Mapping]],
    schema: T.StructType = MILESTONE_SCHEMA,
) -> DataFrame:
    """Records that `fetch(start, end)` yields, one task per window, without repeats.

    Every field is text. The list of windows is short: years of a date range.
    """

    record_schema = schema

    class Windows(DataSource):
        @classmethod
        def name(cls) -> str:
            return "starfold_windows"

        def schema(self):
            return record_schema

        def reader(self, schema):
            return _WindowReader(schema, windows, fetch)

    spark.dataSource.register(Windows)
    return clean_page(spark.read.format("starfold_windows").load()).distinct()
