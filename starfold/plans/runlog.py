"""The run log: one row per table and step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The statuses a step can end with.
SUCCESS, SKIP, FAILED = "success", "skip", "failed"
_SCHEMA = (
    "id string, step string, process string, status string, source string, table_name string, error_msg string, "
    "n_rejected long, etl_date timestamp, create_at timestamp"
)


class RunLog:
    """Log rows appended as files under one folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def add(
        self, step: str, process: str, status: str, source: str, table: str, error: str | None = None, n_rejected: int = 0
    ) -> None:
        if status not in (SUCCESS, SKIP, FAILED):
            raise ValueError(f"unknown status {status}")
        row = self.spark.range(0, 1, 1, 1).select(
            F.expr("uuid()").alias("id"),
            F.lit(step).alias("step"),
            F.lit(process).alias("process"),
            F.lit(status).alias("status"),
            F.lit(source).alias("source"),
            F.lit(table).alias("table_name"),
            F.lit(error).cast("string").alias("error_msg"),
            F.lit(n_rejected).cast("long").alias("n_rejected"),
            F.date_trunc("second", F.current_timestamp()).alias("etl_date"),
            F.current_timestamp().alias("create_at"),
        )
        row.write.mode("append").json(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(_SCHEMA).json(self.path)


def summary(log: DataFrame) -> DataFrame:
    """(step, process, status, n_runs, n_rejected); logs written before rejected rows were counted count none."""
    return log.groupBy("step", "process", "status").agg(
        F.count("*").alias("n_runs"), F.sum(F.coalesce("n_rejected", F.lit(0))).alias("n_rejected")
    )
