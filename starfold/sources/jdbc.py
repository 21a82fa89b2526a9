"""Options for reading and writing database tables in parallel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How a table is read by several tasks: a numeric, date or timestamp column and its range.

    Rows outside the range are still read; the range only sets the stride.
    """

    column: str
    low: str
    high: str
    partitions: int


def _connection(url: str, properties: dict[str, str]) -> dict[str, str]:
    return {"url": url, **properties}


def read_options(
    url: str,
    properties: dict[str, str],
    table: str | None = None,
    query: str | None = None,
    split: Split | None = None,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of the `jdbc` source for a whole table or a query, split when asked."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = _connection(url, properties) | {"fetchsize": str(fetch_rows)}
    if split is None:
        return options | ({"dbtable": table} if table else {"query": query})
    # `query` cannot be combined with a partition column, a subquery can.
    return options | {
        "dbtable": table or f"({query}) rows_to_read",
        "partitionColumn": split.column,
        "lowerBound": split.low,
        "upperBound": split.high,
        "numPartitions": str(split.partitions),
    }


def read_table(spark: SparkSession, url: str, properties: dict[str, str], **what) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, properties, **what)).load()


def list_tables(spark: SparkSession, url: str, properties: dict[str, str], schema: str = "public") -> DataFrame:
    """Table names of a database schema, from its information schema."""
    name = schema.replace("'", "''")
    query = f"select table_name from information_schema.tables where table_schema = '{name}'"
    return read_table(spark, url, properties, query=query)


def write_options(
    url: str, properties: dict[str, str], table: str, batch_rows: int = 10_000, keep_definition: bool = False
) -> dict[str, str]:
    """Options for an append or overwrite; `keep_definition` empties a table rather than dropping it."""
    options = _connection(url, properties) | {"dbtable": table, "batchsize": str(batch_rows)}
    return options | ({"truncate": "true"} if keep_definition else {})


def append_table(df: DataFrame, url: str, properties: dict[str, str], table: str, **how) -> None:
    df.write.format("jdbc").options(**write_options(url, properties, table, **how)).mode("append").save()


def overwrite_table(df: DataFrame, url: str, properties: dict[str, str], table: str, **how) -> None:
    options = write_options(url, properties, table, **{"keep_definition": True, **how})
    df.write.format("jdbc").options(**options).mode("overwrite").save()
