"""One row per key, distinct rows, append with de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the first by `order`, or by all other columns with NULLs first.

    `row_number() = 1` lets Spark keep one row per key on each task before the
    shuffle, so a key that holds most rows reaches its task as a few rows.
    """
    if order is None:
        order = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*(order or [F.lit(0)]))
    return df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")


def append_distinct(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name, without repeats."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()
