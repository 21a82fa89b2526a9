"""The next row by an integer id, without one task that sees all rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

# Null ids come before all others.
NULL_KEY = -(1 << 63)


def id_blocks(ids: DataFrame, key: str) -> tuple[list[int], list[int | None]]:
    """Upper ends of ranges of ids, and the least id of each range (None if it is empty).

    Four ranges for each shuffle partition, of about as many ids each; only these numbers come to the driver.
    """
    n = 4 * int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*(F.lit(i / n) for i in range(1, n)))
    ends = ids.select(F.percentile_approx(key, shares, F.lit(20 * n)).alias("ends")).first()["ends"] or []
    bounds = sorted(set(ends))
    least = {r["block"]: r["least"] for r in ids.groupBy(block_of(F.col(key), bounds).alias("block"))
             .agg(F.min(key).alias("least")).collect()}
    return bounds, [least.get(i) for i in range(len(bounds) + 1)]


def block_of(key: Column, bounds: list[int]) -> Column:
    ends = np.array(bounds, np.int64)
    return F.pandas_udf(lambda s: pd.Series(np.searchsorted(ends, s.to_numpy(np.int64), side="left")), "int")(key)


def next_in_blocks(least: list[int | None]) -> list[int | None]:
    """For each block the least id after it, going round: after the last block comes the first id of all."""
    after, following = [None] * len(least), next((x for x in least if x is not None), None)
    for i in reversed(range(len(least))):
        after[i] = following
        following = least[i] if least[i] is not None else following
    return after


def successors(rows: DataFrame, key: str) -> DataFrame:
    """(key, next) for each distinct id of `rows`: the next larger one; after the largest the smallest. No null ids."""
    ids = rows.select(F.col(key).cast("long").alias("key")).filter("key is not null").distinct()
    bounds, least = id_blocks(ids, "key")
    after = pd.DataFrame({"block": range(len(least)), "after": pd.array(next_in_blocks(least), "Int64")})
    ends = rows.sparkSession.createDataFrame(
        [(int(b), None if pd.isna(a) else int(a)) for b, a in after.itertuples(index=False)], "block int, after long"
    )
    blocks = ids.withColumn("block", block_of(F.col("key"), bounds)).join(F.broadcast(ends), "block")
    following = F.lead("key").over(Window.partitionBy("block").orderBy("key"))
    return blocks.select("key", F.coalesce(following, "after").alias("next"))
