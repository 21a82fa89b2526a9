"""Left joins that hold up when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# A dimension side is an id (8 bytes) and a natural key of at most 255 characters
# (1,020 bytes; longer ones are not loaded), so this many rows stay near 256 MB.
BROADCAST_ROWS = 250_000
# A key with more rows than this is split into parts of about so many rows. There is
# less than one such key in a million rows; each is broadcast as a hash and a number
# (12 bytes), so the broadcast has less than 12 bytes for a million rows.
HOT_ROWS = 1_000_000
# Values of the hash by which rows are counted first; a task's counts take about a megabyte.
HASHES = 16_384


def hot_keys(rows: DataFrame, keys: Sequence[str], part_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than `part_rows` rows, and `_parts`, the parts to split each into.

    Rows are first counted by a hash of their key, of `HASHES` values, so that only keys of a hash with more than
    `part_rows` rows are counted themselves: no other can have so many.
    """
    keyed = rows.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(HASHES)).alias("_hash")).dropna(subset=list(keys))
    full = keyed.groupBy("_hash").count().filter(F.col("count") > part_rows).select("_hash")
    # At most `HASHES` rows.
    counts = keyed.join(F.broadcast(full), "_hash", "left_semi").groupBy(*keys).count().filter(F.col("count") > part_rows)
    return counts.select(*keys, F.ceil(F.col("count") / part_rows).cast("int").alias("_parts"))


def _with_parts(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """`_parts` for the rows of hot keys, 1 for others.

    Keys are compared by hash, to keep the broadcast small; a key that shares a hot
    key's hash is split as well, in the same way on both sides of the join.
    """
    by_hash = hot.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.max("_parts").alias("_parts"))
    return (
        df.withColumn("_hash", F.xxhash64(*keys))
        .join(F.broadcast(by_hash), "_hash", "left")
        .withColumn("_parts", F.coalesce("_parts", F.lit(1)))
        .drop("_hash")
    )


def salt_rows(rows: DataFrame, keys: Sequence[str], hot: DataFrame, spread: Column | None = None) -> DataFrame:
    """`_salt`: one of a hot key's parts, anything for a NULL key, 0 for other keys."""
    spread = F.monotonically_increasing_id() if spread is None else spread
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        _with_parts(rows, keys, hot)
        .withColumn("_salt", F.pmod(spread, F.when(any_null, F.lit(HOT_ROWS)).otherwise(F.col("_parts"))).cast("int"))
        .drop("_parts")
    )


def spread_left_join(
    rows: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    hot: DataFrame | None = None,
    spread: Column | None = None,
) -> DataFrame:
    """Left join; the rows of a hot key go to many tasks instead of one, as do rows with a NULL key.

    The matching rows of `side` are repeated once per part, for hot keys only; a
    NULL key matches nothing, so nothing is repeated for it. `hot` may come from
    a cheaper scan of the same keys. `spread` differs from row to row; by default
    it is the row's place in its input partition, which is stable for rows read
    from files. Give a hash of a unique column for rows that come out of a shuffle.
    """
    keys = list(keys)
    hot = hot_keys(rows, keys) if hot is None else hot
    kinds = [[df.schema[k].dataType for k in keys] for df in (rows, side, hot)]
    if not kinds[0] == kinds[1] == kinds[2]:
        raise TypeError(f"the types of {keys} differ: {kinds}")
    repeated = (
        _with_parts(side, keys, hot)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .drop("_parts")
    )
    return salt_rows(rows, keys, hot, spread).join(repeated, [*keys, "_salt"], "left").drop("_salt")


def lookup_id(
    rows: DataFrame,
    dimension: DataFrame,
    dimension_rows: int | None,
    nk: str,
    dimension_nk: str,
    dimension_id: str,
    as_id: str,
    hot: DataFrame | None = None,
    spread: Column | None = None,
) -> DataFrame:
    """Natural key `nk` replaced by the dimension's surrogate id, NULL where unmatched.

    The dimension is broadcast only when its counted rows are few enough.
    """
    side = dimension.select(F.col(dimension_nk).alias(nk), F.col(dimension_id).alias(as_id))
    if dimension_rows is not None and dimension_rows <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(side), nk, "left")
    else:
        joined = spread_left_join(rows, side, [nk], hot, spread)
    return joined.drop(nk)


def matching(
    rows: DataFrame, keys: DataFrame, spread: Column | None = None, flag: str = "matched"
) -> DataFrame:
    """`rows` with a column that is true where their key is in `keys`, NULL elsewhere."""
    present = keys.distinct().withColumn(flag, F.lit(True))
    return spread_left_join(rows, present, keys.columns, spread=spread)


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str], spread: Column | None = None) -> DataFrame:
    """The rows of `batch` whose key the target does not have. Give `spread` unless `batch` is read from files."""
    return matching(batch, target.select(*keys), spread).filter("matched is null").select(*batch.columns)
