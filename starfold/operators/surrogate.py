"""Dense surrogate ids in key order, without a one-task window over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

# monotonically_increasing_id() is the partition number above this many bits, the row's place below.
_PLACE_BITS = 33


def assign_ids(rows: DataFrame, keys: Sequence[str], id_name: str, folder: str, after: int = 0) -> DataFrame:
    """`rows` with ids after+1, after+2, ... in the order of `keys`, NULLs first.

    The rows are range-partitioned, sorted inside each partition and written to
    `folder` with their partition and place; an id is the count of all earlier
    partitions plus the place. Reading the written files keeps the ids the same
    when a task is repeated. A hash of the row follows the keys in the sort, so
    rows without a key spread too.
    """
    spark = rows.sparkSession
    (
        rows.withColumn("_tie", F.xxhash64(*rows.columns))
        .repartitionByRange(*keys, "_tie")
        .sortWithinPartitions(*keys, "_tie")
        .withColumn("_place", F.monotonically_increasing_id())
        .drop("_tie")
        .write.mode("overwrite")
        .parquet(folder)
    )
    written = spark.read.parquet(folder).withColumn("_part", F.shiftright("_place", _PLACE_BITS))
    # One row per range partition: at most spark.sql.shuffle.partitions rows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        written.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    first = F.lit(after + 1).cast("bigint")
    return written.join(F.broadcast(offsets), "_part").select(
        (first + F.col("_offset") + place).alias(id_name), *rows.columns
    )
