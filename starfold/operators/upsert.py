"""Insert-or-update of a batch into a versioned table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starfold.operators.dedup import keep_first
from starfold.operators.surrogate import assign_ids
from starfold.session import empty_folder, new_folder
from starfold.sources.files import DAY, read_slices
from starfold.sources.store import BUCKET, Store, Version, bucket_of, buckets_for, merged_parts


# Keys of a batch are sent to every task only while all of them together are below this size.
BROADCAST_BYTES = 256 * 1024 * 1024
# ... and while the target has at least this many rows per batch row; a smaller one is cheap to shuffle.
BROADCAST_RATIO = 10
# A bucket that lies in so many folders is written anew when the next rows come.
MOST_FOLDERS = 8
# A table is dealt to more buckets when they hold so many times the rows that they are meant to.
OUTGROWN = 4
# Bytes a key takes in a broadcast table besides its text.
_KEY_OVERHEAD = 64


# Which of the landed rows have a key.
KEYED = "_keyed"


class DuplicateKeys(ValueError):
    """A batch holds the same key more than once."""


def _has_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def duplicate_keys(batch: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Keys that occur more than once, with their row count. NULL equals nothing unless `null_safe`."""
    rows = batch if null_safe else batch.filter(~_has_null(keys))
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def _checked_size(batch: DataFrame, keys: Sequence[str], null_safe: bool) -> tuple[int, int]:
    """(rows of the batch, upper bound of the bytes of all its keys); raises when a key is repeated."""
    unkeyed = F.lit(False) if null_safe else _has_null(keys)
    per_key = batch.withColumn("_unkeyed", unkeyed).groupBy(*keys, "_unkeyed").agg(F.count("*").alias("n"))
    width = reduce(
        lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys]
    )
    found = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.max(width), F.lit(0)).alias("widest"),
        F.count_if((F.col("n") > 1) & ~F.col("_unkeyed")).alias("n_repeated"),
    ).first()
    if found.n_repeated:
        sample = [tuple(row) for row in duplicate_keys(batch, keys, null_safe).limit(5).collect()]
        raise DuplicateKeys(f"{found.n_repeated} keys are repeated, among them {sample}")
    return found.n_rows, found.n_rows * (found.widest + _KEY_OVERHEAD)


def _on(left: str, right: str, keys: Sequence[str], null_safe: bool) -> Column:
    def same(k: str) -> Column:
        a, b = F.col(f"{left}.{k}"), F.col(f"{right}.{k}")
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(lambda a, b: a & b, [same(k) for k in keys])


def _update(target: DataFrame, batch: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Target rows with every non-key column of a matching batch row, NULLs included."""
    changes = batch.withColumn("_found", F.lit(True)).alias("b")
    joined = target.alias("t").join(changes, _on("t", "b", keys, null_safe), "left")
    return joined.select(
        *[
            F.when(F.col("b._found"), F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            if c in batch.columns and c not in keys
            else F.col(f"t.{c}")
            for c in target.columns
        ]
    )


def _tagged(
    target_keys: DataFrame, batch: DataFrame, keys: Sequence[str], key_bytes: int | None, null_safe: bool
) -> DataFrame:
    """`batch` with `_found`: whether the target has the row's key.

    Keys of a batch of a known, small size are sent to the tasks that scan the target's keys, which are then not
    shuffled; otherwise both sides are shuffled on the key.
    """
    if key_bytes is not None and key_bytes <= BROADCAST_BYTES:
        wanted = batch if null_safe else batch.filter(~_has_null(keys))
        wanted = F.broadcast(wanted.select(*keys)).alias("k")
        target_keys = target_keys.alias("t").join(wanted, _on("t", "k", keys, null_safe), "left_semi")
    present = target_keys.withColumn("_found", F.lit(True)).alias("t")
    joined = batch.alias("b").join(present, _on("b", "t", keys, null_safe), "left")
    return joined.select("b.*", F.coalesce("t._found", F.lit(False)).alias("_found"))


def load(
    store: Store,
    table: str,
    batch: DataFrame,
    keys: Sequence[str],
    surrogate: str | None = None,
    null_safe: bool = False,
    stamped: bool = True,
    source: tuple[str, int] | None = None,
) -> Version:
    """Upsert `batch` and make the result the table's current version.

    New rows get the next surrogate ids in key order and, when `stamped`, their
    load time; both stay as they are when the row is updated later. The batch is
    scanned more than once, so pass one that is read from files.

    Only buckets that the batch's keys fall into are read, and of these only the keys unless a row of the bucket changes.
    A bucket with a changed row is written anew; one that only gains rows keeps its files and gains a folder, until it
    lies in `MOST_FOLDERS`. All other files are taken over as they are. A table that has no buckets by these keys yet, or
    has outgrown them, is written whole once.

    `source` is a stream's name and its batch number: a batch that the table has taken already changes nothing.
    """
    keys = list(keys)
    before = store.current(table)
    if source and before and before.taken.get(source[0], -1) >= source[1]:
        return before
    n_rows, key_bytes = _checked_size(batch, keys, null_safe)
    if before is not None and (unknown := set(batch.columns) - set(before.columns.names)):
        raise ValueError(f"{table} has no columns {sorted(unknown)}")
    scratch = [new_folder(batch.sparkSession, f"{label}-{table}") for label in ("tagged", "new")]
    used = []
    try:
        return _load(store, table, before, batch, keys, surrogate, null_safe, stamped, source, n_rows, key_bytes, scratch, used)
    finally:
        for folder in used:
            empty_folder(batch.sparkSession, folder)


def _load(store, table, before, batch, keys, surrogate, null_safe, stamped, source, n_rows, key_bytes, scratch, used) -> Version:
    spark, (tagged_folder, new_rows) = batch.sparkSession, scratch
    after = n_rows + (0 if before is None else before.rows)
    fits = before is not None and before.keys == keys and after <= OUTGROWN * store.bucket_rows * before.n_buckets
    n_buckets = before.n_buckets if fits else buckets_for(after, store.bucket_rows)
    bucket = bucket_of(batch, keys, n_buckets, null_safe)
    placed = batch.withColumn(BUCKET, F.lit(0) if bucket is None else bucket)
    if before is None:
        fresh, n_new, replaced, kept_part = batch, n_rows, [], {}
    else:
        types = {f.name: f.dataType for f in before.columns}
        placed = placed.select(*[F.col(c).cast(types[c]).alias(c) for c in batch.columns], BUCKET)
        touched = [r[0] for r in placed.select(BUCKET).distinct().collect()] if fits else None
        small = key_bytes if before.rows >= BROADCAST_RATIO * n_rows else None
        target_keys = store.read(table, touched).select(*keys)
        used.append(tagged_folder)
        _tagged(target_keys, placed, keys, small, null_safe).write.parquet(tagged_folder)
        tagged = spark.read.parquet(tagged_folder)
        # One row for each bucket of the batch.
        per_bucket = tagged.groupBy(BUCKET).agg(F.count_if("_found").alias("found"), F.count("*").alias("n")).collect()
        n_new = sum(r.n - r.found for r in per_bucket)
        if fits:
            lies_in = before.folders_of()
            replaced = [r[BUCKET] for r in per_bucket if r.found or lies_in.get(r[BUCKET], 0) >= MOST_FOLDERS]
        else:
            replaced = [b for held in before.parts.values() for b in held]
        kept_part = {}
        if replaced:
            changes = tagged.filter("_found").drop("_found", BUCKET)
            kept = _update(store.read(table, replaced), changes, keys, null_safe)
            kept_part = store.write_part(table, kept, bucket_of(kept, keys, n_buckets, null_safe))
        fresh = tagged.filter("not _found").drop("_found", BUCKET)
    last_id = _last_id(store, table, before, surrogate)
    if surrogate and (n_new or before is None):
        used.append(new_rows)
        fresh = assign_ids(fresh, keys, surrogate, new_rows, last_id)
    if stamped:
        fresh = fresh.withColumn("created_at", F.current_timestamp())
    new_part = {}
    if n_new or before is None:
        new_part = store.write_part(table, fresh, bucket_of(fresh.select(*batch.columns), keys, n_buckets, null_safe))
    taken = {} if before is None else before.taken
    version = Version(
        number=1 if before is None else before.number + 1,
        rows=n_new + (0 if before is None else before.rows),
        schema=fresh.schema.json() if before is None else before.schema,
        keys=keys,
        n_buckets=n_buckets,
        parts=new_part if before is None else merged_parts(before, replaced, kept_part, new_part),
        last_id=last_id + n_new if surrogate else None,
        taken=taken if source is None else {**taken, source[0]: source[1]},
    )
    return store.publish(table, version)


def _last_id(store: Store, table: str, before: Version | None, surrogate: str | None) -> int:
    if before is None or surrogate is None:
        return 0
    return before.last_id if before.last_id is not None else store.read(table).agg(F.max(surrogate)).first()[0] or 0


def load_extracted(
    staging: Store, table: str, rows: DataFrame, key: str, path: str, source: tuple[str, int] | None = None,
    day: str | None = None,
) -> tuple[bool, int]:
    """Write the first row of each key to `path` and upsert from there.

    Rows with a `created_at` text are landed by its day. With `day`, the run's only one, slices of other days stay as
    they are; else `path` is replaced. Rows without a key are all written, beside the others, and not loaded. Returns
    whether there was a row to load, and the number of rows without a key. The rows are read and shuffled once, or not
    at all if `source` has been taken.
    """
    if source and (taken := staging.current(table)) and taken.taken.get(source[0], -1) >= source[1]:
        return False, 0
    # Each row without a key is a group of its own, so none is folded into another and they spread over the tasks.
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id()).alias("_alone")
    firsts = keep_first(rows.select("*", alone), [key, "_alone"]).drop("_alone")
    created = F.substring("created_at", 1, 10).try_cast("date") if "created_at" in rows.columns else F.lit(None).cast("date")
    landed = firsts.withColumns({KEYED: F.col(key).isNotNull().cast("int"), DAY: F.lit(day).cast("date") if day else created})
    mode = "dynamic" if day else "static"
    landed.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(KEYED, DAY).parquet(path)
    written = landed_rows(rows.sparkSession, path, firsts.schema)
    if day:
        written = written.filter(F.col(DAY) == F.lit(day).cast("date"))
    n_unkeyed = written.filter(f"{KEYED} = 0").count()
    batch = written.filter(f"{KEYED} = 1").drop(KEYED, DAY)
    if batch.isEmpty():
        return False, n_unkeyed
    load(staging, table, batch, [key], stamped=False, source=source)
    return True, n_unkeyed


def landed_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed rows of all days, with `_keyed` (0 for rows without a key) and the day."""
    return read_slices(spark, path, schema, [T.StructField(KEYED, T.IntegerType())])
