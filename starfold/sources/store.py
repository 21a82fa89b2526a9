"""Versioned Parquet tables in key-hash buckets: a version counts only once its commit file is written."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starfold.session import empty_folder, keep_sorts_in_memory, list_in_few_tasks
from starfold.sources.once import names, write_once

BUCKET = "_bucket"
# Rows that a bucket is meant to have, and the most buckets of a table: a version names each of them.
BUCKET_ROWS = 1_000_000
MOST_BUCKETS = 65_536


class CommitConflict(RuntimeError):
    """Another writer has committed the version that this one was to become."""


@dataclass(frozen=True)
class Version:
    """What a commit file says.

    `keys` and `n_buckets` tell how rows are dealt to buckets. `parts` names for each folder the buckets that are read
    from it, so a bucket may lie in several folders and a folder may hold buckets that no longer count. `last_id` is the
    highest surrogate id given out, if known. `taken` is the last batch taken from each stream.
    """

    number: int
    rows: int
    schema: str
    keys: list[str] = field(default_factory=list)
    n_buckets: int = 1
    parts: dict[str, list[int]] = field(default_factory=dict)
    last_id: int | None = None
    taken: dict[str, int] = field(default_factory=dict)
    committed_at: str = ""

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def folders_of(self) -> dict[int, int]:
        """In how many folders each bucket lies."""
        counts: dict[int, int] = {}
        for buckets in self.parts.values():
            for b in buckets:
                counts[b] = counts.get(b, 0) + 1
        return counts


def buckets_for(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """A power of two, so that about `bucket_rows` rows or fewer are in a bucket."""
    return min(MOST_BUCKETS, 1 << max(0, -(-rows // bucket_rows) - 1).bit_length())


def bucket_of(df: DataFrame, keys: Sequence[str], n_buckets: int, null_safe: bool = False) -> Column | None:
    """A row's bucket, None if there is but one.

    Rows with a NULL key part, which match nothing, are spread unless NULLs compare as equal.
    """
    if n_buckets == 1:
        return None
    by_key = F.xxhash64(*keys)
    if not null_safe:
        unkeyed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        by_key = F.when(unkeyed, F.xxhash64(*df.columns)).otherwise(by_key)
    return F.pmod(by_key, F.lit(n_buckets)).cast("int")


class Store:
    """Tables under one shared folder.

    A store keeps to the version of a table it saw first, and to its own commits
    after that, so that one run reads one state. Open a new store to see later ones.
    Of two stores that write a table at once, the second to commit raises
    `CommitConflict`; each attempt writes to a folder of its own, so nothing is lost.
    Every version stays readable until `expire` is called.
    """

    def __init__(self, spark: SparkSession, root: str, bucket_rows: int = BUCKET_ROWS) -> None:
        keep_sorts_in_memory(spark)
        list_in_few_tasks(spark)
        self.spark = spark
        self.root = root.rstrip("/")
        self.bucket_rows = bucket_rows
        self._seen: dict[str, Version] = {}

    def _commits(self, table: str) -> str:
        return f"{self.root}/_commits/{table}"

    def version(self, table: str, number: int) -> Version:
        text = self.spark.read.text(f"{self._commits(table)}/{number:09d}.json", wholetext=True).first()[0]
        return Version(**json.loads(text))

    def versions(self, table: str) -> list[int]:
        return [int(name.split(".")[0]) for name in names(self.spark, self._commits(table))]

    def current(self, table: str) -> Version | None:
        """The newest committed version, or None before the first."""
        if table not in self._seen:
            numbers = self.versions(table)
            if not numbers:
                return None
            self._seen[table] = self.version(table, max(numbers))
        return self._seen[table]

    def read(self, table: str, buckets: Iterable[int] | None = None, version: Version | None = None) -> DataFrame:
        """The current or given version, or only some of its buckets: no file of another bucket is opened."""
        version = version or self.current(table)
        if version is None:
            raise LookupError(f"{table} has no committed version")
        wanted = None if buckets is None else set(buckets)
        paths = [
            f"{self.root}/{table}/{folder}/{BUCKET}={b}"
            for folder, held in version.parts.items() for b in held if wanted is None or b in wanted
        ]
        if not paths:
            return self.spark.createDataFrame([], version.columns)
        return self.spark.read.schema(version.columns).parquet(*paths)

    def write_part(self, table: str, df: DataFrame, bucket: Column | None = None) -> dict[str, list[int]]:
        """Write rows to a folder of their own, by bucket or all to bucket 0; returns it with the buckets that it holds.

        The rebalance hint groups rows by bucket, splits large buckets and joins small ones.
        """
        folder = f"part-{uuid.uuid4().hex}"
        path = f"{self.root}/{table}/{folder}"
        rows = df.withColumn(BUCKET, F.lit(0)) if bucket is None else df.withColumn(BUCKET, bucket).hint("rebalance", BUCKET)
        rows.write.partitionBy(BUCKET).parquet(path)
        held = [int(n.split("=")[1]) for n in names(self.spark, path) if n.startswith(f"{BUCKET}=")]
        return {folder: sorted(held)} if held else {}

    def publish(self, table: str, version: Version) -> Version:
        """Make `version` the current one, unless its number has been taken since this store read the table."""
        version = replace(version, committed_at=datetime.now(timezone.utc).isoformat())
        path = f"{self._commits(table)}/{version.number:09d}.json"
        if not write_once(self.spark, path, json.dumps(asdict(version))):
            raise CommitConflict(f"version {version.number} of {table} has been committed by another writer")
        self._seen[table] = version
        return version

    def commit(self, table: str, df: DataFrame) -> Version:
        """Write `df` as the next version, in one bucket, then make it current.

        The rows are counted from the written files. A job that fails before the
        last step leaves the former version in place.
        """
        before = self.current(table)
        parts = self.write_part(table, df)
        version = Version(1 if before is None else before.number + 1, 0, df.schema.json(), parts=parts)
        rows = self.read(table, version=version).count()
        return self.publish(table, replace(version, rows=rows))

    def expire(self, table: str, older_than: int) -> None:
        """Empty the folders that only versions before number `older_than` read; call it when nothing reads them any more.

        The current version stays whole.
        """
        version = self.current(table)
        if version is None:
            return
        older_than = min(older_than, version.number)
        numbers = self.versions(table)
        kept = {f for n in numbers if n >= older_than for f in self.version(table, n).parts}
        gone = {f for n in numbers if n < older_than for f in self.version(table, n).parts} - kept
        for folder in sorted(gone):
            for name in names(self.spark, f"{self.root}/{table}/{folder}"):
                if name.startswith(f"{BUCKET}="):
                    empty_folder(self.spark, f"{self.root}/{table}/{folder}/{name}")

    def tables(self, names_: Sequence[str] | None = None) -> DataFrame:
        """Name, version and rows of the committed tables, or of those of `names_`."""
        listed = names(self.spark, f"{self.root}/_commits") if names_ is None else names_
        found = [(name, version) for name in listed if (version := self.current(name))]
        rows = [(name, version.number, version.rows) for name, version in found]
        return self.spark.createDataFrame(rows, "table_name string, version long, rows long")


def merged_parts(before: Version, replaced: Iterable[int], *added: Mapping[str, list[int]]) -> dict[str, list[int]]:
    """The parts of `before` without the replaced buckets, and the added ones."""
    replaced = set(replaced)
    parts = {folder: [b for b in held if b not in replaced] for folder, held in before.parts.items()}
    for part in added:
        parts.update(part)
    return {folder: held for folder, held in parts.items() if held}
