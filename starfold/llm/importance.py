"""Resampling of documents towards a target's distribution: hashed word runs weigh a text, and keyed noise draws it.

Every run of one to three words falls into one of `BUCKETS`; a bucket's gain is the scaled log ratio of its share in the
target and in the documents. A text weighs the sum of its gains, taken from one array, and scores its weight plus noise
that its id determines, so the highest scores are a draw without replacement.

The cutoff comes from weighted medians of medians: each piece of the table names the median of its remaining keys, and
the median of these, weighted by remaining sizes, has at least a quarter of all remaining keys on either side. So each
round discards a guaranteed share until the key of the wanted rank is found; only then are the winners sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starfold.llm.common import bounded, stored
from starfold.operators.surrogate import assign_ids
from starfold.session import new_folder

BUCKETS = 10_000
LONGEST = 3
SCALE = 1000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
# Keys whose median is taken together; one pair of numbers for each such piece comes to the driver in a round.
PIECE_ROWS = 1_000_000

# A-Z become lower case; other ASCII bytes but digits and lower-case letters part words.
_FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isdigit() or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def buckets(text: bytes | None, longest: int = LONGEST, n_buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """(words, the bucket of each run of 1 to `longest` consecutive words joined by one blank) of a text in UTF-8."""
    words = (text or b"").translate(_FOLDED).split()
    spaced = [b" " + word for word in words]
    sums, found = list(map(crc32, words)), []
    for n in range(longest):
        found.append(np.array(sums, np.int64))
        # A run with one more word continues the checksum of the run.
        sums = list(map(crc32, spaced[n + 1 :], sums))
    return len(words), np.concatenate(found) % n_buckets


def _texts(docs: DataFrame, text_col: str, *others: Column) -> DataFrame:
    # As bytes: nothing is decoded on the way to the checksums.
    return docs.select(F.col(text_col).cast("binary").alias("text"), *others)


def bucket_counts(docs: DataFrame, text_col: str = "text", longest: int = LONGEST, n_buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) for each bucket that a text falls into: features of all rows, repeats counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                found = buckets(text.as_py(), longest, n_buckets)[1]
                total += np.bincount(found, minlength=n_buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    tasks = _texts(docs, text_col).mapInArrow(bounded(run), "bucket long, n long")
    return tasks.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(target: DataFrame, source: DataFrame, scale: int = SCALE, n_buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, from (bucket, n) of both sides; `n_buckets` numbers, however large the tables are."""
    counts = {name: np.zeros(n_buckets, np.int64) for name in "ts"}
    for name, side in (("t", target), ("s", source)):
        for row in side.collect():
            counts[name][row.bucket] = row.n
    t_all, s_all = (float(counts[name].sum() + n_buckets) for name in "ts")
    pairs = zip(counts["t"].tolist(), counts["s"].tolist())
    return np.array([math.floor(scale * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for t, s in pairs], np.int64)


def weighed(
    docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST
) -> DataFrame:
    """(id, n_words, n_features, weight) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0):
                n_words, found = buckets(text.as_py(), longest, len(gains))
                rows.append((n_words, len(found), int(gains[found].sum())))
            columns = [batch.column(1), *(pa.array(c, pa.int64()) for c in zip(*rows))] if rows else None
            if columns:
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "weight"])

    own = F.col(id_col).cast("long").alias("id")
    return _texts(docs, text_col, own).mapInArrow(bounded(run), "id long, n_words long, n_features long, weight long")


def noise(own: Column, seed: int, scale: int) -> Column:
    """Scaled Gumbel noise that an id determines; a null id counts as ''."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(own.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def _halves(keys: np.ndarray, pivot: tuple | None) -> list[tuple[int, tuple | None]]:
    """(size, median) of the keys before the pivot and of those behind it; of all keys if there is no pivot yet."""
    order = np.lexsort(keys[::-1])
    keys = keys[:, order]
    if pivot is None:
        sides = [keys, keys[:, :0]]
    else:
        low = np.zeros(keys.shape[1], bool)
        high, same = low.copy(), ~low
        for part, at in zip(keys, pivot):
            low |= same & (part < at)
            high |= same & (part > at)
            same &= part == at
        sides = [keys[:, low], keys[:, high]]
    # The lower of two middle keys, so that both sides of the median of medians hold a quarter.
    return [(s.shape[1], tuple(s[:, (s.shape[1] - 1) // 2].tolist()) if s.shape[1] else None) for s in sides]


def _round(rows: DataFrame, keys: list[str], above: tuple | None, below: tuple | None, pivot: tuple | None, piece: int):
    """Sizes and medians of both sides of `pivot`, for each piece of the keys between `above` and `below`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            waiting.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
            n += batch.num_rows
            if n >= piece:
                yield _medians(waiting, pivot)
                waiting, n = [], 0
        if n:
            yield _medians(waiting, pivot)

    names = [f"{side}_{name}" for side in ("before", "after") for name in ("n", *keys)]
    remaining = _between(rows, keys, above, below).select(*keys)
    return remaining.mapInArrow(run, ", ".join(f"{name} long" for name in names)).collect()


def _medians(waiting: list[np.ndarray], pivot: tuple | None) -> pa.RecordBatch:
    halves = _halves(np.concatenate(waiting, axis=1), pivot)
    width = len(waiting[0])
    values = [v for n, median in halves for v in (n, *(median or [None] * width))]
    return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in values], [f"c{i}" for i in range(len(values))])


def _between(rows: DataFrame, keys: list[str], above: tuple | None, below: tuple | None) -> DataFrame:
    if above is not None:
        rows = rows.filter(_compared(keys, above, lambda c, v: c > v))
    if below is not None:
        rows = rows.filter(_compared(keys, below, lambda c, v: c < v))
    return rows


def _compared(keys: list[str], at: tuple, strictly) -> Column:
    """Whether a row's keys come before or behind `at`, the first key counting most."""
    found = F.lit(False)
    for key, value in reversed(list(zip(keys, at))):
        found = strictly(F.col(key), F.lit(value)) | ((F.col(key) == value) & found)
    return found


def cutoff(rows: DataFrame, keys: list[str], rank: int, piece: int = PIECE_ROWS) -> tuple | None:
    """The `rank`-th smallest key of `rows`, from 1; None if there are fewer. Keys are integers, not null and all distinct.

    A round reads the keys once and brings two sizes and medians for each `piece` of them to the driver.
    """
    above = below = pivot = None
    while True:
        found = _round(rows, keys, above, below, pivot, piece)
        width = len(keys) + 1
        before = [(r[0], tuple(r[1:width])) for r in found if r[0]]
        after = [(r[width], tuple(r[width + 1 :])) for r in found if r[width]]
        n_before = sum(n for n, _ in before)
        if pivot is None:
            if rank > n_before or rank < 1:
                return None
            pivot = _weighted_median(before)
        elif rank == n_before + 1:
            return pivot
        elif rank <= n_before:
            below, pivot = pivot, _weighted_median(before)
        else:
            rank -= n_before + 1
            above, pivot = pivot, _weighted_median(after)


def _weighted_median(medians: list[tuple[int, tuple]]) -> tuple:
    half, seen = sum(n for n, _ in medians) / 2, 0
    for n, key in sorted(medians, key=lambda m: m[1]):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    piece: int = PIECE_ROWS,
) -> DataFrame:
    """(id_col, n_features, weight, score, rank) for each row of `docs`; rank 1, 2, 3... for those drawn, else null.

    Of the N rows with at least `least_words` words the floor(percent * N / 100) highest scores are drawn, ties to
    smaller ids, a null id last. Rows that share score and id, as repeated rows do, are drawn in the order of the table
    of scores. A null text has no words; a text without words weighs 0. Words are runs of digits, letters a-z and
    characters above ASCII, A-Z in lower case. An empty target only adds one to each bucket. Other columns are
    ignored, whatever their names. An empty table gives no rows.
    """
    gains = bucket_gains(bucket_counts(target, target_col), bucket_counts(docs, text_col))
    rows = weighed(docs, gains, id_col, text_col)
    score = F.col("weight") + noise(F.col("id"), seed, SCALE)
    # Sorted upwards: the higher score, then the smaller id, then the place in the table.
    last = F.lit((1 << 63) - 1)
    order = {"down": -F.col("score"), "tie": F.coalesce("id", last), "place": F.monotonically_increasing_id()}
    scored = stored(rows.withColumn("score", score).withColumns(order), "scores")
    able = scored.filter(F.col("n_words") >= least_words)
    wanted = percent * able.count() // 100
    at = cutoff(able, list(order), wanted, piece) if wanted else None
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    others = scored if at is None else scored.filter(
        (F.col("n_words") < least_words) | _compared(list(order), at, lambda c, v: c > v)
    )
    result = others.select(*columns, F.lit(None).cast("long").alias("rank"))
    if at is None:
        return result
    winners = able.filter(~_compared(list(order), at, lambda c, v: c > v))
    ranked = assign_ids(winners, list(order), "rank", new_folder(docs.sparkSession, "winners"))
    return result.union(ranked.select(*columns, "rank"))
