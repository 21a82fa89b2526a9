"""What several operators of this subpackage share: tables in the shared folder, batches, hashed words."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starfold.session import new_folder

# Rows of one long column that may be broadcast (16 MB); counted before each broadcast, else the join shuffles.
BROADCAST_IDS = 2_000_000
# Code points that one step of a numpy kernel works on; a longer text is a step of its own.
STEP_CHARS = 500_000
# Rows of an Arrow batch; by the default of 10,000 both ends of the pipe hold tens of megabytes of text for each task.
BATCH_ROWS = 1_000

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run` over batches of texts, with little memory held on either side of the pipe.

    Arrow batches of the session become small, unless it has a setting of its own. After a task its Python process,
    which stays for later tasks, gives freed memory back.
    """
    session, key = SparkSession.active(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    if session.conf.get(key) == "10000":
        session.conf.set(key, str(BATCH_ROWS))

    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return wrapped


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read from there: its lineage ends, and a lost executor takes nothing."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_IDS) -> DataFrame:
    """`df` of a few fixed-width columns, marked for broadcast if its counted rows are few; else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def learnt_from(id_col: str) -> Column:
    """Whether a row may be learnt from: the CRC of its id as text, modulo 3, is not 1. A null id counts as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 != 1


def steps(batches: Iterator[pd.DataFrame], text: str, chars: int = STEP_CHARS) -> Iterator[pd.DataFrame]:
    """The rows in pieces of about `chars` code points, null texts replaced by empty ones."""
    for batch in batches:
        texts = batch[text].where(batch[text].notna(), "")
        batch = batch.assign(**{text: texts})
        ends = texts.str.len().to_numpy(dtype=np.int64).cumsum()
        piece = ends // chars
        first = 0
        for last in [*(np.flatnonzero(np.diff(piece)) + 1), len(batch)]:
            if last > first:
                yield batch.iloc[first:last].reset_index(drop=True)
            first = last


def text_steps(texts: list[str], chars: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `chars` code points each."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number modulo 2**64 and their inverses, as many as were needed so far."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = pow(self.base, -1, 1 << 64)
            for name, base in (("up", self.base), ("down", inverse)):
                steps_ = np.full(max(n, 1 << 19), base, np.uint64)
                steps_[0] = 1
                setattr(self, name, np.cumprod(steps_))
        return self.up[:n], self.down[:n]


_POWERS = Powers(_MULTIPLIER)


def span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each span of 64-bit values; equal spans have equal hashes wherever they lie."""
    up, down = _POWERS.get(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def hashed_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of all texts, and where each text's words begin (one more than texts).

    A word is a longest run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return.
    """
    encoded = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    buffer = np.frombuffer(b"\n".join([*encoded, b""]), np.uint8)
    text_starts = np.cumsum([0, *(len(e) + 1 for e in encoded)])
    if not len(buffer):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    space = _SPACE[buffer]
    edges = np.diff(np.concatenate(([True], space)).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    hashes = mix(span_sums(buffer.astype(np.uint64) + np.uint64(1), starts, ends) + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, text_starts).astype(np.int64)


# A word in the sense of Java's and this library's expressions alike: letters, and marks that follow one.
LETTERS = r"\p{L}[\p{L}\p{M}]*"
_WORD = regex.compile(LETTERS)


def letter_words(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """The lower-case words of all texts, as `LETTERS` has them: codes, the distinct words, and where each text's codes begin."""
    found = [_WORD.findall(t.lower()) for t in texts]
    begins = np.cumsum([0, *map(len, found)])
    codes, distinct = pd.factorize(np.array(list(chain.from_iterable(found)), dtype=object))
    return codes, list(distinct), begins


def word_grams(words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of each word between `<` and `>`, and where each word's begin; short words have none."""
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    counts = np.maximum(sizes - n + 1, 0)
    begins = np.concatenate(([0], np.cumsum(counts)))
    starts = np.repeat(np.cumsum(sizes) - sizes, counts) + np.arange(begins[-1]) - np.repeat(begins[:-1], counts)
    return mix(span_sums(points + np.uint64(1), starts, starts + n) + np.uint64(n)), begins
