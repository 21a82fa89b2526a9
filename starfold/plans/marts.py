"""Staged rows to dimension and fact rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starfold.functions.casts import to_long
from starfold.functions.text import clean_newlines
from starfold.operators.dedup import keep_first
from starfold.operators.lookup import BROADCAST_ROWS, hot_keys, lookup_id, spread_left_join
from starfold.plans.specs import (
    DIMENSION_KEYS,
    FUNDING_ROUNDS,
    INVESTMENTS,
    PARTICIPATION_KEY,
    ROUND_AMOUNTS,
    TableSpec,
    declared_money,
)


@dataclass(frozen=True)
class Dimension:
    """A loaded dimension and its counted rows."""

    rows: DataFrame
    n_rows: int | None = None


# The staged row of a built row with a key that no dimension has yet, NULL for others.
PENDING = "_pending"


def _build(
    spec: TableSpec, staged: DataFrame, dimensions: Mapping[str, Dimension] | None = None, pending: bool = False
) -> DataFrame:
    """The table's rows, and `_spread` that differs from row to row; with `pending` also `PENDING`.

    `_spread` is a hash of the key once rows are one per key, else the row's place
    in the staged files. It is set before any shuffle, so a repeated task finds the same.
    """
    rows = staged.select(*spec.staged_columns)
    spread = F.monotonically_increasing_id()
    if spec.one_row_per:
        rows = keep_first(rows, [spec.one_row_per])
        spread = F.xxhash64(spec.one_row_per)
    keys = [F.col(k.source).alias(k.nk) for k in spec.lookups]
    own = [F.struct(*spec.staged_columns).alias(PENDING)] if pending else []
    has = [F.col(k.source).isNotNull().alias(f"_has_{k.as_id}") for k in spec.lookups] if pending else []
    rows = rows.select(*[f.column() for f in spec.fields], *keys, spread.alias("_spread"), *own, *has)
    for lookup in spec.lookups:
        nk, dimension_id = DIMENSION_KEYS[lookup.dimension]
        dimension = dimensions[lookup.dimension]
        hot = None
        if dimension.n_rows is None or dimension.n_rows > BROADCAST_ROWS:
            # Counted on the staged column alone, before the wider steps above.
            hot = hot_keys(staged.select(F.col(lookup.source).alias(lookup.nk)), [lookup.nk])
        rows = lookup_id(rows, dimension.rows, dimension.n_rows, lookup.nk, nk, dimension_id, lookup.as_id, hot, F.col("_spread"))
    if pending:
        waits = reduce(lambda a, b: a | b, [F.col(f"_has_{k.as_id}") & F.col(k.as_id).isNull() for k in spec.lookups], F.lit(False))
        rows = rows.withColumn(PENDING, F.when(waits, F.col(PENDING))).drop(*[f"_has_{k.as_id}" for k in spec.lookups])
    return rows


def build(
    spec: TableSpec, staged: DataFrame, dimensions: Mapping[str, Dimension] | None = None, pending: bool = False
) -> DataFrame:
    """The rows of one table, without its own surrogate id; with `pending` also `PENDING`."""
    return _build(spec, staged, dimensions, pending).drop("_spread")


def build_participation(
    investments: DataFrame,
    rounds: DataFrame,
    dimensions: Mapping[str, Dimension],
    money: Callable[[Column], Column] = declared_money,
) -> DataFrame:
    """Staged investments with the attributes of their round, NULL where the round is missing.

    A round with a large share of the investments is spread over tasks.
    """
    round_nk = "funding_round_nk"
    hot = hot_keys(investments.select(to_long(F.col("funding_round_id")).alias(round_nk)), [round_nk])
    joined = spread_left_join(
        _build(INVESTMENTS, investments, dimensions),
        build(FUNDING_ROUNDS, rounds, dimensions),
        [round_nk],
        hot,
        F.col("_spread"),
    )
    return joined.select(
        *PARTICIPATION_KEY,
        "investor_company_id",
        "investee_company_id",
        "funded_at",
        "funding_round_type",
        "funding_round_code",
        *[money(F.col(c)).alias(c) for c in ROUND_AMOUNTS],
        "number_of_participants",
        "round_position_desc",
        "round_stage_desc",
    )


def rounds_of(investments: DataFrame, rounds: DataFrame) -> DataFrame:
    """The staged rounds that the investments name, before anything else is done to them."""
    number = to_long(F.col("funding_round_id")).alias("_number")
    named = investments.select(number).filter("_number is not null").distinct()
    return rounds.select("*", number).join(named, "_number", "left_semi").drop("_number")


def investee_mismatches(investments: DataFrame, rounds: DataFrame) -> DataFrame:
    """Staged investments whose funded company differs from their round's company."""
    left = investments.select("investment_id", "funding_round_id", "funded_object_id")
    right = rounds.select("funding_round_id", "object_id").distinct()
    joined = spread_left_join(left, right, ["funding_round_id"])
    return joined.filter(F.col("funded_object_id") != F.col("object_id"))


def stage_database_rows(df: DataFrame) -> DataFrame:
    """Database rows as staged text, with newlines as blanks."""
    return clean_newlines(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]))
