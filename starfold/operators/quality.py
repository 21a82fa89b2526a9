"""Missing values, declared constraints and references, each from one pass where possible."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starfold.functions.dates import UNKNOWN_DATE_KEY
from starfold.operators.lookup import BROADCAST_ROWS

# Keys listed in one report row. Blocks follow the row order of the written files.
_BLOCK_BITS = 13


def _is_missing(column: str, date_cols: Sequence[str]) -> Column:
    if column in date_cols:
        return F.coalesce(F.col(column) == UNKNOWN_DATE_KEY, F.lit(False))
    return F.col(column).isNull()


def _checked(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def missing_summary(df: DataFrame, keys: Sequence[str], date_cols: Sequence[str] = ()) -> DataFrame:
    """(column_name, num_missing) for every non-key column, from one aggregate."""
    columns = _checked(df, keys)
    counts = df.agg(*[F.count_if(_is_missing(c, date_cols)).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "num_missing")


def missing_detail(df: DataFrame, keys: Sequence[str], date_cols: Sequence[str] = ()) -> DataFrame:
    """One row per missing value: its column and the row's key; rows with a NULL key are left out."""
    hits = F.array_compact(
        F.array(*[F.when(_is_missing(c, date_cols), F.lit(c)) for c in _checked(df, keys)])
    )
    return df.dropna(subset=list(keys)).select(F.explode(hits).alias("column_name"), *keys)


def missing_report(df: DataFrame, table: str, keys: Sequence[str], date_cols: Sequence[str] = ()) -> DataFrame:
    """Report rows (table_name, column_name, num_missing, block, missing_rows).

    All keys are listed, over as many rows as it takes: a block covers 8,192
    consecutive rows of one input partition, so no list grows with the data.
    `df` is read from files, whose row order does not change. A column without a
    listed key has one row with no block.
    """
    place = F.shiftright(F.monotonically_increasing_id(), _BLOCK_BITS)
    listed = (
        missing_detail(df.withColumn("_block", place), [*keys, "_block"], date_cols)
        .groupBy("column_name", F.col("_block").alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct(*keys))).alias("missing_rows"))
    )
    # One row per column of the table.
    summary = missing_summary(df, keys, date_cols).withColumn("table_name", F.lit(table))
    counted = listed.join(F.broadcast(summary), "column_name")
    empty = summary.join(listed.select("column_name").distinct(), "column_name", "left_anti")
    order = ["table_name", "column_name", "num_missing", "block", "missing_rows"]
    return counted.select(*order).unionByName(empty, allowMissingColumns=True).select(*order)


def constraint_violations(
    df: DataFrame,
    required: Sequence[str] = (),
    unique: Sequence[Sequence[str]] = (),
    max_length: Mapping[str, int] | None = None,
    max_amount_digits: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """(rule, column_name, violations) for each declared rule.

    `max_amount_digits` is for staged text: a number that does not fit
    decimal(precision, scale). Uniqueness ignores keys with a NULL part and counts
    the rows beyond the first of each key.
    """
    rules: list[tuple[str, str, Column]] = [("not_null", c, F.col(c).isNull()) for c in required]
    rules += [("max_length", c, F.length(c) > n) for c, n in (max_length or {}).items()]
    for c, (precision, scale) in (max_amount_digits or {}).items():
        too_big = F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({precision},{scale})").isNull()
        rules.append(("fits_decimal", c, too_big))
    parts = []
    if rules:
        counts = df.agg(*[F.count_if(bad).alias(f"{rule}:{c}") for rule, c, bad in rules])
        tall = counts.unpivot([], counts.columns, "name", "violations")
        name = F.split("name", ":")
        parts.append(tall.select(name[0].alias("rule"), name[1].alias("column_name"), "violations"))
    for key in unique:
        per_key = df.dropna(subset=list(key)).groupBy(*key).count()
        parts.append(
            per_key.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations")).select(
                F.lit("unique").alias("rule"), F.lit(",".join(key)).alias("column_name"), "violations"
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def rule_violations(
    df: DataFrame,
    required: Sequence[str] = (),
    unique: Sequence[Sequence[str]] = (),
    max_length: Mapping[str, int] | None = None,
) -> DataFrame:
    """(rule, column_name, violations) for each declared rule, all from one scan and one shuffle.

    A row yields the rules that it breaks, which are counted before the shuffle, and one entry for each unique key. Keys
    with a NULL part are left out; the rows beyond the first of each key count.
    """
    broken = {("not_null", c): F.col(c).isNull() for c in required}
    broken |= {("max_length", c): F.length(c) > n for c, n in (max_length or {}).items()}
    keyed = {}
    for key in unique:
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
        keyed["unique", ",".join(key)] = F.when(whole, F.to_json(F.struct(*key)))
    declared = [*broken, *keyed]

    def entry(rule: tuple[str, str], holds: Column, value: Column) -> Column:
        return F.when(holds, F.struct(F.lit(declared.index(rule)).alias("rule_no"), value.alias("value")))

    none = F.lit(None).cast("string")
    entries = [entry(rule, bad, none) for rule, bad in broken.items()]
    entries += [entry(rule, value.isNotNull(), value) for rule, value in keyed.items()]
    counted = (
        df.select(F.inline(F.array_compact(F.array(*entries))))
        .groupBy("rule_no", "value").agg(F.count("*").alias("n"))
        .groupBy("rule_no").agg(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(F.col("n") - 1)).alias("violations"))
    )
    # One row for each declared rule.
    rules = df.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(declared)], "rule_no int, rule string, column_name string")
    found = F.broadcast(rules).join(counted, "rule_no", "left")
    return found.select("rule", "column_name", F.coalesce("violations", F.lit(0)).alias("violations"))


def references(tables: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """(table_name, column_name, dimension, value, n_rows): the values by which tables refer to dimensions, counted once.

    `tables` maps a name to its rows and to the dimension of each referring column. NULL refers to nothing.
    """
    parts = []
    for name, (df, columns) in tables.items():
        dimension = F.create_map(*[F.lit(x) for pair in columns.items() for x in pair])
        tall = df.select(*[F.col(c).cast("bigint").alias(c) for c in columns]).unpivot([], list(columns), "column_name", "value")
        parts.append(tall.filter("value is not null").select(
            F.lit(name).alias("table_name"), "column_name", dimension[F.col("column_name")].alias("dimension"), "value"
        ))
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.groupBy(*stacked.columns).agg(F.count("*").alias("n_rows"))


def broken_references_of(
    tables: Mapping[str, tuple[DataFrame, Mapping[str, str]]], dimensions: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Rows of `references` whose dimension lacks the value.

    All columns of all tables meet the keys of all dimensions in one anti join; each value takes part once.
    """
    known = [
        df.select(F.lit(name).alias("dimension"), F.col(key).cast("bigint").alias("value")) for name, (df, key) in dimensions.items()
    ]
    return references(tables).join(reduce(DataFrame.unionByName, known), ["dimension", "value"], "left_anti")


def broken_references(
    df: DataFrame, column: str, dimension: DataFrame, dimension_key: str, dimension_rows: int | None = None
) -> DataFrame:
    """(column_name, value, n_rows) for non-NULL values of `column` the dimension lacks.

    Values are counted first, so the join sees each value once. The dimension is
    broadcast only when its counted rows are few enough.
    """
    values = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("bigint").alias("value")).agg(
        F.count("*").alias("n_rows")
    )
    known = dimension.select(F.col(dimension_key).cast("bigint").alias("value"))
    few = dimension_rows is not None and dimension_rows <= BROADCAST_ROWS
    missing = values.join(F.broadcast(known) if few else known, "value", "left_anti")
    return missing.select(F.lit(column).alias("column_name"), "value", "n_rows")
