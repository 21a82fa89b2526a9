"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Texts that stand for a missing value in API pages.
MISSING_TOKENS = ("", "nan", "None")


def newline_to_space(c: Column) -> Column:
    return F.replace(c, F.lit("\n"), F.lit(" "))


def clean_newlines(df: DataFrame) -> DataFrame:
    """Replace newlines in every string column."""
    return df.select(
        *[
            newline_to_space(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def repair_text(c: Column) -> Column:
    """Newline to space, no carriage returns, double to single quotes, trimmed."""
    c = F.replace(newline_to_space(c), F.lit("\r"), F.lit(""))
    return F.btrim(F.replace(c, F.lit('"'), F.lit("'")), F.lit(WHITESPACE))


def repair_value(c: Column, data_type: T.DataType) -> Column:
    """`repair_text` on every string inside a value of any nesting; map keys stay."""
    if isinstance(data_type, T.StringType):
        return repair_text(c)
    if isinstance(data_type, T.ArrayType):
        return F.transform(c, lambda item: repair_value(item, data_type.elementType))
    if isinstance(data_type, T.MapType):
        return F.transform_values(c, lambda _, item: repair_value(item, data_type.valueType))
    if isinstance(data_type, T.StructType):
        fields = [repair_value(c[f.name], f.dataType).alias(f.name) for f in data_type]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def repair_frame(df: DataFrame) -> DataFrame:
    return df.select(*[repair_value(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])


def missing_token_to_null(c: Column) -> Column:
    return F.when(~c.isin(*MISSING_TOKENS), c)


def null_tokens(df: DataFrame) -> DataFrame:
    """Every column as text, with the missing-value tokens turned into NULL."""
    return df.select(*[missing_token_to_null(F.col(c).cast("string")).alias(c) for c in df.columns])


def empty_to_null(df: DataFrame) -> DataFrame:
    """Empty strings as NULL, other columns unchanged."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )
