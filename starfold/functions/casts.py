"""Casts of staged text that give NULL, not an error, for bad input.

They hold under ANSI mode and keep the older rule that a decimal text such as
`12.7` is truncated when an integer is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Numbers of as many whole digits as a 64- and a 32-bit integer can have.
LONG_TEXT = r"^\s*[+-]?0*\d{1,19}(\.\d*)?\s*$"
INT_TEXT = r"^\s*[+-]?0*\d{1,10}(\.\d*)?\s*$"


def _whole_part(c: Column, text: str, to: str) -> Column:
    """Matched before it is cast: a `try_cast` to an integer that fails costs an exception per row."""
    return F.when(c.rlike(text), F.substring_index(F.trim(c), ".", 1).try_cast(to))


def to_long(c: Column) -> Column:
    return _whole_part(c, LONG_TEXT, "bigint")


def to_int(c: Column) -> Column:
    return _whole_part(c, INT_TEXT, "int")


def to_float(c: Column) -> Column:
    return c.try_cast("float")


def to_decimal(precision: int, scale: int):
    def cast(c: Column) -> Column:
        return c.try_cast(f"decimal({precision},{scale})")

    return cast
