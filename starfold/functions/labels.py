"""Defaults and flag labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

def or_default(value: str):
    """NULL becomes `value`."""

    def fill(c: Column) -> Column:
        return F.coalesce(c, F.lit(value))

    return fill


def flag_label(when_true: str, otherwise: str):
    """`when_true` for a text that reads as true, `otherwise` for anything else."""

    def label(c: Column) -> Column:
        return F.when(c.try_cast("boolean"), when_true).otherwise(otherwise)

    return label


def past_or_current(c: Column, case_insensitive: bool = False) -> Column:
    """NULL, `TRUE` and `FALSE` become words; any other text is kept."""
    compared = F.upper(c) if case_insensitive else c
    return (
        F.when(c.isNull(), "Unknown")
        .when(compared == "TRUE", "Past")
        .when(compared == "FALSE", "Current")
        .otherwise(c)
    )


def full_name(first: Column, last: Column) -> Column:
    """Both parts with a blank between; a missing part is left out."""
    return F.concat_ws(" ", first, last)
