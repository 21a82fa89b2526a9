"""Integer date keys `YYYYMMDD` and the unknown date."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The key of an unknown date, and the timestamp pattern of staged relationships.
UNKNOWN_DATE_KEY = 21000101
MILLISECOND_PATTERN = "yyyy-MM-dd HH:mm:ss.SSS"


def to_date(c: Column) -> Column:
    return c.try_cast("date")


def key_of_date(d: Column) -> Column:
    """A date as an integer; a missing one gives the unknown date."""
    number = F.year(d).cast("bigint") * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    return F.when(d.isNull(), UNKNOWN_DATE_KEY).otherwise(number.try_cast("int"))


def date_key(c: Column) -> Column:
    """Any text Spark reads as a date; missing or unreadable gives the unknown date."""
    return key_of_date(to_date(c))


def timestamp_key(c: Column) -> Column:
    """Only text in the millisecond pattern; anything else gives the unknown date."""
    return key_of_date(F.try_to_timestamp(c, F.lit(MILLISECOND_PATTERN)).cast("date"))


def key_to_date(key: Column) -> Column:
    return F.make_date(
        F.floor(key / 10000).cast("int"), (F.floor(key / 100) % 100).cast("int"), (key % 100).cast("int")
    )


def is_known(key: Column) -> Column:
    """True where the key names a real date."""
    return key.isNotNull() & (key != UNKNOWN_DATE_KEY)
