import datetime

import pytest
from pyspark.sql import functions as F

from starfold.functions import casts, dates, labels, text


def one(spark, value, make, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(make(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("12", 12),
        ("12.0", 12),
        ("12.7", 12),
        ("-3.9", -3),
        ("-0.5", 0),
        (" 42 ", 42),
        ("+7", 7),
        ("1e3", None),
        ("", None),
        ("junk", None),
        (None, None),
        ("99999999999", 99999999999),
        ("9223372036854775807", 2**63 - 1),
        ("9223372036854775808", None),
        ("0000000000000000000000012", 12),
        ("123456789012345678901234567890123456789012", None),
    ],
)
def test_to_long(spark, value, expected):
    assert one(spark, value, casts.to_long) == expected


@pytest.mark.parametrize("value, expected", [("5", 5), ("2147483648", None), ("-2147483648", -(2**31)), ("5.9", 5), ("x", None)])
def test_to_int(spark, value, expected):
    assert one(spark, value, casts.to_int) == expected


@pytest.mark.parametrize(
    "value, precision, scale, expected",
    [("12.345", 15, 2, "12.35"), ("12.5", 10, 0, "13"), ("104000000000", 10, 0, None), ("104000000000", 15, 2, "104000000000.00"), ("n/a", 15, 2, None)],
)
def test_to_decimal(spark, value, precision, scale, expected):
    got = one(spark, value, casts.to_decimal(precision, scale))
    assert (None if got is None else str(got)) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2010-02-03", 20100203),
        ("2010-02", 20100201),
        ("2010-02-03T09", 20100203),
        ("2010-02-03 10:11:12", 20100203),
        (" 2010-02-03 ", 20100203),
        ("not a date", 21000101),
        ("2010-02-30", 21000101),
        ("", 21000101),
        (None, 21000101),
        ("1850-01-02", 18500102),
        ("300000-01-01", None),
    ],
)
def test_date_key(spark, value, expected):
    assert one(spark, value, dates.date_key) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2010-02-03 04:05:06.789", 20100203),
        ("2010-02-03", 21000101),
        ("2010-02-03 04:05:06", 21000101),
        ("2010-13-03 04:05:06.789", 21000101),
        (None, 21000101),
    ],
)
def test_timestamp_key(spark, value, expected):
    assert one(spark, value, dates.timestamp_key) == expected


def test_key_to_date(spark):
    assert one(spark, 20120229, dates.key_to_date, "int") == datetime.date(2012, 2, 29)
    assert one(spark, None, dates.key_to_date, "int") is None


@pytest.mark.parametrize("value, expected", [("true", "A"), ("t", "A"), ("TRUE", "A"), (" yes ", "A"), ("1", "A"), ("false", "B"), (None, "B"), ("junk", "B"), ("", "B")])
def test_flag_label(spark, value, expected):
    assert one(spark, value, labels.flag_label("A", "B")) == expected


@pytest.mark.parametrize(
    "value, expected, any_case",
    [("TRUE", "Past", "Past"), ("FALSE", "Current", "Current"), ("true", "true", "Past"), ("x", "x", "x"), (None, "Unknown", "Unknown"), ("", "", "")],
)
def test_past_or_current(spark, value, expected, any_case):
    assert one(spark, value, labels.past_or_current) == expected
    assert one(spark, value, lambda c: labels.past_or_current(c, case_insensitive=True)) == any_case


@pytest.mark.parametrize("first, last, expected", [("A", "B", "A B"), (None, "B", "B"), ("A", None, "A"), (None, None, "")])
def test_full_name(spark, first, last, expected):
    df = spark.createDataFrame([(first, last)], "f string, l string")
    assert df.select(labels.full_name(F.col("f"), F.col("l"))).first()[0] == expected


def test_repair_text_equals_python(spark):
    samples = ["  a\nb\r\nc ", '"quoted"', " x　", "\x1ca\x1f", "", "\n", "no change", " \t in \t side \t ", "​kept​"]
    expected = [s.replace("\n", " ").replace("\r", "").replace('"', "'").strip() for s in samples]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(text.repair_text(F.col("s"))).collect()]
    assert got == expected


def test_repair_frame_reaches_nested_text(spark):
    schema = "a struct<b: string, c: array<string>>, m map<string, array<struct<d: string>>>, n int"
    df = spark.createDataFrame([((' x"', ["\ny", None]), {' k"': [('"z\r',)]}, 1), (None, None, None)], schema)
    first, second = text.repair_frame(df).collect()
    assert first.a.b == "x'" and first.a.c == ["y", None]
    assert first.m == {' k"': [first.m[' k"'][0]]} and first.m[' k"'][0].d == "'z"
    assert second.a is None and second.m is None and second.n is None


def test_null_tokens(spark):
    df = spark.createDataFrame([("", 1), ("nan", 2), ("None", 3), ("none", None), (" ", 5)], "s string, n int")
    assert [tuple(r) for r in text.null_tokens(df).collect()] == [
        (None, "1"), (None, "2"), (None, "3"), ("none", None), (" ", "5")
    ]


def test_clean_newlines_and_empty_to_null(spark):
    df = spark.createDataFrame([("a\nb\r\n", 1), ("", 2), (None, 3)], "s string, n int")
    assert [tuple(r) for r in text.clean_newlines(df).collect()] == [("a b\r ", 1), ("", 2), (None, 3)]
    assert [r.s for r in text.empty_to_null(df).collect()] == ["a\nb\r\n", None, None]
