from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import cleaning
from millrace.functions.temporal import date_parts, minutes_between


def values(spark, items, expression, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {dtype}")
    return [r.x for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_clean_text_and_category(spark):
    dirty = [" a ", "   ", "", None, "\ta", " a ", "card "]
    assert values(spark, dirty, cleaning.clean_text("v")) == ["a", None, None, None, "\ta", "a", "card"]
    assert values(spark, dirty, cleaning.clean_category("v"))[-1] == "CARD"


def test_safe_casts(spark):
    assert values(spark, ["x", "12"], cleaning.safe_cast("v", "bigint")) == [None, 12]
    assert values(spark, ["2024-13-01", "2024-12-01"], cleaning.utc_timestamp("v", safe=True)) == [
        None,
        datetime(2024, 12, 1),
    ]
    assert values(spark, ["12.345", "-12.345"], cleaning.safe_cast("v", "decimal(12,2)")) == [
        Decimal("12.35"),
        Decimal("-12.35"),
    ]


@pytest.mark.parametrize("value, dtype", [("x", "bigint"), ("2024-13-01", "timestamp"), ("x", "decimal(12,2)")])
def test_strict_cast_raises(spark, value, dtype):
    with pytest.raises(PySparkException):
        values(spark, [value], cleaning.strict_cast("v", dtype))


def test_whole_numbers_round(spark):
    texts = ["2.5", "3.5", "-2.5", "1e3", " 7 ", "", "+5", "x"]
    got = values(spark, texts, cleaning.whole_number("v", T.StringType(), "bigint", safe=True))
    assert got == [3, 4, -3, 1000, 7, None, 5, None]
    halves = [2.5, 3.5, -2.5]
    assert values(spark, halves, cleaning.whole_number("v", T.DoubleType(), "int"), "double") == [2, 4, -2]
    exact = cleaning.whole_number(F.col("v").cast("decimal(3,1)"), T.DecimalType(3, 1), "int")
    assert values(spark, halves, exact, "double") == [3, 4, -3]
    with pytest.raises(PySparkException):
        values(spark, ["x"], cleaning.whole_number("v", T.StringType(), "bigint"))


def test_time_texts(spark):
    texts = {
        "2024-01-02T03:04:05": datetime(2024, 1, 2, 3, 4, 5),
        "2024-1-2": datetime(2024, 1, 2),
        " 2024-01-02 03:04": datetime(2024, 1, 2, 3, 4),
        "2024-01-02 03:04:05.123456": datetime(2024, 1, 2, 3, 4, 5, 123456),
        "2024-01-02 03:04:05 UTC": datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02 03:04:05+02:00": datetime(2024, 1, 2, 1, 4, 5),
        "2024": None,
        "2024-01": None,
        "12:30:00": None,
        "2024-01-02 ": None,
        "2024-01-02 03": None,
        "2024-02-30": None,
        "soon": None,
        None: None,
    }
    assert values(spark, texts, cleaning.utc_timestamp("v", safe=True)) == list(texts.values())
    assert values(spark, [None, "2024-1-2"], cleaning.utc_timestamp("v")) == [None, datetime(2024, 1, 2)]
    for bad in ("12:30:00", "2024", "2024-02-30"):
        with pytest.raises(PySparkException):
            values(spark, [bad], cleaning.utc_timestamp("v"))


def test_utc_day_of_zoned_times(spark):
    zoned = ["2024-01-01 23:59:59+00:00", "2024-01-02 09:00:00+10:00"]
    assert values(spark, zoned, cleaning.utc_day("v")) == [date(2024, 1, 1)] * 2
    assert values(spark, zoned[1:], cleaning.utc_timestamp("v")) == [datetime(2024, 1, 1, 23)]


def test_minute_boundaries(spark):
    pairs = [
        ("2024-01-01 00:00:59", "2024-01-01 00:01:00", 1),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:59", 0),
        ("2024-01-01 00:05:00", "2024-01-01 00:01:59", -4),
        ("1969-12-31 23:58:30", "1970-01-01 00:00:10", 2),
        ("2024-01-01 00:00:00", None, None),
    ]
    df = spark.createDataFrame(pairs, "a string, b string, n long")
    df = df.select("n", *[F.col(c).cast("timestamp_ntz").alias(c) for c in "ab"])
    assert all(r.n == r.m for r in df.select("n", minutes_between("a", "b").alias("m")).collect())


def test_date_parts(spark):
    df = spark.createDataFrame([(date(2024, 1, 6),), (date(2024, 1, 7),), (date(2021, 1, 1),)], "d date")
    parts = date_parts("d")
    got = df.select(parts["day_of_week"].alias("dow"), parts["week_of_year"].alias("w")).collect()
    assert [(r.dow, r.w) for r in got] == [(6, 1), (0, 1), (5, 53)]


def test_cents_are_exact(spark):
    amounts = ["0.00", "0.01", "-0.29", "1.15", "9999999999999.99", "-9999999999999.98", "4503599627370.49", None]
    col = F.col("v").cast("decimal(15,2)")
    expected = [None if a is None else int(Decimal(a) * 100) for a in amounts]
    assert values(spark, amounts, cleaning.cents(col)) == expected
    back = values(spark, amounts, cleaning.from_cents(cleaning.cents(col)))
    assert back == [None if a is None else Decimal(a) for a in amounts]
    every = spark.range(200_000).select((F.col("id") * 7919).alias("n"))
    asis = (F.col("n").cast("decimal(15,0)") * F.lit(Decimal("0.01"))).cast("decimal(15,2)")
    assert every.where(cleaning.cents(asis) != F.col("n")).count() == 0


# Texts that DuckDB's cast to a zoned time reads or refuses, and the cleaning must do the same.
TIME_TEXTS = [
    "2024-01-01 10:00:00", " 2024-01-01 10:00:00 ", "2024-01-01 10:00:00\t", "\n2024-01-01", "2024/01/01", "2024/01/01 10:00",
    "2024-01-01 24:00:00", "2024-01-01 24:00", "2024-12-31 24:00:00.000", "2024-01-01 24:00:01", "2024-01-01 24:00:00+02", "24-01-01",
    "224-01-01", "1-1-1", "epoch", "EPOCH", "2024", "2024-01", "10:00:00", "now", "2024-01-01T10:00:00Z", "2024-01-01T10:00:00+02:00",
    "2024-01-01 10:00:00+0230", "2024-01-01 10:00:00 +02", "2024-01-01 10:00:00-05:30", "2024-01-01 10:00:00 UTC",
    "2024-01-01 10:00:00.123456789", "2024-01-01 10:00:00.5+02", "2024-01-01 10:00", "2024-01-01 10", "2024-1-1 1:2:3", "2024-02-30",
    "2024-13-01", "2024-01-01  10:00:00", "2024-01-01 10:00:60", "2024-01-01 25:00:00", "2024 01 01", "2024\\01\\01", "20240101",
    "2024-01-01x", "", "  ", "2024-01-01 10:00:", "2024-01-01 10:00:00.", "2024-01-01T", "2024-01-01 ", "+2024-01-01", "2024-01/01",
    "2024-01-01 010:00:00", "2024-01-01 10:00:00+02:00:30", "2024-001-01", "2024-01-01\u00a010:00",
]


def test_time_texts_read_as_the_warehouse_does(spark):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    df = spark.createDataFrame(list(enumerate(TIME_TEXTS)), "i int, t string")
    got = {r.i: r.at for r in df.select("i", cleaning.utc_timestamp("t", safe=True).alias("at")).collect()}
    for i, text in enumerate(TIME_TEXTS):
        expected = con.execute("select try_cast(? as timestamptz)::timestamp", [text]).fetchone()[0]
        assert got[i] == expected, text
    good = [text for i, text in enumerate(TIME_TEXTS) if got[i] is not None]
    assert len(good) >= 25
    strict = spark.createDataFrame([(t,) for t in good], "t string").select(cleaning.utc_timestamp("t")).collect()
    assert all(r[0] is not None for r in strict)
    for text in (t for i, t in enumerate(TIME_TEXTS) if got[i] is None):
        with pytest.raises(Exception, match="not a time"):
            spark.createDataFrame([(text,)], "t string").select(cleaning.utc_timestamp("t")).collect()
