import datetime as dt

import pytest
from pyspark.sql import functions as F

from layerwright import functions as L


def one(spark, column, schema, *values):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, expected",
    [("12", 12), (" 12 ", 12), ("1.5", 2), ("-2.5", -3), ("1e3", 1000), ("abc", None), ("", None), ("12L", None), (None, None),
     ("9223372036854775808", None), ("9007199254740993", 9007199254740993)],
)
def test_safe_bigint(spark, text, expected):
    assert one(spark, L.safe_bigint("s"), "s string", text) == expected


@pytest.mark.parametrize("text, expected", [("1.5", 1.5), ("1e3", 1000.0), ("1.5d", None), ("2f", None), ("x", None), ("", None), (None, None)])
def test_safe_double(spark, text, expected):
    assert one(spark, L.safe_double("s"), "s string", text) == expected


def test_safe_double_keeps_infinity(spark):
    assert one(spark, L.safe_double("s"), "s string", "inf") == float("inf")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-07-26T23:50:00.000", dt.datetime(2026, 7, 26, 23, 50)),
        ("2026-07-27T17:11:28Z", dt.datetime(2026, 7, 27, 17, 11, 28)),
        ("2026-07-26", dt.datetime(2026, 7, 26)),
        ("2026-7-6", dt.datetime(2026, 7, 6)),
        ("2026", None),
        ("2026-07", None),
        ("2026-07-27 17", None),
        ("2026-02-30", None),
        ("12:30", None),
        ("soon", None),
        (None, None),
    ],
)
def test_safe_timestamp(spark, text, expected):
    assert one(spark, L.safe_timestamp("s"), "s string", text) == expected


def test_safe_date(spark):
    assert one(spark, L.safe_date("s"), "s string", "2026-07-26") == dt.date(2026, 7, 26)
    assert one(spark, L.safe_date("s"), "s string", "2026-07-26 junk") is None


@pytest.mark.parametrize(
    "start, end, hours",
    [
        ("2026-07-26 10:59:00", "2026-07-26 11:01:00", 1),
        ("2026-07-26 11:01:00", "2026-07-26 10:59:00", -1),
        ("2026-07-26 23:50:00", "2026-08-01 09:00:00", 130),
        ("2026-07-26 10:00:00", None, None),
    ],
)
def test_hours_between_counts_boundaries(spark, start, end, hours):
    column = L.hours_between(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz"))
    assert one(spark, column, "a string, b string", start, end) == hours


def test_time_helpers_ignore_the_session_zone(spark):
    # 02:30 does not exist on this day in New York.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts = F.lit("2024-03-10 02:30:00").cast("timestamp_ntz")
        later = F.lit("2024-03-10 04:00:00").cast("timestamp_ntz")
        row = spark.range(1).select(L.trunc_ntz("day", ts), L.trunc_ntz("month", ts), L.hours_between(ts, later)).first()
        assert tuple(row) == (dt.datetime(2024, 3, 10), dt.datetime(2024, 3, 1), 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_trunc_is_zone_less(spark):
    df = spark.range(1).select(L.trunc_ntz("month", F.lit("2024-03-10").cast("date")).alias("m"))
    assert df.dtypes == [("m", "timestamp_ntz")]
    with pytest.raises(ValueError):
        L.trunc_ntz("fortnight", F.lit("2024-03-10").cast("date"))


@pytest.mark.parametrize("value, expected", [(["a", "b"], "a"), ([], None), (None, None)])
def test_first_element(spark, value, expected):
    assert one(spark, L.first_element("a"), "a array<string>", value) == expected


@pytest.mark.parametrize("text, expected", [("a\nb", "a"), ("ab", "ab"), ("", ""), (None, None), ("\nb", "")])
def test_headline(spark, text, expected):
    assert one(spark, L.headline("s"), "s string", text) == expected


@pytest.mark.parametrize("status, expected", [("Closed", False), ("Open", True), (None, True)])
def test_is_not(spark, status, expected):
    assert one(spark, L.is_not("s", "Closed"), "s string", status) is expected


def test_fill_and_ratio(spark):
    assert one(spark, L.fill("s"), "s string", None) == "UNSPECIFIED"
    assert one(spark, L.ratio(F.col("a"), F.col("b")), "a bigint, b bigint", 0, 0) == 0.0
    assert one(spark, L.ratio(F.col("a"), F.col("b")), "a bigint, b bigint", 1, 4) == 0.25


def test_days_before(spark):
    assert one(spark, L.days_before(L.ntz_literal("2024-03-01 00:00:00"), 3), "a int", 1) == dt.datetime(2024, 2, 27)
