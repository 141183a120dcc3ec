"""Casting, calendar and banding on edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.casting import blank_to_null, maybe_double, maybe_int, maybe_long, maybe_money, or_unknown
from ledgerline.functions.measures import band, ratio
from ledgerline.functions.times import (
    lead_days, minutes_between, months_apart, seconds_between, timeline_is_valid,
)

T = dt.datetime


def stamps(spark, rows):
    return spark.createDataFrame(rows, "c timestamp_ntz, s timestamp_ntz, d timestamp_ntz, r timestamp_ntz")


def test_text_to_numbers(spark):
    df = spark.createDataFrame([("3.7",), ("2.5",), ("x",), ("",), ("  ",), (None,), (" 12 ",)], "v string")
    got = [r[0] for r in df.select(maybe_int(df, "v")).collect()]
    assert got == [4, 2, None, None, None, None, 12]
    assert [r[0] for r in df.select(maybe_double("v")).collect()][:3] == [3.7, 2.5, None]
    big = spark.createDataFrame([("9007199254740993",)], "v string")
    assert big.select(maybe_long(big, "v")).first()[0] == 9007199254740993
    assert str(df.select(maybe_money(df, "v")).first()[0]) == "3.7000"


def test_strict_cast_fails(spark):
    df = spark.createDataFrame([("abc",)], "id string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(F.col("id").cast("bigint")).collect()


def test_blank_chain(spark):
    df = spark.createDataFrame([(" a ",), ("",), ("   ",), (None,)], "v string")
    assert [r[0] for r in df.select(blank_to_null("v")).collect()] == ["a", None, None, None]
    assert [r[0] for r in df.select(or_unknown("v")).collect()] == ["a", "Unknown", "Unknown", "Unknown"]


def test_minute_boundaries(spark):
    df = stamps(spark, [
        (T(2024, 1, 1, 0, 0, 59), T(2024, 1, 1, 0, 1, 0), None, None),
        (T(2024, 1, 1, 0, 1, 0), T(2024, 1, 1, 0, 1, 59), None, None),
        (T(2024, 1, 1, 23, 59, 59), T(2024, 1, 2, 0, 0, 0), None, None),
        (T(2024, 1, 2), T(2024, 1, 1), None, None),
    ])
    c, s = F.col("c"), F.col("s")
    rows = df.select(minutes_between(c, s), seconds_between(c, s), lead_days(c, s)).collect()
    assert [tuple(r)[:2] for r in rows] == [(1, 1), (0, 59), (1, 1), (-1440, -86400)]
    assert rows[0][2] == 1 / 1440 and rows[3][2] is None


def test_result_does_not_depend_on_session_zone(spark):
    df = stamps(spark, [(T(2024, 3, 10, 1, 0), T(2024, 3, 10, 4, 0), None, None)])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # clocks change that night
    try:
        assert df.select(minutes_between(F.col("c"), F.col("s"))).first()[0] == 180
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_months_apart(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31), dt.date(2024, 1, 1))], "a date, b date")
    assert df.select(months_apart(F.col("a"), F.col("b"))).first()[0] == 1


def test_timeline_rules(spark):
    day = lambda n: T(2024, 1, n)
    df = stamps(spark, [
        (day(2), day(1), None, None),      # shipped before created
        (day(1), None, day(2), None),      # delivered, never shipped
        (day(1), day(3), day(2), None),    # delivered before shipped
        (day(1), day(2), None, day(4)),    # returned, never delivered
        (day(1), day(2), day(5), day(4)),  # returned before delivered
        (day(1), day(2), day(3), day(4)),
        (day(1), None, None, None),
        (None, None, None, None),
    ])
    flags = [r[0] for r in df.select(timeline_is_valid(*[F.col(x) for x in "csdr"])).collect()]
    assert flags == [0, 0, 0, 0, 0, 1, 1, 1]


def test_bands(spark):
    df = spark.createDataFrame([(24.99,), (25.0,), (49.99,), (50.0,), (199.99,), (200.0,), (None,)], "p double")
    edges, labels = (25, 50, 100, 200), ("a", "b", "c", "d", "e")
    assert [r[0] for r in df.select(band(F.col("p"), edges, labels, None)).collect()] == list("abbcdee")
    assert df.select(band(F.col("p"), edges, labels, "none")).collect()[-1][0] == "none"
    with pytest.raises(ValueError):
        band(F.col("p"), edges, labels[:-1], None)


def test_ratio_of_zero(spark):
    row = spark.range(1).select(ratio(F.lit(1), F.lit(0)), ratio(F.lit(0), F.lit(0)), ratio(F.lit(1), F.lit(4))).first()
    assert tuple(row) == (None, None, 0.25)
