"""Expressions against plain Python."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType

from playstar.functions.moments import clock_key, date_key, epoch_seconds, epoch_timestamp, second_of_day
from playstar.functions.text import lenient_cast, strip
from playstar.plans.calendar import dim_date, dim_time

EPOCH = dt.datetime(1970, 1, 1)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 4_000_000_000_000), min_size=1, max_size=200))
def test_epoch_to_keys(spark, millis):
    ts = epoch_timestamp(F.col("ms"))
    rows = (
        spark.createDataFrame([(m,) for m in millis], "ms bigint")
        .select("ms", ts.alias("t"), date_key(ts).alias("d"), clock_key(ts).alias("c"), second_of_day(ts).alias("s"))
        .collect()
    )
    for row in rows:
        moment = EPOCH + dt.timedelta(seconds=row.ms // 1000)
        assert row.t == moment
        assert row.d == int(moment.strftime("%Y%m%d"))
        assert row.c == int(moment.strftime("%H%M%S"))
        assert row.s == moment.hour * 3600 + moment.minute * 60 + moment.second


def test_milliseconds_are_cut_and_division_goes_to_zero(spark):
    rows = spark.createDataFrame([(5999,), (-1500,), (None,)], "ms bigint").select(epoch_seconds(F.col("ms"))).collect()
    assert [row[0] for row in rows] == [5, -1, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_keys_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 on the night New York skips that hour.
        ts = epoch_timestamp(F.lit(1710037800000))
        row = spark.range(1).select(ts, date_key(ts), clock_key(ts)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (dt.datetime(2024, 3, 10, 2, 30), 20240310, 23000)


@pytest.mark.parametrize(
    ("text", "target", "value"),
    [
        ("7", IntegerType(), 7),
        (" 8 ", IntegerType(), 8),
        ("", IntegerType(), None),
        ("abc", IntegerType(), None),
        ("1999.9", IntegerType(), None),
        ("0.0000001", LongType(), None),
        ("2001.0", IntegerType(), 2001),
        ("-7", LongType(), -7),
        ("99999999999", IntegerType(), None),
        ("1540919166796.0", LongType(), 1540919166796),
        ("9223372036854775807", LongType(), 9223372036854775807),
        ("-3.5", DoubleType(), -3.5),
        (None, DoubleType(), None),
    ],
)
def test_lenient_cast(spark, text, target, value):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(lenient_cast(F.col("x"), target)).first()[0] == value


def test_strip_takes_all_white_space(spark):
    df = spark.createDataFrame([(" \t name one \r\n",)], "x string")
    assert df.select(strip(F.col("x"))).first()[0] == "name one"


def test_dim_time(spark):
    rows = {row.time_key: row for row in dim_time(spark).collect()}
    assert sorted(rows) == list(range(86_400))
    assert tuple(rows[0]) == (0, "00:00:00", 0, 0, 0, "AM")
    assert tuple(rows[43_199]) == (43_199, "11:59:59", 11, 59, 59, "AM")
    assert tuple(rows[43_200]) == (43_200, "12:00:00", 12, 0, 0, "PM")
    assert tuple(rows[86_399]) == (86_399, "23:59:59", 23, 59, 59, "PM")


def test_dim_date(spark):
    rows = {row.date_key: row for row in dim_date(spark).collect()}
    assert len(rows) == 4018
    day = dt.date(2015, 1, 1)
    while day <= dt.date(2025, 12, 31):
        row = rows[int(day.strftime("%Y%m%d"))]
        expected = (day, day.isocalendar().week, day.strftime("%B"), day.year)
        assert (row.date_key_sql, row.week, row.month, row.year) == expected
        assert row.is_weekday == ("Weekday" if day.weekday() < 5 else "Weekend")
        day += dt.timedelta(days=1)
    # The ISO week belongs to the year before, the year does not.
    assert (rows[20160101].week, rows[20160101].year) == (53, 2016)
