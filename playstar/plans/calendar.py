"""Generated dimensions: every second of a day, every day of a range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstar.functions.moments import date_key

SECONDS_PER_DAY = 86_400

# The range the date dimension covers unless asked otherwise.
FIRST_DAY = dt.date(2015, 1, 1)
LAST_DAY = dt.date(2025, 12, 31)


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per second; ``time_key`` counts seconds since midnight."""
    second = F.col("id")
    hour = F.call_function("div", second, F.lit(3600))
    minute = F.call_function("div", second % 3600, F.lit(60))
    return spark.range(SECONDS_PER_DAY).select(
        second.cast("int").alias("time_key"),
        F.format_string("%02d:%02d:%02d", hour, minute, second % 60).alias("time_key_sql"),
        hour.cast("int").alias("hour"),
        minute.cast("int").alias("minute"),
        (second % 60).cast("int").alias("second"),
        F.when(hour < 12, "AM").otherwise("PM").alias("am_pm"),
    )


def dim_date(spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY) -> DataFrame:
    """One row per day, both ends included.

    ``week`` is the ISO week while ``year`` is the calendar year, so the first
    days of January may belong to week 52 or 53.
    """
    days = spark.range((last - first).days + 1)
    day = F.date_add(F.lit(first), F.col("id").cast("int"))
    return days.select(
        date_key(day).alias("date_key"),
        day.alias("date_key_sql"),
        F.weekofyear(day).alias("week"),
        F.date_format(day, "MMMM").alias("month"),
        F.year(day).alias("year"),
        F.when(F.weekday(day) < 5, "Weekday").otherwise("Weekend").alias("is_weekday"),
    )
