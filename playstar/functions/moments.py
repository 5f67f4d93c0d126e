"""Moments in time: epoch milliseconds to timestamps and calendar keys.

``TIMESTAMP`` without a zone is ``TIMESTAMP_NTZ`` here, so no result depends on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(millis: Column) -> Column:
    """Whole seconds; the milliseconds are cut off, not rounded."""
    return F.call_function("div", millis, F.lit(1000))


def epoch_timestamp(millis: Column) -> Column:
    """Epoch milliseconds as a timestamp of whole seconds."""
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return epoch + epoch_seconds(millis) * F.expr("INTERVAL '1' SECOND")


def date_key(moment: Column) -> Column:
    """YYYYMMDD as an integer. Works on dates and timestamps, and formats no text."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def clock_key(moment: Column) -> Column:
    """HHMMSS as an integer: 04:32:00 is 43200."""
    return F.hour(moment) * 10000 + F.minute(moment) * 100 + F.second(moment)


def second_of_day(moment: Column) -> Column:
    """Seconds since midnight: 04:32:00 is 16320."""
    return F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def micros_of(moment: Column) -> Column:
    """Microseconds since the epoch (the session runs in UTC)."""
    return F.unix_micros(moment.cast("timestamp"))


def millis_of(moment: Column) -> Column:
    """Milliseconds since the epoch; smaller parts are cut off."""
    return F.unix_millis(moment.cast("timestamp"))
