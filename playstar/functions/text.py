"""Text values: tolerant conversions, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StringType

WHITESPACE = " \t\n\r\x0b\x0c"


def strip(text: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def lenient_cast(text: Column, target: DataType) -> Column:
    """JSON text as a typed value: blank and unreadable text become NULL.

    Integers may come quoted, or as ``1540919166796.0``; the way over DECIMAL
    keeps all digits of a BIGINT. A value with a fraction is no integer.
    """
    if isinstance(target, StringType):
        return text
    if isinstance(target, (IntegerType, LongType)):
        number = strip(text).try_cast("decimal(38,18)")
        return F.when(number == F.floor(number), number).try_cast(target)
    return strip(text).try_cast(target)


def with_scheme(bucket: str, key: Column) -> Column:
    """``s3://bucket/key`` for a key inside ``bucket``."""
    return F.concat(F.lit(f"s3://{bucket}/"), key)
