"""CSV with a header line, quoted as RFC 4180 has it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# What an unquoted empty value stands for while it is read.
_NOTHING = "\x00NULL"
# A quote inside a quoted value is doubled; there is no other escape.
_QUOTES = {"quote": '"', "escape": '"', "header": True}


def write_csv(df: DataFrame, path: str) -> None:
    """Values as they are: white space at their ends is kept, and an empty text is told from NULL."""
    df.write.mode("overwrite").options(**_QUOTES, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType, line_breaks: bool = False) -> DataFrame:
    """Columns by position, the header line of every file skipped. An empty text is told from NULL by its quotes.

    ``line_breaks``: values may hold line breaks. A file is then read by one task,
    so write such data in files of moderate size.
    """
    return spark.read.schema(schema).options(**_QUOTES, nullValue=_NOTHING, mode="FAILFAST", multiLine=line_breaks).csv(path)
