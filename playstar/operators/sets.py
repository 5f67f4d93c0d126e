"""Set operations on file lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def difference(listed: DataFrame, committed: DataFrame) -> DataFrame:
    """Rows of ``listed`` that are not in ``committed``, each once."""
    return listed.subtract(committed)


def head(df: DataFrame, order_by: Column, limit: int | None) -> DataFrame:
    """The first ``limit`` rows in order; None and 0 mean all rows, unsorted."""
    return df.orderBy(order_by).limit(limit) if limit else df
