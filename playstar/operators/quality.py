"""Reports about tables: sizes, NULLs, key integrity."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstar.schemas import FOREIGN_KEYS, PRIMARY_KEYS


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count); a count reads no column."""
    return _stack(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
         for name, df in tables.items()]
    )


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for all columns, from one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")


def pk_duplicates(tables: dict[str, DataFrame], key_of: Callable[[str], str] = PRIMARY_KEYS.__getitem__) -> DataFrame:
    """(table_name, duplicate_keys): key values that occur more than once."""
    reports = []
    for name, df in tables.items():
        repeated = df.groupBy(key_of(name)).count().where("count > 1")
        reports.append(
            repeated.agg(F.count(F.lit(1)).alias("duplicate_keys")).select(F.lit(name).alias("table_name"), "duplicate_keys")
        )
    return _stack(reports)


def fk_orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, orphan_rows): rows whose key the parent lacks.

    A NULL reference is no orphan. Each link scans one column of the child and
    counts its values before they meet the parent, so a hot key is one row by
    the time it is joined.
    """
    reports = []
    for child, column, parent in FOREIGN_KEYS:
        used = tables[child].where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).count()
        known = tables[parent].select(F.col(PRIMARY_KEYS[parent]).alias("key"))
        orphans = used.join(known, "key", "left_anti").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("orphan_rows"))
        reports.append(orphans.select(F.lit(child).alias("table_name"), F.lit(column).alias("column_name"), "orphan_rows"))
    return _stack(reports)
