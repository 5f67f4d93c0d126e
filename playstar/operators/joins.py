"""Joins that stay within bounds when one key holds most rows of either side."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstar.session import new_folder, store

#: Rows of a dimension that are broadcast at once.
RANGE_ROWS = 500_000


def left_join_in_blocks(left: DataFrame, right: DataFrame, on: Mapping[str, str], spread_by: str, block_rows: int) -> DataFrame:
    """``left LEFT JOIN right`` where the columns of ``on`` (left name to right name) are equal.

    Adaptive execution splits a hot key of a left join on its left side only; all rows of the key on the right
    are read by each of those tasks. Here the right rows of a key with more than ``block_rows`` are dealt to blocks
    by the hash of ``spread_by``, and the left rows of that key go to each block, so a key is a grid: blocks
    on the right, what Spark splits on the left. Such a left row has a match in some block, so the blocks where it finds none
    give nothing. Other keys are one block and join as ever.

    There is at most one heavy key for each ``block_rows`` rows of the right side; these few are broadcast. Nulls match nothing;
    repeated rows on either side are rows of their own. Both sides' columns are returned, under names of their own.
    """
    names = [f"_key{i}" for i in range(len(on))]
    heavy = F.broadcast(
        right.groupBy(*[F.col(r).alias(name) for name, r in zip(names, on.values(), strict=True)])
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > block_rows)
        .select(*names, F.ceil(F.col("_rows") / block_rows).cast("int").alias("_splits"))
    )

    def marked(side: DataFrame, keys: list[str], splits: str) -> DataFrame:
        return side.join(heavy, _equal(keys, names), "left").drop(*names).withColumnRenamed("_splits", splits)

    grid = marked(left, list(on), "_copies").withColumn("_to", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)))
    dealt = (
        marked(right, list(on.values()), "_blocks")
        .withColumn("_block", F.pmod(F.xxhash64(spread_by), F.coalesce("_blocks", F.lit(1))).cast("int"))
        .withColumn("_found", F.lit(True))
        .drop("_blocks")
    )
    joined = grid.join(dealt, _equal([*on, "_to"], [*on.values(), "_block"]), "left")
    return joined.where(F.col("_copies").isNull() | F.col("_found").isNotNull()).drop("_copies", "_to", "_block", "_found")


def left_join_in_ranges(left: DataFrame, right: DataFrame, key: str, range_rows: int | None = None) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` for a dimension under dense unique whole-number keys, without moving ``left``.

    Where ``left`` is many times as large as ``right``, moving it is what costs. Ranges of ``range_rows`` keys are broadcast one after the other,
    each to the rows of ``left`` that refer to it, and written; a dimension of one range is simply broadcast. Rows without a key or with
    one outside of all ranges are a part of their own. Parquet's own statistics let a range pass over what it has no rows in.
    """
    range_rows = range_rows or RANGE_ROWS
    low, high = right.agg(F.min(key), F.max(key)).first()
    if low is None or high - low < range_rows:
        return left.join(F.broadcast(right), key, "left")
    spark, joined = left.sparkSession, []
    for first in range(low, high + 1, range_rows):
        mine = F.col(key).between(first, min(first + range_rows - 1, high))
        part = left.where(mine).join(F.broadcast(right.where(mine)), key, "left")
        joined.append(store(part, new_folder(spark, "range"), packed=True))
    outside = left.where(F.col(key).isNull() | (F.col(key) < low) | (F.col(key) > high))
    joined.append(outside.join(F.broadcast(right.limit(0)), key, "left"))
    return reduce(DataFrame.unionByName, joined)


def _equal(left: list[str], right: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(a) == F.col(b) for a, b in zip(left, right, strict=True)])
