"""Surrogate keys.

Two kinds are needed. Dimension keys are dense ranks in the order of the natural
columns: reproducible, and looked up by the fact. Fact and staging keys only have
to be unique, so they are drawn while the table is written and cost nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playstar.session import new_folder, store

# monotonically_increasing_id keeps the partition above bit 33 and the row
# position inside the partition below it.
_POSITION_BITS = 33


def ranked_keys(df: DataFrame, key: str, order_by: Sequence[str], first_key: int = 1) -> DataFrame:
    """Number rows ``first_key, first_key + 1, ...`` in the order of ``order_by``.

    The result equals ``row_number()`` over one global window (nulls first)
    without its single partition: rows are range-partitioned, each remembers its
    partition and its position there, and the sizes of all earlier partitions
    are added. The ranged rows are written before they are counted, because a
    second run of the range shuffle may draw other boundaries.
    """
    order = [F.col(name).asc_nulls_first() for name in order_by]
    slot = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", slot)
        .select(
            "*",
            F.shiftright("_slot", _POSITION_BITS).cast("int").alias("_part"),
            F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position"),
        )
        .drop("_slot")
    )
    placed = store(placed, new_folder(df.sparkSession, "ranked"))

    # One row per shuffle partition, whatever the size of the table.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    number = F.col("_offset") + F.col("_position") + F.lit(first_key)
    return placed.join(F.broadcast(offsets), "_part").select(number.cast("bigint").alias(key), *df.columns)


def arrival_keys(df: DataFrame, key: str, first_key: int = 1) -> DataFrame:
    """Number rows uniquely, with gaps, in the order tasks see them.

    The numbers are settled by the write that follows. Never read the frame
    twice without writing it.
    """
    number = F.monotonically_increasing_id() + F.lit(first_key)
    return df.select(number.alias(key), *df.columns)


def next_key(df: DataFrame, key: str) -> int:
    """The first unused key of a written table."""
    highest = df.agg(F.max(key)).first()[0]
    return 1 if highest is None else highest + 1


def extend_dimension(known: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Rows of ``candidates`` that ``known`` lacks, numbered after its last key.

    Rows are compared on all natural columns, NULL equal to NULL, so keys given
    once never change.
    """
    natural = [name for name in known.columns if name != key]
    same = [known[name].eqNullSafe(candidates[name]) for name in natural]
    fresh = candidates.select(natural).join(known, same, "left_anti").distinct()
    return ranked_keys(fresh, key, natural, first_key=next_key(known, key)).select(known.columns)
