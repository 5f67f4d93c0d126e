"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstar.session import in_few_files, new_folder, store


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("mark")).first()
    return row["n"], row["mark"]


def connected_components(links: DataFrame, a: str, b: str, about: int | None = None) -> DataFrame:
    """Every linked id with the smallest id that it reaches: ``node``, ``component``.

    ``links`` holds two long columns; their order, repeats, nulls and loops do not
    matter. Ids without a link to another id are not in the result. ``about`` how many links there are, where that is known,
    decides in how many files they are first written.

    Each round connects larger neighbours to the smallest one (large star), then
    smaller ones to their smallest (small star), until all edges point at roots:
    O(log^2 n) rounds. Minima are taken before anything is joined, so a node with very
    many links is one row of a map-side aggregate and a skewed join that Spark splits. A
    round ends in a table in the shared folder; the driver sees a count and a checksum.
    """
    spark = links.sparkSession
    first = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).distinct()
    edges = store(first if about is None else in_few_files(first, about), new_folder(spark, "links"))
    before = _mark(edges)
    while before[0]:
        ends = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = ends.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = ends.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(small_low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct("u", F.col("low").alias("v")))).alias("e")
        )
        edges = store(in_few_files(small.select("e.*").where("u <> v").distinct(), before[0]), new_folder(spark, "links"))
        now = _mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
