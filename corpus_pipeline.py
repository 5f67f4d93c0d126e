"""From raw documents to packed training sequences: quality, toxicity, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept; its result is written
as Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstar.llm import packing, quality, simhash, toxicity
from playstar.llm.common import free_name, session_of
from playstar.session import new_folder, store

#: A document goes if its quality score is below it: only where the classifiers are rather sure, so that clean ones stay.
LEAST_QUALITY = 0.3
#: A document goes if its toxicity score reaches it.
TOXIC = 0.7


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _where(docs: DataFrame, score: Column, holds: Callable[[Column], Column]) -> DataFrame:
    """The rows whose score holds, with their own columns; nothing is shuffled."""
    session_of(docs)
    name = free_name("_score", docs.columns)
    return docs.withColumn(name, score).where(holds(F.col(name))).drop(name)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the co-trained classifiers reject.

    Each row is judged by itself, rows without an id, with a null text or given twice like others; an empty table stays empty. Columns may have any names.
    """
    model = quality.train(docs, _labels(spark, sf_dir))
    found = quality.quality(F.col("text"), [F.col(c) for c in quality.METADATA], model)
    return _where(docs, found["score"], lambda score: score >= LEAST_QUALITY)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which the multiple-instance model finds an offending sentence.

    Each row is judged by itself; null and empty texts stay. An empty table stays empty. Columns may have any names.
    """
    model = toxicity.train(docs, _labels(spark, sf_dir))
    found = toxicity.toxicity(F.col("text"), model)
    return _where(docs, found["score"], lambda score: score < TOXIC)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates.

    Of rows with that id the one whose content has the smallest hash stays. Rows without an id form groups among themselves; a
    group stays, as one row, if no row with an id has its fingerprint.
    """
    mark = free_name("_mark", docs.columns)
    marked = docs.withColumn(mark, F.xxhash64(*docs.columns))
    found = simhash.near_duplicates(docs, shingle=3, max_distance=2)
    firsts = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    # What decides is settled on ids and hashes; texts only meet the result.
    chosen = marked.select("doc_id", mark).join(firsts, "doc_id").groupBy("doc_id").agg(F.min(mark).alias(mark))
    kept = marked.join(chosen, ["doc_id", mark], "left_semi").dropDuplicates(["doc_id", mark]).select(docs.columns)
    nameless = marked.where("doc_id is null")
    if nameless.isEmpty():
        return kept
    groups = simhash.near_duplicates(nameless.withColumn("doc_id", F.col(mark)), shingle=3, max_distance=2)
    taken = found.where("doc_id is not null").select("fingerprint").distinct()
    alone = groups.join(taken, "fingerprint", "left_anti").where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(mark))
    return kept.union(nameless.join(alone, mark, "left_semi").dropDuplicates([mark]).select(docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 4096 tokens.

    Null texts count as empty; rows without an id, or with one id, are packed each for itself. An empty table gives no pieces.
    """
    pieces = packing.pack(docs, size=4096, end_id=2)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality classifier", good_quality),
    ("toxicity", not_toxic),
    ("SimHash near-dedup", one_of_each_group),
    ("packing", packed),
]

#: SQL cannot train the classifiers or run the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), new_folder(spark, "stage"))
    return docs
