"""Which files are there."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstar.operators.sets import head
from playstar.session import exists

# Hidden files that writers leave beside their data; they hold none.
_MARKERS = re.compile(r"_SUCCESS|_temporary|_committed_.*|_started_.*|_spark_metadata|_delta_log|\..*\.crc")


class HiddenFiles(RuntimeError):
    """Names that Spark's readers pass over without a word."""


def keys_with_prefix(listing: DataFrame, key: str, prefix: str, limit: int | None = None) -> DataFrame:
    """Entries whose key starts with ``prefix``; the limit counts in key order."""
    return head(listing.where(F.col(key).startswith(prefix)), F.col(key), limit)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as its file system writes it, scheme included."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def hidden_files(spark: SparkSession, root: str) -> list[str]:
    """Files and folders below ``root`` whose names start with ``_`` or ``.``, writers' markers left out.

    One listing for each level of folders; only hidden names reach Python.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found, level = [], root.rstrip("/")
    while True:
        for status in system.globStatus(hadoop.Path(f"{level}/[_.]*")) or ():
            if not _MARKERS.fullmatch(status.getPath().getName()):
                found.append(status.getPath().toString())
        level += "/*"
        if not len(system.globStatus(hadoop.Path(level)) or ()):
            return found


def list_files(spark: SparkSession, root: str, prefix: str = "", limit: int | None = None) -> DataFrame:
    """(key, path, length, modified) of the files below ``root``.

    ``key`` is the path relative to ``root``. Only the folder that ``prefix`` names is
    listed. File contents are not read. Hidden files (`hidden_files`) raise, as
    Spark would neither list nor load them.
    """
    base = qualified(spark, root).rstrip("/")
    folder = f"{base}/{prefix.rpartition('/')[0]}".rstrip("/")
    if folder != base and not exists(spark, folder):
        return spark.createDataFrame([], "key string, path string, length bigint, modified timestamp")
    if hidden := hidden_files(spark, folder):
        raise HiddenFiles(f"{len(hidden)} hidden names below {folder}, as {hidden[:3]}; rename them or leave them out")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    listing = files.select(
        F.substring("path", len(base) + 2, 1 << 30).alias("key"), "path", "length", F.col("modificationTime").alias("modified")
    )
    return keys_with_prefix(listing, "key", prefix, limit)
