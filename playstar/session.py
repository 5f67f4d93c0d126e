"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Runtime settings every plan of this package counts on. Sizes and partition
# numbers are left to whoever owns the cluster.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot user or a hot song must be split even where the split costs one more
    # shuffle for the DISTINCT behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows go to the folders of their months as they come; beyond these a task sorts them first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def build_session(app_name: str = "playstar", **settings: str) -> SparkSession:
    """A session with this package's settings; extra settings win."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else has made."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: How tables with many rows for each play are written: rows of a play lie together and repeat each other, or differ by one.
PACKED = {"compression": "zstd", "parquet.writer.version": "v2", "parquet.page.row.count.limit": "1000000"}

_local_folders: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster another machine could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        folder = tempfile.mkdtemp(prefix="playstar-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[app] = folder
    return _local_folders[app]


def _scratch(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/playstar/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return f"{_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has put below the shared folder. Frames that
    have not been written elsewhere are lost."""
    delete(spark, _scratch(spark))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return [status.getPath().getName() for status in found if status.isDirectory()]


#: Rows of small values, like ids and hashes, that make a file worth writing.
ROWS_A_FILE = 100_000


def in_few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows of small values, in no more partitions than these need.

    Every file that a task writes has its price, on a local folder several processes that the executor starts to set its
    permissions. What is above the last shuffle of ``df`` keeps its partitions.
    """
    return df.coalesce(max(1, -(-rows // ROWS_A_FILE)))


def store(df: DataFrame, path: str, packed: bool = False) -> DataFrame:
    """Write ``df`` as Parquet and return a frame that reads it back.

    This cuts the lineage: a lost executor costs a re-read and never another
    run of what is above, so values fixed by the write (keys) stay fixed.
    """
    df.write.mode("overwrite").options(**(PACKED if packed else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(*steps: Callable[[], T]) -> list[T]:
    """Run independent steps side by side: the tail of one leaves room for the next."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [step.result() for step in [pool.submit(step) for step in steps]]


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder; none if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(folder) if status.isFile()] if system.exists(folder) else []


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that nobody has written yet; false if it is there already.

    It gets its name when it is complete, so readers never find a part of it.
    """
    target, upcoming = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.{uuid.uuid4().hex}.tmp"))
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(upcoming, False)
    out.write(text.encode())
    out.close()
    done = not system.exists(target) and system.rename(upcoming, target)
    if not done:
        system.delete(upcoming, False)
    return done
