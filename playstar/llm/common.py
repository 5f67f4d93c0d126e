"""Helpers of the operators: vocabulary files, and groups of a sorted partition."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playstar.session import new_folder, store

#: Most crowded keys that are broadcast; beyond it they are joined by a shuffle.
HOT_KEYS = 100_000

_shipped: set[str] = set()


def session_of(df: DataFrame) -> SparkSession:
    """The frame's session, with this package sent to its Python workers (once per application)."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).parent.parent
        folder = tempfile.mkdtemp(prefix="playstar-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        target = os.path.join(folder, "playstar.zip")
        with zipfile.ZipFile(target, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(target)
        _shipped.add(app)
    return spark


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; the package lies on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in short runs, so that Python holds few texts at once."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def free_name(name: str, taken: list[str]) -> str:
    """A column name that is not among those taken."""
    while name.lower() in {other.lower() for other in taken}:
        name += "_"
    return name


def extended(rows: DataFrame, more: str) -> StructType:
    """The schema of ``rows`` and further fields."""
    return StructType(rows.schema.fields + StructType.fromDDL(more).fields)


def bounded_cells(rows: DataFrame, keys: list[str], member: str, limit: int) -> DataFrame:
    """Deal the rows of a key out to cells of about ``2 * limit`` rows in which all its pairs still meet.

    A key with more than ``limit`` rows is split into s blocks, and each row goes to
    the s cells that pair its block with a block of the key. Adds ``lo``, ``hi`` (the
    blocks of the cell) and ``block`` (the row's own). In a cell with ``lo < hi`` only pairs
    of different blocks are new; a cell with ``lo = hi`` has the pairs of one block.
    """
    hot = store(
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows_of_key"))
        .where(F.col("rows_of_key") > limit)
        .select(*keys, F.ceil(F.col("rows_of_key") / limit).cast("int").alias("splits")),
        new_folder(rows.sparkSession, "hot"),
    )
    if hot.count() <= HOT_KEYS:
        hot = F.broadcast(hot)
    splits = F.coalesce("splits", F.lit(1))
    return (
        rows.join(hot, keys, "left")
        .withColumn("block", F.pmod(F.xxhash64(member), splits).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), splits - 1)))
        .withColumn("lo", F.least("block", "other").cast("int"))
        .withColumn("hi", F.greatest("block", "other").cast("int"))
        .drop("splits", "other")
    )


def by_group(cells: DataFrame, keys: list[str], handle: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Run ``handle`` on the rows of every value of ``keys`` that has at least two rows.

    The partition is sorted and read as a stream: memory holds one batch and one group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, keys):
            out = handle(group)
            if out is not None and out.num_rows:
                yield out

    return cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 2) -> Iterator[pa.Table]:
    """Tables of equal keys from sorted batches; groups of fewer than ``least`` rows are left out."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None and held.num_rows:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        columns = [table.column(key).to_numpy() for key in keys]
        changed = np.zeros(table.num_rows, bool)
        for column in columns:
            changed[1:] |= column[1:] != column[:-1]
        starts = np.concatenate(([0], np.flatnonzero(changed)))
        ends = np.append(starts[1:], table.num_rows)
        for k in np.flatnonzero(ends[:-1] - starts[:-1] >= least):
            yield table.slice(starts[k], ends[k] - starts[k])
        held = table.slice(starts[-1])
    if held is not None and held.num_rows >= least:
        yield held


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted batches as tables that end where a group ends: many small groups at a time. Memory holds a batch and a group."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        last = np.ones(table.num_rows, bool)
        for column in (table.column(key).to_numpy() for key in keys):
            last &= column == column[-1]
        start = table.num_rows - int(last.sum())
        if start:
            yield table.slice(0, start)
        held = table.slice(start)
    if held is not None:
        yield held


def spanning_edges(ids: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among ``ids`` (as index pairs) reduced to an edge from each linked id to the smallest of its set."""
    order = np.argsort(ids, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(ids))
    a, b = place[left], place[right]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if np.array_equal(new, root):
            break
        root = new
    member = np.flatnonzero(root != np.arange(len(ids)))
    return ids[order[member]], ids[order[root[member]]]
