"""New files as a stream: the checkpoint remembers what has been read, so nothing is subtracted.

The driver still lists the source and keeps the names it has seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playstar.plans.incremental import IncrementalStaging
from playstar.schemas import PathMapping
from playstar.sources.json_files import parse_json, with_source
from playstar.sources.manifest import MAX_ENTRIES

# Files count as new by their names alone, however old they are.
NO_AGE_LIMIT = "100000d"


def stream_new_files(
    spark: SparkSession,
    source: str,
    mapping: PathMapping,
    root: str,
    max_errors: int = 1,
    max_files: int = MAX_ENTRIES,
) -> int:
    """Load all files below ``source`` that are new since the last run; returns the number of loads.

    A micro-batch overwrites the folder of its own number, so one that is
    repeated after a failure is stored once. The error budget holds for the whole run: all its
    loads enter the ledger at its end, or none. Loads that were staged by a run
    that died or was rejected are pending: they count in the next run, which commits them if the budget then allows.
    A pending file that has been corrected since is read again, as length and time of every file are kept with its
    records, and one that is gone no longer counts. Use one root for either this form or the batch form.
    """
    staging = IncrementalStaging(spark, root)
    left_over = not staging.pending(mapping.table).isEmpty()

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(staging.load_folder(mapping.table, batch))

    reader = spark.readStream.option("maxFilesPerTrigger", max_files).option("maxFileAge", NO_AGE_LIMIT)
    parsed = with_source(parse_json(reader, source, mapping))
    query = (
        parsed.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{root}/checkpoints/{mapping.table}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if left_over:
        staging.repair_pending(source, mapping)
    return staging.commit_pending(mapping, max_errors)
