"""The warehouse over the generated tables, built once per session and input state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstar.plans.calendar import dim_date, dim_time
from playstar.plans.star import build_star, conform, parquet_sink, stage
from playstar.session import new_folder, together
from playstar.sources import testbed
from playstar.sources.listing import list_files

_built: dict[tuple, dict[str, DataFrame]] = {}


def build_warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Stage the inputs and write all eight tables to a new folder."""
    sink = parquet_sink(new_folder(spark, "warehouse"))
    log, songs, times, dates = together(
        lambda: sink("staging_song_log", stage(testbed.song_log(spark, sf_dir), "staging_song_log")),
        lambda: sink("staging_song_data", stage(testbed.song_data(spark, sf_dir), "staging_song_data")),
        lambda: sink("dim_time", conform(dim_time(spark), "dim_time")),
        lambda: sink("dim_date", conform(dim_date(spark), "dim_date")),
    )
    return {
        "staging_song_log": log,
        "staging_song_data": songs,
        "dim_time": times,
        "dim_date": dates,
        **build_star(log, songs, sink),
    }


def warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables reports read. They are built by the first report that asks and
    again when a file of ``sf_dir`` has changed; later reports only read them."""
    state = (
        list_files(spark, sf_dir).agg(F.bit_xor(F.xxhash64("path", "length", "modified")), F.count(F.lit(1))).first()
    )
    key = (spark.sparkContext.applicationId, sf_dir, *state)
    if key not in _built:
        _built[key] = build_warehouse(spark, sf_dir)
    return _built[key]
