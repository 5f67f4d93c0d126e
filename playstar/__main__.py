"""Command line: ``python -m playstar reset etl report --db plays --log DIR --songs DIR``.

Steps run in the order given, in one session. To keep tables between runs, give
the session a catalog that persists (as ``spark.sql.catalogImplementation=hive``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from playstar.plans import lifecycle
from playstar.plans.growing import GrowingDatabase
from playstar.plans.incremental import IncrementalStaging
from playstar.plans.report import print_report
from playstar.schemas import LOG_MAPPING, SONG_MAPPING, PathMapping
from playstar.session import build_session, clear_scratch
from playstar.sources.json_files import named_like_columns, read_mapping
from playstar.sources.listing import list_files

BY_NAME = "auto"
STEPS = ("list", "reset", "etl", "incremental", "extend", "report")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="playstar", description=__doc__)
    parser.add_argument("steps", nargs="+", choices=STEPS)
    parser.add_argument("--db", default="playstar")
    parser.add_argument("--log", help="folder of activity log files")
    parser.add_argument("--songs", help="folder of song record files")
    parser.add_argument("--staging", help="root folder of incremental staging")
    parser.add_argument("--log-paths", help=f"file of JSON paths for log records, or {BY_NAME}: keys are named like the columns")
    parser.add_argument("--song-paths", help="the same for song records")
    parser.add_argument("--song-errors", type=int, default=100, help="bad song records that fail the load")
    options = parser.parse_args(arguments)
    needs = {"list": ("log", "songs"), "etl": ("log", "songs"), "incremental": ("log", "songs", "staging"), "extend": ("log", "songs", "staging")}
    for step in options.steps:
        missing = [f"--{name}" for name in needs.get(step, ()) if getattr(options, name) is None]
        if missing:
            parser.error(f"{step} needs {' and '.join(missing)}")

    borrowed = SparkSession.getActiveSession() is not None
    spark = build_session()
    try:
        for step in options.steps:
            run(spark, step, options)
    finally:
        if not borrowed:
            clear_scratch(spark)
            spark.stop()


def chosen(spark: SparkSession, paths: str | None, usual: PathMapping) -> tuple[PathMapping, bool]:
    """The mapping of a path file, or the usual one; and whether keys are matched with column names instead."""
    if paths is None or paths == BY_NAME:
        return usual, paths == BY_NAME
    return read_mapping(spark, usual.table, paths), False


def run(spark: SparkSession, step: str, options: argparse.Namespace) -> None:
    log_mapping, log_by_name = chosen(spark, options.log_paths, LOG_MAPPING)
    song_mapping, song_by_name = chosen(spark, options.song_paths, SONG_MAPPING)
    if step == "list":
        for folder in (options.log, options.songs):
            print(f"{list_files(spark, folder).count()} files below {folder}")
    elif step == "reset":
        lifecycle.reset(spark, options.db)
    elif step == "etl":
        mappings = [
            named_like_columns(mapping) if by_name else mapping
            for mapping, by_name in ((log_mapping, log_by_name), (song_mapping, song_by_name))
        ]
        lifecycle.refresh_from_files(spark, options.db, options.log, options.songs, song_errors=options.song_errors, mappings=mappings)
    elif step in ("incremental", "extend"):
        staging = IncrementalStaging(spark, options.staging)
        staging.load_new(options.log, log_mapping, by_name=log_by_name)
        staging.load_new(options.songs, song_mapping, max_errors=options.song_errors, by_name=song_by_name)
        if step == "extend":
            print(f"{GrowingDatabase(spark, options.db, staging).grow()} new versions of {options.db}")
        else:
            lifecycle.refresh(spark, options.db, staging.rows("staging_song_log"), staging.rows("staging_song_data"))
    elif step == "report":
        grown = GrowingDatabase(spark, options.db, IncrementalStaging(spark, options.staging)) if options.staging else None
        print_report(lifecycle.tables_of(spark, options.db), grown.reports() if grown and grown.numbers() else None)


if __name__ == "__main__":
    main()
