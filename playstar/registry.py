"""Every operator as a named query over the generated tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstar.functions.moments import clock_key, date_key, epoch_timestamp, millis_of, second_of_day
from playstar.operators import quality
from playstar.operators.joins import left_join_in_ranges
from playstar.operators.windows import previous_in_group
from playstar.plans import analytics, lifecycle, star
from playstar.plans.calendar import dim_date, dim_time
from playstar.plans.folded import Facts
from playstar.plans.growing import GrowingDatabase
from playstar.plans.incremental import IncrementalStaging, new_files
from playstar.plans.warehouse import build_warehouse, warehouse
from playstar.schemas import LOG_MAPPING, PRIMARY_KEYS, SONG_MAPPING, natural_columns
from playstar.session import apply_settings, new_folder, store
from playstar.sources import testbed
from playstar.sources.csv_files import read_csv, write_csv
from playstar.sources.json_files import TooManyErrors, load_json, match_by_name
from playstar.sources.ledger import committed_files
from playstar.sources.listing import keys_with_prefix, list_files
from playstar.sources.manifest import generate_manifest, load_manifest, read_manifest, write_manifest
from playstar.streaming.file_stream import stream_new_files

Query = Callable[[SparkSession, str], DataFrame]

BUCKET = "bucket"
LOG_PREFIX = "log-data"
HEAD = 100
ONE_LOAD = 20240115

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under the name of its function, less the ``q_`` that
    keeps some of them apart from the operators they run."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(apply_settings(spark), sf_dir)

    QUERIES[build.__name__.removeprefix("q_")] = run
    return run


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    tables = warehouse(spark, sf_dir)
    return [tables[name] for name in names]


# Sources and sinks -----------------------------------------------------------


def _log_as_json(rows: DataFrame, path: str) -> None:
    """Activity files as they come: the user id is quoted."""
    rows.withColumn("userId", F.col("userId").cast("string")).write.json(path)


@query
def load_log_json(spark, sf_dir):
    """Log files by manifest."""
    folder, listed = new_folder(spark, "log-json"), new_folder(spark, "manifest")
    _log_as_json(testbed.song_log(spark, sf_dir), folder)
    write_manifest(list_files(spark, folder).where("length > 0"), "path", listed, max_entries=3)
    return load_manifest(spark, listed, LOG_MAPPING, new_folder(spark, "staged")).rows


@query
def load_manifest_auto(spark, sf_dir):
    """Song files by manifest, their keys matched with the column names."""
    folder, listed = new_folder(spark, "song-json"), new_folder(spark, "manifest")
    testbed.song_data(spark, sf_dir).write.json(folder)
    write_manifest(list_files(spark, folder).where("length > 0"), "path", listed)
    return load_manifest(spark, listed, SONG_MAPPING, new_folder(spark, "staged"), max_errors=100, by_name=True).rows


@query
def load_song_json(spark, sf_dir):
    folder = new_folder(spark, "song-json")
    testbed.song_data(spark, sf_dir).write.json(f"{folder}/song-data/A")
    return load_json(spark, folder, SONG_MAPPING, new_folder(spark, "staged"), max_errors=100).rows


@query
def load_song_json_by_name(spark, sf_dir):
    text = testbed.song_data(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    named = text.select(match_by_name(F.col("value"), SONG_MAPPING).alias("song")).select("song.*")
    return named.select([F.col(f.name).cast(f.dataType) for _, f in SONG_MAPPING.columns()])


@query
def load_json_maxerror(spark, sf_dir):
    """Records of the largest size are cut off in the middle; the budget is the
    tightest that still lets the load pass."""
    songs = testbed.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), "p_size")
    records = testbed.song_data(spark, sf_dir).select(
        F.expr("cast(substr(song_id, 3) as bigint)").alias("key"), F.to_json(F.struct("*")).alias("value")
    )
    cut = F.when(F.col("p_size") == 50, F.substring("value", 1, 20)).otherwise(F.col("value"))
    folder = new_folder(spark, "broken-json")
    records.join(songs, "key").select(cut.alias("value")).write.text(folder)
    n_cut = songs.where("p_size = 50").count()
    loaded = load_json(spark, folder, SONG_MAPPING, new_folder(spark, "staged"), max_errors=n_cut + 1)
    return loaded.rows.select("song_id", "title", "year", F.lit("loaded").alias("outcome")).unionByName(
        loaded.rejected.select("song_id", "title", "year", F.lit("rejected").alias("outcome"))
    )


def _busy_days(spark, sf_dir):
    """The date dimension over the days of all orders, with their number."""
    orders = testbed.table(spark, sf_dir, "orders")
    first, last = orders.agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    per_day = orders.groupBy(date_key(F.col("o_orderdate")).alias("date_key")).agg(F.count(F.lit(1)).alias("n_orders"))
    return dim_date(spark, first, last).join(per_day, "date_key", "left").na.fill(0, ["n_orders"])


def _busy_seconds(spark, sf_dir):
    """The time dimension with the number of events at each second of the day."""
    per_second = (
        testbed.table(spark, sf_dir, "events")
        .groupBy(second_of_day(F.col("ts")).alias("time_key"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )
    return dim_time(spark).join(per_second, "time_key", "left").na.fill(0, ["n_events"])


def _through_csv(spark, rows, line_breaks=False):
    folder = new_folder(spark, "csv")
    write_csv(rows, folder)
    return read_csv(spark, folder, rows.schema, line_breaks)


@query
def csv_roundtrip_dim_date(spark, sf_dir):
    return _through_csv(spark, _busy_days(spark, sf_dir))


@query
def csv_roundtrip_dim_time(spark, sf_dir):
    return _through_csv(spark, _busy_seconds(spark, sf_dir))


@query
def csv_roundtrip_documents(spark, sf_dir):
    """Texts with quotes, commas and line breaks."""
    return _through_csv(spark, testbed.table(spark, sf_dir, "documents"), line_breaks=True)


@query
def csv_roundtrip_pages(spark, sf_dir):
    return _through_csv(spark, testbed.table(spark, sf_dir, "pages"), line_breaks=True)


@query
def q_list_files(spark, sf_dir):
    """Folders of the log files in a bucket that also holds song files."""
    root = new_folder(spark, "bucket")
    day = F.to_date(epoch_timestamp(F.col("ts")))
    # Rebalancing keeps a day to few files without forcing it into one task.
    logs = testbed.song_log(spark, sf_dir).withColumn("day", day).hint("rebalance", "day")
    logs.write.partitionBy("day").json(f"{root}/{LOG_PREFIX}")
    testbed.song_data(spark, sf_dir).write.json(f"{root}/song-data")
    files = list_files(spark, root, f"{LOG_PREFIX}/")
    return files.where("length > 0").select(F.substring_index("key", "/", 2).alias("folder")).distinct()


@query
def list_keys_prefix(spark, sf_dir):
    return keys_with_prefix(testbed.table(spark, sf_dir, "pages").select("url"), "url", "https://")


@query
def list_keys_head(spark, sf_dir):
    return keys_with_prefix(testbed.table(spark, sf_dir, "pages").select("url"), "url", "https://", HEAD)


@query
def q_committed_files(spark, sf_dir):
    return committed_files(testbed.load_ledger(spark, sf_dir, BUCKET), LOG_PREFIX)


@query
def q_new_files(spark, sf_dir):
    ledger = testbed.load_ledger(spark, sf_dir, BUCKET)
    return new_files(testbed.log_keys(spark, sf_dir), BUCKET, ledger, LOG_PREFIX)


@query
def manifest_roundtrip(spark, sf_dir):
    folder = new_folder(spark, "manifest")
    write_manifest(testbed.table(spark, sf_dir, "pages"), "url", folder)
    return read_manifest(spark, folder)


@query
def q_generate_manifest(spark, sf_dir):
    """Files of days that no load has committed yet, with the days' folders."""
    root, target = new_folder(spark, "bucket"), new_folder(spark, "manifest")
    day = F.to_date(epoch_timestamp(F.col("ts")))
    logs = testbed.song_log(spark, sf_dir).withColumn("day", day).hint("rebalance", "day")
    logs.write.partitionBy("day").json(f"{root}/{LOG_PREFIX}")
    files = list_files(spark, root, f"{LOG_PREFIX}/")
    loaded = files.where(F.regexp_extract("key", r"day=\d+-\d+-(\d+)/", 1).cast("int") % 2 == 0)
    entries = generate_manifest(spark, root, f"{LOG_PREFIX}/", loaded.select(F.col("path").alias("filename")), target)
    return entries.select(F.regexp_extract("url", r"(day=[^/]+)/", 1).alias("folder"), "mandatory").distinct()


# Staging, dimensions, fact ---------------------------------------------------


@query
def staging_song_log(spark, sf_dir):
    (log,) = _tables(spark, sf_dir, "staging_song_log")
    return log.select(natural_columns("staging_song_log"))


@query
def staging_song_data(spark, sf_dir):
    (songs,) = _tables(spark, sf_dir, "staging_song_data")
    return songs.select(natural_columns("staging_song_data"))


@query
def dim_user(spark, sf_dir):
    return _tables(spark, sf_dir, "dim_user")[0]


@query
def dim_artist(spark, sf_dir):
    return _tables(spark, sf_dir, "dim_artist")[0]


@query
def dim_song(spark, sf_dir):
    return _tables(spark, sf_dir, "dim_song")[0]


@query
def dim_song_null_safe(spark, sf_dir):
    songs, artists = _tables(spark, sf_dir, "staging_song_data", "dim_artist")
    return star.song_rows(songs, artists, null_safe=True)


@query
def fact_songplay(spark, sf_dir):
    (fact,) = _tables(spark, sf_dir, "fact_songplay")
    return fact.select(natural_columns("fact_songplay"))


@query
def fact_songplay_deduped(spark, sf_dir):
    return star.songplay_rows_deduplicated(
        *_tables(spark, sf_dir, "staging_song_log", "dim_user", "dim_artist", "dim_song")
    )


@query
def q_dim_date(spark, sf_dir):
    return _busy_days(spark, sf_dir)


@query
def q_dim_time(spark, sf_dir):
    return _busy_seconds(spark, sf_dir)


@query
def epoch_to_keys(spark, sf_dir):
    events = testbed.table(spark, sf_dir, "events").select("event_id", millis_of(F.col("ts")).alias("ts"))
    started = epoch_timestamp(F.col("ts"))
    return events.select(
        "event_id",
        "ts",
        started.alias("start_datetime"),
        date_key(started).alias("start_date_key"),
        clock_key(started).alias("start_time_key"),
        second_of_day(started).alias("second_of_day"),
    )


# Reports -----------------------------------------------------------------------


@query
def table_counts(spark, sf_dir):
    return quality.table_counts(warehouse(spark, sf_dir))


@query
def plays_by_am_pm(spark, sf_dir):
    return analytics.plays_by_am_pm(*_tables(spark, sf_dir, "fact_songplay", "dim_time"))


@query
def plays_by_am_pm_fixed(spark, sf_dir):
    return analytics.plays_by_am_pm_fixed(*_tables(spark, sf_dir, "fact_songplay", "dim_time"))


@query
def plays_by_hour(spark, sf_dir):
    return analytics.plays_by_hour(*_tables(spark, sf_dir, "fact_songplay"))


@query
def song_artist_daytype_counts(spark, sf_dir):
    names = ("fact_songplay", "dim_artist", "dim_song", "dim_date")
    return analytics.song_artist_daytype_counts(*_tables(spark, sf_dir, *names))


@query
def top_song_by_daytype(spark, sf_dir):
    names = ("fact_songplay", "dim_artist", "dim_song", "dim_date")
    return analytics.top_song_by_daytype(*_tables(spark, sf_dir, *names))


@query
def songplay_filter_compare(spark, sf_dir):
    return analytics.songplay_filter_compare(*_tables(spark, sf_dir, "staging_song_log"))


@query
def null_profile_log(spark, sf_dir):
    return quality.null_profile(*_tables(spark, sf_dir, "staging_song_log"))


@query
def null_profile_fact(spark, sf_dir):
    return quality.null_profile(*_tables(spark, sf_dir, "fact_songplay"))


@query
def fk_orphans(spark, sf_dir):
    return quality.fk_orphans(warehouse(spark, sf_dir))


@query
def pk_duplicates(spark, sf_dir):
    """All tables under their keys, and users and log records under ids that repeat."""
    tables = warehouse(spark, sf_dir)
    by_id = {
        "dim_user by user_id": tables["dim_user"].select(F.col("user_id").alias("user_key")),
        "staging_song_log by sessionId": tables["staging_song_log"].select(F.col("sessionId").alias("song_log_id")),
    }
    return quality.pk_duplicates(tables).unionByName(
        quality.pk_duplicates(by_id, lambda name: PRIMARY_KEYS[name.split(" ")[0]])
    )


@query
def load_timing(spark, sf_dir):
    return analytics.load_timing(testbed.load_ledger(spark, sf_dir, BUCKET))


@query
def load_timing_of_one(spark, sf_dir):
    return analytics.load_timing_of(testbed.load_ledger(spark, sf_dir, BUCKET), ONE_LOAD)


@query
def load_gaps(spark, sf_dir):
    """Each commit with the time of the one before it in the same load."""
    ledger = testbed.load_ledger(spark, sf_dir, BUCKET)
    return previous_in_group(ledger, ["query"], ["curtime", "filename"], "curtime", "previous_time")


# Lifecycle and loads -------------------------------------------------------------


@contextmanager
def _own_database(spark):
    db = f"playstar_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{new_folder(spark, 'db')}'")
    try:
        yield db
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


@query
def insert_append(spark, sf_dir):
    """Paid users, then the others with their columns the other way round."""
    (users,) = _tables(spark, sf_dir, "dim_user")
    paid = F.col("user_level").eqNullSafe("paid")
    with _own_database(spark) as db:
        lifecycle.create_tables(spark, db)
        lifecycle.append(spark, db, "dim_user", users.where(paid))
        lifecycle.append(spark, db, "dim_user", users.where(~paid).select(*reversed(users.columns)))
        return store(spark.table(f"{db}.dim_user"), new_folder(spark, "appended"))


@query
def table_lifecycle(spark, sf_dir):
    """Table sizes after reset, refresh from JSON files, and truncate."""
    folder = new_folder(spark, "lifecycle")
    _log_as_json(testbed.song_log(spark, sf_dir), f"{folder}/log-data")
    testbed.song_data(spark, sf_dir).write.json(f"{folder}/song-data")

    def noted(step: str) -> DataFrame:
        sizes = lifecycle.counts(spark, db).withColumn("step", F.lit(step))
        return store(sizes, f"{folder}/{step}")

    with _own_database(spark) as db:
        lifecycle.reset(spark, db)
        after_reset = noted("reset")
        lifecycle.refresh_from_files(spark, db, f"{folder}/log-data", f"{folder}/song-data")
        after_refresh = noted("refresh")
        lifecycle.truncate_tables(spark, db)
        after_truncate = noted("truncate")
        lifecycle.drop_tables(spark, db)
    return after_reset.unionByName(after_refresh).unionByName(after_truncate)


def _arrivals(spark, sf_dir, source: str, load: Callable[[], None]) -> None:
    """Plays arrive first, other activity second; each time and once more, load."""
    log = testbed.song_log(spark, sf_dir)
    plays = F.col("page").eqNullSafe("NextSong")
    for wave, rows in (("first", log.where(plays)), ("second", log.where(~plays))):
        _log_as_json(rows, f"{source}/{wave}")
        load()
    load()


def _per_load(staging: IncrementalStaging) -> DataFrame:
    loads = staging.batches("staging_song_log").groupBy("load_batch")
    return loads.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("userId").alias("n_known_users"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


@query
def incremental_load(spark, sf_dir):
    source, root = new_folder(spark, "arriving"), new_folder(spark, "incremental")
    staging = IncrementalStaging(spark, root)
    _arrivals(spark, sf_dir, source, lambda: staging.load_new(source, LOG_MAPPING))
    return _per_load(staging)


@query
def incremental_stream(spark, sf_dir):
    source, root = new_folder(spark, "arriving"), new_folder(spark, "incremental")
    _arrivals(
        spark, sf_dir, source, lambda: stream_new_files(spark, source, LOG_MAPPING, root)
    )
    return _per_load(IncrementalStaging(spark, root))


def _song_lines(spark, sf_dir) -> DataFrame:
    """Song records as JSON text, with the number in their id: one of ten is cut off, one of seven has a word for its year."""
    number = F.regexp_extract("song_id", r"(\d+)$", 1).cast("bigint")
    songs = testbed.song_data(spark, sf_dir).withColumn("year", F.col("year").cast("string"))
    odd_year = F.when(number % 7 == 0, F.concat(F.lit("year "), "year")).otherwise(F.col("year"))
    text = songs.withColumn("year", odd_year).select(number.alias("number"), F.to_json(F.struct(*songs.columns)).alias("value"))
    return text.withColumn("value", F.when(F.col("number") % 10 == 0, F.substring("value", 1, 20)).otherwise(F.col("value")))


@query
def q_load_errors(spark, sf_dir):
    """What was wrong with each rejected record of a load, from the folder its file is in to the text."""
    source, root = new_folder(spark, "arriving"), new_folder(spark, "incremental")
    lines = _song_lines(spark, sf_dir).withColumn("part", F.col("number") % 4)
    lines.select("value", "part").write.partitionBy("part").text(source)
    staging = IncrementalStaging(spark, root)
    staging.load_new(source, SONG_MAPPING, max_errors=1 << 40)
    folder = F.regexp_extract("filename", r"/(part=\d+)/", 1).alias("folder")
    return staging.errors("staging_song_data").select(folder, "column", "value", "length", "reason")


@query
def load_timing_own(spark, sf_dir):
    """The timing of a load that this library has made itself, of one file for each of twenty groups of songs."""
    source, root = new_folder(spark, "arriving"), new_folder(spark, "incremental")
    songs = testbed.song_data(spark, sf_dir).withColumn("part", F.regexp_extract("song_id", r"(\d+)$", 1).cast("bigint") % 20)
    songs.repartition("part").write.partitionBy("part").json(source)
    staging = IncrementalStaging(spark, root)
    staging.load_new(source, SONG_MAPPING)
    ledger = staging.ledger.of_table("staging_song_data").withColumnRenamed("load_batch", "query")
    timing = analytics.load_timing(ledger)
    return timing.select("query", "processed_files", (F.col("avg_time_per_file") > 0).alias("takes_time"))


@contextmanager
def _grown(spark, sf_dir):
    """A database that has grown by two waves of files.

    Many plays of the first wave refer to songs, artists and user rows of the second, and some come again in it.
    """
    logs, songs, root = (new_folder(spark, name) for name in ("log-json", "song-json", "incremental"))
    log, catalogue = testbed.song_log(spark, sf_dir), testbed.song_data(spark, sf_dir)
    first_play = (F.col("ts") / 1000).cast("bigint") % 2 == 0
    first_song = F.crc32(F.col("song_id").cast("binary")) % 3 > 0
    again = F.col("ts") % 50 == 0
    waves = ((log.where(first_play), catalogue.where(first_song)), (log.where(~first_play | again), catalogue.where(~first_song)))
    staging = IncrementalStaging(spark, root)
    with _own_database(spark) as db:
        lifecycle.reset(spark, db)
        grown = GrowingDatabase(spark, db, staging)
        for wave, (plays, records) in enumerate(waves):
            _log_as_json(plays, f"{logs}/{wave}")
            staging.load_new(logs, LOG_MAPPING)
            records.write.json(f"{songs}/{wave}")
            staging.load_new(songs, SONG_MAPPING)
            grown.grow()
        yield grown


@query
def incremental_star(spark, sf_dir):
    """The tables of a grown database; plays with what they refer to, without keys."""
    with _grown(spark, sf_dir) as grown:
        tables, facts = lifecycle.tables_of(spark, grown.db), grown.facts().spread()
        # Users, artists and songs go to what multiplies the plays, so facts are made and written once, as the result.
        users = left_join_in_ranges(facts.users, tables["dim_user"], "user_key")
        pairs = left_join_in_ranges(facts.pairs, tables["dim_artist"], "artist_key")
        pairs = left_join_in_ranges(pairs, tables["dim_song"].select("song_key", "song_id", "song_title", "song_year"), "song_key")
        plays = Facts(facts.plays, users, pairs).rows()
        return store(plays.drop("songplay_key", "user_key", "artist_key", "song_key"), new_folder(spark, "grown"), packed=True)


@query
def report_incremental(spark, sf_dir):
    """Plays by day type, song and artist of a grown database, from the counts its batches have carried along."""
    with _grown(spark, sf_dir) as grown:
        return store(grown.reports()["song_artist_daytype_counts"], new_folder(spark, "report"))


@query
def checks_incremental(spark, sf_dir):
    """Orphans of a grown database's references, from the state its batches have carried along."""
    with _grown(spark, sf_dir) as grown:
        return store(grown.reports()["fk_orphans"], new_folder(spark, "report"))


@query
def incremental_errors(spark, sf_dir):
    """Broken records spread over several manifests, counted against one budget for the run.

    The tightest budget that lets them pass is used, and one less rejects the run before
    anything is committed.
    """
    source, root = new_folder(spark, "arriving"), new_folder(spark, "incremental")
    text = testbed.song_data(spark, sf_dir).select("song_id", F.to_json(F.struct("*")).alias("value"))
    number = F.regexp_extract("song_id", r"(\d+)$", 1).cast("bigint")
    broken = number % 10 == 0
    lines = text.select(F.when(broken, F.substring("value", 1, 20)).otherwise(F.col("value")).alias("value"))
    lines.repartition(4).write.text(source)
    n_broken = text.where(broken).count()
    staging = IncrementalStaging(spark, root)
    try:
        staging.load_new(source, SONG_MAPPING, max_errors=n_broken, max_files=1)
        rejected = False
    except TooManyErrors:
        rejected = staging.ledger.entries().isEmpty()
    staging.load_new(source, SONG_MAPPING, max_errors=n_broken + 1, max_files=1)
    return staging.rows("staging_song_data").select("song_id", F.lit(rejected).alias("tighter_rejected"))


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the warehouse anew, whatever has been built before, and answer the
    headline question: for timing and for the smoke check."""
    tables = build_warehouse(apply_settings(spark), sf_dir)
    return analytics.top_song_by_daytype(
        tables["fact_songplay"], tables["dim_artist"], tables["dim_song"], tables["dim_date"]
    )
