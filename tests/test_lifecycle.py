"""Tables of a database, full refresh, incremental loads."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from playstar.__main__ import main
from playstar.plans import incremental, lifecycle, star
from playstar.plans.analytics import load_timing
from playstar.plans.extend import extend_star
from playstar.plans.incremental import IncrementalStaging, new_files
from playstar.plans.report import report
from playstar.schemas import LOG_MAPPING, SONG_MAPPING, STAGING_TABLES, STAR_TABLES, natural_columns
from playstar.session import child_folders
from playstar.sources.json_files import TooManyErrors, parse_json
from playstar.streaming.file_stream import stream_new_files
from tests.samples import SONGS, play, write_lines


@pytest.fixture
def db(spark):
    name = f"t_{uuid.uuid4().hex}"
    lifecycle.reset(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def inputs(tmp_path):
    write_lines(tmp_path / "songs" / "s.json", SONGS)
    write_lines(tmp_path / "log" / "2018" / "a.json", [play(itemInSession=i) for i in range(5)])
    return str(tmp_path / "log"), str(tmp_path / "songs")


def sizes(spark, db):
    return {r.table_name: r.row_count for r in lifecycle.counts(spark, db).collect()}


def content(spark, db):
    """All tables without the keys that are drawn while writing."""
    return {
        t: sorted(map(str, spark.table(f"{db}.{t}").select(natural_columns(t)).collect())) for t in lifecycle.CREATE_ORDER
    }


def test_reset_fills_only_the_calendars(spark, db):
    assert sizes(spark, db) == {
        **dict.fromkeys((*STAGING_TABLES, *STAR_TABLES), 0), "dim_time": 86_400, "dim_date": 4018,
    }
    lifecycle.create_tables(spark, db)
    assert sizes(spark, db)["dim_date"] == 4018


def test_refresh_twice_gives_the_same_tables(spark, db, inputs):
    lifecycle.refresh_from_files(spark, db, *inputs)
    once = content(spark, db)
    assert sizes(spark, db) | {"dim_time": 0, "dim_date": 0} == {
        "staging_song_log": 5, "staging_song_data": 4, "dim_time": 0, "dim_date": 0,
        "dim_user": 1, "dim_artist": 4, "dim_song": 4, "fact_songplay": 5,
    }
    lifecycle.refresh_from_files(spark, db, *inputs)
    assert content(spark, db) == once
    answers = report(lifecycle.tables_of(spark, db))
    assert answers["top_song_by_daytype"].first().song_title == "Don't Wait (For Me)"
    lifecycle.truncate_tables(spark, db)
    assert sizes(spark, db)["fact_songplay"] == 0 and sizes(spark, db)["dim_time"] == 86_400


def test_failed_refresh_leaves_the_tables_alone(spark, db, inputs, tmp_path):
    lifecycle.refresh_from_files(spark, db, *inputs)
    before = content(spark, db)
    write_lines(tmp_path / "log" / "2019" / "b.json", [play(), "{broken"])
    with pytest.raises(TooManyErrors):
        lifecycle.refresh_from_files(spark, db, *inputs)
    assert content(spark, db) == before
    lifecycle.refresh_from_files(spark, db, *inputs, log_errors=2)
    assert sizes(spark, db)["staging_song_log"] == 6


def test_append_goes_by_name(spark, db):
    rows = spark.createDataFrame([("free", 1, "F", "Ada", "Day", 7)],
        "user_level string, user_key int, user_gender string, user_first_name string, user_last_name string, user_id int")
    lifecycle.append(spark, db, "dim_user", rows)
    assert tuple(spark.table(f"{db}.dim_user").first()) == (1, 7, "Ada", "Day", "F", "free")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        lifecycle.append(spark, db, "dim_user", rows.replace("F", "female"))


def test_new_files(spark):
    keys = spark.createDataFrame([("log-data/1",), ("log-data/2",), ("log-data/2",), ("song-data/3",)], "key string")
    ledger = spark.createDataFrame([("s3://b/log-data/1   ",)], "filename string")
    assert [r.filename for r in new_files(keys, "b", ledger, "log-data").collect()] == ["s3://b/log-data/2"]


def test_incremental_load_takes_only_new_files(spark, tmp_path, folder):
    staging = IncrementalStaging(spark, folder("root"))
    assert staging.rows("staging_song_log").count() == 0
    for i in range(3):
        write_lines(tmp_path / "log" / f"{i}.json", [play(itemInSession=i)])
    assert staging.load_new(folder("log"), LOG_MAPPING, max_files=2) == 2
    assert staging.load_new(folder("log"), LOG_MAPPING) == 0
    write_lines(tmp_path / "log" / "late.json", [play(itemInSession=9), "bad"])
    with pytest.raises(TooManyErrors):
        staging.load_new(folder("log"), LOG_MAPPING)
    # What the failed load has written does not count, and the file is still new.
    items = lambda: sorted(r.itemInSession for r in staging.rows("staging_song_log").collect())
    assert items() == [0, 1, 2]
    assert staging.load_new(folder("log"), LOG_MAPPING, max_errors=2) == 1
    assert items() == [0, 1, 2, 9]
    assert staging.ledger.of_table("staging_song_log").count() == 4


def test_incremental_loads_and_one_full_load_end_in_the_same_star(spark, db, inputs, tmp_path, folder):
    log, songs = inputs
    staging = IncrementalStaging(spark, folder("root"))
    staging.load_new(songs, SONG_MAPPING)
    staging.load_new(log, LOG_MAPPING)
    write_lines(tmp_path / "log" / "2019" / "b.json", [play(userId="8", level="paid"), play(userId="8")])
    staging.load_new(log, LOG_MAPPING)
    lifecycle.refresh(spark, db, staging.rows("staging_song_log"), staging.rows("staging_song_data"))
    step_by_step = content(spark, db)
    lifecycle.refresh_from_files(spark, db, log, songs)
    assert content(spark, db) == step_by_step


def test_stream_takes_only_new_files(spark, tmp_path, folder):
    staging = IncrementalStaging(spark, folder("root"))
    run = lambda **k: stream_new_files(spark, folder("log"), LOG_MAPPING, folder("root"), **k)
    items = lambda: sorted(r.itemInSession for r in staging.rows("staging_song_log").collect())
    for i in range(3):
        write_lines(tmp_path / "log" / f"{i}.json", [play(itemInSession=i)])
    run(max_files=2)
    assert items() == [0, 1, 2]
    assert staging.ledger.next_batch("staging_song_log") == 2
    run()
    assert items() == [0, 1, 2]
    write_lines(tmp_path / "log" / "late.json", [play(itemInSession=9), "bad"])
    with pytest.raises(TooManyErrors):
        run()
    assert items() == [0, 1, 2]
    run(max_errors=2)
    assert items() == [0, 1, 2, 9]


@pytest.mark.parametrize("form", ["batch", "stream"])
@pytest.mark.parametrize("max_files", [1, 10])
def test_late_files_and_budget_do_not_depend_on_the_number_of_loads(spark, tmp_path, folder, form, max_files):
    staging = IncrementalStaging(spark, folder("root"))

    def run(max_errors):
        if form == "batch":
            return staging.load_new(folder("log"), LOG_MAPPING, max_errors=max_errors, max_files=max_files)
        return stream_new_files(spark, folder("log"), LOG_MAPPING, folder("root"), max_errors=max_errors, max_files=max_files)

    items = lambda: sorted(r.itemInSession for r in staging.rows("staging_song_log").collect())
    write_lines(tmp_path / "log" / "0.json", [play(itemInSession=0)])
    run(1)
    for i in range(1, 5):
        path = tmp_path / "log" / f"{i}.json"
        write_lines(path, [play(itemInSession=i), "bad"])
        old = path.stat().st_mtime - 10 * 86400
        os.utime(path, (old, old))
    with pytest.raises(TooManyErrors):
        run(4)
    assert items() == [0]
    run(5)
    assert items() == [0, 1, 2, 3, 4]


def test_command_line(spark, inputs, folder, capsys):
    log, songs = inputs
    name = f"t_{uuid.uuid4().hex}"
    main(["list", "reset", "etl", "report", "--db", name, "--log", log, "--songs", songs])
    shown = capsys.readouterr().out
    assert "1 files below" in shown and "Don't Wait (For Me)" in shown
    full = content(spark, name)
    main(["reset", "incremental", "--db", name, "--log", log, "--songs", songs, "--staging", folder("staging")])
    assert content(spark, name) == full
    spark.sql(f"DROP DATABASE {name} CASCADE")
    with pytest.raises(SystemExit):
        main(["etl"])


def test_readers_find_every_table_in_the_middle_of_a_refresh(spark, db, inputs, monkeypatch):
    log, songs = inputs
    lifecycle.refresh_from_files(spark, db, log, songs)
    reading = spark.table(f"{db}.fact_songplay")
    before = content(spark, db)
    seen = []

    def look(*frames):
        seen.append(content(spark, db))
        return build(*frames)

    build = lifecycle.build_star
    monkeypatch.setattr(lifecycle, "build_star", look)
    lifecycle.refresh_from_files(spark, db, log, songs)
    assert seen == [before] and content(spark, db) == before
    # The version before is still there for a reader that has begun with it.
    assert reading.count() == spark.table(f"{db}.fact_songplay").count()
    (home,) = spark.sql(f"DESCRIBE DATABASE {db}").where("info_name = 'Location'").select("info_value").first()
    lifecycle.refresh_from_files(spark, db, log, songs)
    assert len(child_folders(spark, f"{home}/versions")) == 2
    assert not [t.name for t in spark.catalog.listTables(db) if "__" in t.name]


def test_a_refresh_that_fails_leaves_the_tables(spark, db, inputs, monkeypatch):
    lifecycle.refresh_from_files(spark, db, *inputs)
    before = content(spark, db)
    monkeypatch.setattr(lifecycle, "build_star", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        lifecycle.refresh_from_files(spark, db, *inputs)
    assert content(spark, db) == before


def test_growing_a_star_keeps_keys_and_resolves_earlier_plays(spark, tmp_path, folder):
    sink = star.parquet_sink(folder("star"))
    write_lines(tmp_path / "songs.json", SONGS)
    songs = sink("songs", star.stage(parse_json(spark.read, str(tmp_path / "songs.json"), SONG_MAPPING), "staging_song_data"))
    plays = [play(artist=s["artist_name"], song=s["title"], itemInSession=i) for i, s in enumerate(SONGS)]
    write_lines(tmp_path / "log.json", [*plays, *(play(itemInSession=50 + i) for i in range(3)), play(itemInSession=50, level="paid")])
    log = sink("log", star.stage(parse_json(spark.read, str(tmp_path / "log.json"), LOG_MAPPING), "staging_song_log"))
    names = sorted({s["artist_name"] for s in SONGS if s["artist_name"]})
    early = F.col("artist_name") <= names[0]
    old_songs, new_songs = songs.where(early), songs.where(~early)
    old_log, new_log = log.where("itemInSession % 2 = 0"), log.where("itemInSession % 2 = 1")
    known = star.build_star(old_log, old_songs, sink)
    grown = extend_star(known, old_log, new_log, old_songs, new_songs, star.parquet_sink(folder("grown")))
    full = star.build_star(log, songs, star.parquet_sink(folder("full")))

    def facts(tables):
        rows = tables["fact_songplay"].join(tables["dim_user"], "user_key", "left").join(tables["dim_artist"], "artist_key", "left")
        rows = rows.join(tables["dim_song"].select("song_key", "song_id"), "song_key", "left")
        return sorted(map(str, rows.drop("songplay_key", "user_key", "artist_key", "song_key").collect()))

    assert facts(grown.tables) == facts(full)
    for table in ("dim_user", "dim_artist", "dim_song"):
        assert set(map(tuple, known[table].collect())) <= set(map(tuple, grown.tables[table].collect()))
    keys = [r.songplay_key for r in grown.tables["fact_songplay"].collect()]
    assert len(keys) == len(set(keys))


@pytest.mark.parametrize("form", ["batch", "stream"])
def test_a_rejected_file_is_corrected_and_loaded(spark, tmp_path, folder, form):
    staging = IncrementalStaging(spark, folder("root"))

    def run(max_errors=1):
        if form == "batch":
            return staging.load_new(folder("log"), LOG_MAPPING, max_errors=max_errors)
        return stream_new_files(spark, folder("log"), LOG_MAPPING, folder("root"), max_errors=max_errors)

    names = lambda df: sorted(r.filename.rpartition("/")[2] for r in df.collect())
    items = lambda: sorted(r.itemInSession for r in staging.rows("staging_song_log").collect())
    write_lines(tmp_path / "log" / "a b%c+d.json", [play(itemInSession=0)])
    run()
    bad = write_lines(tmp_path / "log" / "bad.json", [play(itemInSession=1), '{"broken', play(status="soon", itemInSession="x1")])
    gone = tmp_path / "log" / "gone.json"
    write_lines(gone, [play(itemInSession=50), "no json"])
    write_lines(tmp_path / "log" / "good.json", [play(itemInSession=2)])
    for _ in range(2):
        with pytest.raises(TooManyErrors, match="3 bad"):
            run(3)
        assert names(staging.quarantine("staging_song_log")) == ["bad.json", "gone.json"]
        assert items() == [0]
    errors = staging.errors("staging_song_log").where("filename like '%bad.json'").drop("filename").collect()
    assert set(map(tuple, errors)) == {
        (None, '{"broken', 8, "not JSON"), ("status", "soon", 4, "not int"), ("itemInSession", "x1", 2, "not int"),
    }
    write_lines(tmp_path / "log" / "bad.json", [play(itemInSession=i) for i in (1, 3, 4)])
    os.utime(bad, (2_000_000_000, 2_000_000_000))
    gone.unlink()
    write_lines(tmp_path / "log" / "more.json", [play(itemInSession=5)])
    run()
    assert items() == [0, 1, 2, 3, 4, 5]
    ledger = staging.ledger.of_table("staging_song_log")
    assert names(ledger) == ["a b%c+d.json", "bad.json", "good.json", "more.json"]
    assert names(staging.quarantine("staging_song_log")) == []
    # The listing spells names as the ledger does: nothing is new to the batch form now.
    assert staging.load_new(folder("log"), LOG_MAPPING) == 0
    run()
    assert items() == [0, 1, 2, 3, 4, 5]


def test_a_repair_that_died_before_it_deleted_the_old_loads(spark, tmp_path, folder, monkeypatch):
    staging = IncrementalStaging(spark, folder("root"))
    run = lambda: stream_new_files(spark, folder("log"), LOG_MAPPING, folder("root"))
    write_lines(tmp_path / "log" / "a.json", [play(itemInSession=0), "bad"])
    write_lines(tmp_path / "log" / "b.json", [play(itemInSession=1)])
    with pytest.raises(TooManyErrors):
        run()
    write_lines(tmp_path / "log" / "a.json", [play(itemInSession=7)])
    monkeypatch.setattr(incremental, "delete", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run()
    monkeypatch.undo()
    run()
    assert sorted(r.itemInSession for r in staging.rows("staging_song_log").collect()) == [1, 7]
    assert staging.ledger.of_table("staging_song_log").count() == 2


def test_each_file_has_its_own_time(spark, tmp_path, folder):
    for i in range(6):
        write_lines(tmp_path / "log" / f"{i}.json", [play(itemInSession=i)] * 3000)
    write_lines(tmp_path / "log" / "none.json", [" "])
    staging = IncrementalStaging(spark, folder("root"))
    staging.load_new(folder("log"), LOG_MAPPING)
    ledger = staging.ledger.of_table("staging_song_log")
    assert ledger.count() == 7 and ledger.where("curtime is null").count() == 0
    (timing,) = load_timing(ledger.withColumnRenamed("load_batch", "query")).collect()
    assert timing.processed_files == 6 and timing.avg_time_per_file > 0
