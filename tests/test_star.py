"""The star schema on hand-made plays: what is kept, what multiplies, what is lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playstar.plans import analytics, star
from playstar.plans.calendar import dim_date, dim_time
from playstar.schemas import LOG_MAPPING, PRIMARY_KEYS, SONG_MAPPING, natural_columns
from playstar.sources.json_files import load_json
from tests.samples import SONGS, play, write_lines


def at(text):
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


NAMESAKE = {**SONGS[1], "artist_id": "ARSECOND", "artist_location": "Perth", "song_id": "SOOTHER", "title": "Other"}
RECORDS = [
    play(ts=at("2018-11-15T04:31:59") + 999, itemInSession=1),
    play(ts=at("2018-11-15T04:32:00"), itemInSession=2),
    play(ts=at("2018-11-15T08:59:59"), itemInSession=3),
    play(ts=at("2018-11-17T09:00:00"), itemInSession=4),
    play(ts=at("2026-01-05T10:00:00"), itemInSession=5),
    play(userId="8", ts=at("2018-11-15T04:32:00"), itemInSession=6),
    play(userId="8", level="paid", ts=at("2018-11-15T04:32:00"), itemInSession=7),
    play(userId="", itemInSession=8),
    play(artist=None, song=None, itemInSession=9),
    play(artist=None, song=None, userId="99", itemInSession=10),
    play(artist="Nobody Knows", itemInSession=11),
    play(artist="Jiřina", song="Not on record", itemInSession=12),
    play(artist="Jiřina", song=None, itemInSession=13),
    play(artist="Jiřina", song=None, itemInSession=13),
    play(artist="Nowhere Band", song="Somewhere", page="Home", itemInSession=14),
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("star")
    log_path = write_lines(folder / "log.json", RECORDS)
    song_path = write_lines(folder / "songs.json", [*SONGS, NAMESAKE])
    sink = star.parquet_sink(str(folder / "tables"))
    log = load_json(spark, log_path, LOG_MAPPING, str(folder / "l")).rows
    songs = load_json(spark, song_path, SONG_MAPPING, str(folder / "s")).rows
    log = sink("staging_song_log", star.stage(log, "staging_song_log"))
    songs = sink("staging_song_data", star.stage(songs, "staging_song_data"))
    return {"staging_song_log": log, "staging_song_data": songs, **star.build_star(log, songs, sink)}


def per_item(fact):
    items = {}
    for row in fact.collect():
        items.setdefault(row.item_in_session, []).append(row)
    return items


def test_users_who_played_one_row_per_state(tables):
    users = {(r.user_id, r.user_level) for r in tables["dim_user"].collect()}
    assert users == {(None, "free"), (7, "free"), (8, "free"), (8, "paid")}


def test_keys_are_dense_and_ordered(tables):
    for table in ("dim_user", "dim_artist", "dim_song"):
        keys = sorted(r[0] for r in tables[table].select(PRIMARY_KEYS[table]).collect())
        assert keys == list(range(1, len(keys) + 1))
    fact = tables["fact_songplay"]
    assert fact.select("songplay_key").distinct().count() == fact.count()


def test_unknown_location_finds_no_artist(tables):
    songs = {r.song_id: r for r in tables["dim_song"].collect()}
    assert songs["SONOPLACE"].artist_key is None
    assert songs["SOPAPERBOATS000001"].artist_key is not None
    repaired = star.song_rows(tables["staging_song_data"], tables["dim_artist"], null_safe=True)
    assert repaired.where("artist_key IS NULL").count() == 0


def test_what_becomes_a_fact(tables):
    items = per_item(tables["fact_songplay"])
    # No user, no artist, or an artist nobody has on record: no play.
    assert not {8, 9, 10, 11} & items.keys()
    # Two artists are called The Tidewaters and only one of them has the song.
    assert len(items[1]) == 2
    assert sorted(r.song_key is None for r in items[1]) == [False, True]
    # The user with two levels doubles that again.
    assert len(items[6]) == len(items[7]) == 4
    # Unknown song and no song keep the artist; a repeated record is one play.
    assert [r.song_key for r in items[12]] == [None]
    assert len(items[13]) == 1
    # The page does not decide what a play is.
    assert len(items[14]) == 1


def test_times_of_a_play(tables):
    items = per_item(tables["fact_songplay"])
    first = items[1][0]
    assert first.start_datetime == dt.datetime(2018, 11, 15, 4, 31, 59)
    assert (first.start_date_key, first.start_time_key) == (20181115, 43159)
    assert items[2][0].start_time_key == 43200


def test_stored_plays_are_the_derived_ones(tables):
    frames = [tables[t] for t in ("staging_song_log", "dim_user", "dim_artist", "dim_song")]
    columns = natural_columns("fact_songplay")
    derived = star.songplay_rows(*frames)
    assert derived.columns == columns
    assert tables["fact_songplay"].select(columns).exceptAll(derived).count() == 0


def test_deduplicated_plays(tables):
    frames = [tables[t] for t in ("staging_song_log", "dim_user", "dim_artist", "dim_song")]
    items = per_item(star.songplay_rows_deduplicated(*frames))
    assert all(len(rows) == 1 for rows in items.values())
    assert items.keys() == per_item(tables["fact_songplay"]).keys()


def test_half_days(spark, tables):
    fact = tables["fact_songplay"].where("item_in_session in (1, 2, 3, 4)")
    # 04:31:59 is read as second 43159 (AM), 04:32:00 as 43200 (PM), 08:59:59 as
    # 85959 (PM), and 09:00:00 as 90000, which no day has.
    as_defined = analytics.plays_by_am_pm(fact, dim_time(spark)).collect()
    assert [tuple(r) for r in as_defined] == [("AM", 2), ("PM", 4), (None, 2)]
    fixed = analytics.plays_by_am_pm_fixed(fact, dim_time(spark)).collect()
    assert [tuple(r) for r in fixed] == [("AM", 8)]


def test_plays_after_the_calendar_have_no_day_type(spark, tables):
    names = ("fact_songplay", "dim_artist", "dim_song")
    frames = [tables[n] for n in names]
    top = analytics.top_song_by_daytype(*frames, dim_date(spark)).collect()
    assert [r.is_weekday for r in top] == ["Weekday", "Weekend", None]
    longer = dim_date(spark, last=dt.date(2026, 12, 31))
    assert [r.is_weekday for r in analytics.top_song_by_daytype(*frames, longer).collect()] == ["Weekday", "Weekend"]
    counts = analytics.song_artist_daytype_counts(*frames, dim_date(spark))
    assert counts.agg(F.sum("songplay_count")).first()[0] == tables["fact_songplay"].count()


def test_filter_compare(tables):
    row = analytics.songplay_filter_compare(tables["staging_song_log"]).first()
    assert row.asDict() == {
        "artist_given": 13, "page_next_song": 14, "both": 12, "artist_only": 1, "page_only": 2,
    }


def test_load_timing_equals_consecutive_gaps(spark):
    start = dt.datetime(2024, 1, 1)
    times = {1: [0, 5, 5, 40], 2: [3], 3: [10, None, None], 4: [None]}
    rows = [(q, None if t is None else start + dt.timedelta(seconds=t)) for q, ts in times.items() for t in ts]
    ledger = spark.createDataFrame(rows, "query bigint, curtime timestamp_ntz")
    got = {r.query: (r.processed_files, r.avg_time_per_file) for r in analytics.load_timing(ledger).collect()}
    assert got == {1: (3, 40 / 3), 3: (1, None)}
    assert tuple(analytics.load_timing_of(ledger, 1).first()) == (3, 40 / 3)
    assert tuple(analytics.load_timing_of(ledger, 77).first()) == (0, None)


def test_facts_stay_where_they_are_made(spark, tmp_path):
    """A title of 200 songs multiplies plays after the last shuffle and DISTINCT, and the table of them packs well."""
    same = ["'F' AS firstName", "'L' AS lastName", "'M' AS gender", "'Logged In' AS auth", "'PUT' AS method", "'Oslo' AS location", "200 AS status"]
    log = spark.range(300).selectExpr(
        "id AS song_log_id", "'x' AS artist", "CASE WHEN id % 3 < 2 THEN 't' WHEN id % 2 = 0 THEN 'no such' END AS song",
        "cast(id % 7 AS int) AS userId", "CASE WHEN id % 2 = 0 THEN 'paid' ELSE 'free' END AS level", "id div 6 * 1000 AS ts",
        "7 AS sessionId", "1 AS itemInSession", "'NextSong' AS page", "'a' AS userAgent", "5L AS registration", *same,
    )
    log = log.union(log)
    songs = spark.range(200).selectExpr(
        "'x' AS artist_name", "concat('A', id % 2) AS artist_id", "CASE WHEN id % 4 < 2 THEN 'Perth' END AS artist_location", "1.5D AS artist_latitude",
        "2.5D AS artist_longitude", "cast(id AS string) AS song_id", "'t' AS title", "1999 AS year", "1D AS duration",
    )
    plans, sink = {}, star.parquet_sink(str(tmp_path / "tables"))

    def noted(table, rows):
        plans[table] = rows._jdf.queryExecution().executedPlan().toString()
        return sink(table, rows)

    tables = star.build_star(log, songs, noted)
    above = plans["fact_songplay"][: plans["fact_songplay"].index("Join")]
    assert "Exchange" not in above and "Aggregate" not in above
    columns = natural_columns("fact_songplay")
    fact = tables["fact_songplay"].select(columns)
    derived = star.songplay_rows(log, tables["dim_user"], tables["dim_artist"], tables["dim_song"])
    assert fact.exceptAll(derived).isEmpty() and derived.exceptAll(fact).isEmpty()
    assert fact.count() > 200 * 200
    files = [path for path in (tmp_path / "tables" / "fact_songplay").iterdir() if path.suffix == ".parquet"]
    assert sum(path.stat().st_size for path in files) < fact.count()
    keys = tables["fact_songplay"].select("songplay_key")
    assert keys.distinct().count() == keys.count()
