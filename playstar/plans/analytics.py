"""Reports over the star and the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstar.functions.moments import micros_of, second_of_day
from playstar.operators.windows import top_per_group


def plays_by_half_day(with_key: DataFrame, dim_time: DataFrame, plays: Column | None = None) -> DataFrame:
    """Rows of ``with_key`` per half of the day that its ``clock`` falls in, or the sum of ``plays`` over them."""
    # dim_time has one row per second of a day and never grows: always broadcast.
    halves = F.broadcast(dim_time.select("time_key", "am_pm"))
    return (
        with_key.join(halves, F.col("clock") == F.col("time_key"), "left")
        .groupBy("am_pm")
        .agg((F.count(F.lit(1)) if plays is None else F.sum(plays)).alias("song_plays"))
        .orderBy(F.col("am_pm").asc_nulls_last())
    )


def plays_by_am_pm(fact_songplay: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Plays per half of the day, as the two tables define their keys.

    The fact's key is HHMMSS, the dimension's counts seconds: plays after 09:00
    find no row and end up under NULL, earlier ones find another second.
    """
    return plays_by_half_day(fact_songplay.select(F.col("start_time_key").alias("clock")), dim_time)


def plays_by_am_pm_fixed(fact_songplay: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Plays per half of the day by the second they really started."""
    return plays_by_half_day(fact_songplay.select(second_of_day(F.col("start_datetime")).alias("clock")), dim_time)


def plays_by_hour(fact_songplay: DataFrame) -> DataFrame:
    """Plays per hour of the day, busiest hour first."""
    return (
        fact_songplay.groupBy(F.hour("start_datetime").alias("hour"))
        .agg(F.count(F.lit(1)).alias("song_plays"))
        .orderBy(F.desc("song_plays"), "hour")
    )


def with_daytype(fact_songplay: DataFrame, dim_date: DataFrame, *more: str) -> DataFrame:
    """(is_weekday, artist_key, song_key) of every play, and columns ``more`` of it."""
    # The date dimension is bounded by the range it is generated for.
    day_types = F.broadcast(dim_date.select("date_key", "is_weekday"))
    keys = fact_songplay.select("start_date_key", "artist_key", "song_key", *more)
    dated = keys.join(day_types, F.col("start_date_key") == F.col("date_key"), "left")
    return dated.select("is_weekday", "artist_key", "song_key", *more)


def named_counts(per_key: DataFrame, dim_artist: DataFrame, dim_song: DataFrame) -> DataFrame:
    """``plays`` per day type, artist key and song key, under the names of artist and song."""
    return (
        per_key.join(dim_artist.select("artist_key", "artist_name"), "artist_key", "left")
        .join(dim_song.select("song_key", "song_title"), "song_key", "left")
        .groupBy("is_weekday", "song_title", "artist_name")
        .agg(F.sum("plays").alias("songplay_count"))
    )


def song_artist_daytype_counts(
    fact_songplay: DataFrame, dim_artist: DataFrame, dim_song: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Plays per day type, song title and artist name.

    The fact is counted per key before it meets artists and songs: what is
    shuffled and joined grows with the catalogue and not with the plays. The
    dimensions are joined on their keys, so the counts only have to be summed.
    """
    per_key = (
        with_daytype(fact_songplay, dim_date)
        .groupBy("is_weekday", "artist_key", "song_key")
        .agg(F.count(F.lit(1)).alias("plays"))
    )
    return named_counts(per_key, dim_artist, dim_song)


def top_song_by_daytype(
    fact_songplay: DataFrame, dim_artist: DataFrame, dim_song: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """The most played song of weekdays and of weekends; ties go by title, then artist."""
    return most_played(song_artist_daytype_counts(fact_songplay, dim_artist, dim_song, dim_date))


def most_played(counts: DataFrame) -> DataFrame:
    """The first song of each day type in ``song_artist_daytype_counts``."""
    best_first = [
        F.desc("songplay_count"),
        F.col("song_title").asc_nulls_last(),
        F.col("artist_name").asc_nulls_last(),
    ]
    return top_per_group(counts, ["is_weekday"], best_first).orderBy(F.col("is_weekday").asc_nulls_last())


def songplay_filter_compare(song_log: DataFrame) -> DataFrame:
    """How far "an artist is given" and "the page is NextSong" agree on what a play is."""
    by_artist = F.col("artist").isNotNull()
    by_page = F.coalesce(F.col("page") == "NextSong", F.lit(False))
    return song_log.agg(
        F.count_if(by_artist).alias("artist_given"),
        F.count_if(by_page).alias("page_next_song"),
        F.count_if(by_artist & by_page).alias("both"),
        F.count_if(by_artist & ~by_page).alias("artist_only"),
        F.count_if(~by_artist & by_page).alias("page_only"),
    )


def load_timing(ledger: DataFrame) -> DataFrame:
    """(query, processed_files, avg_time_per_file) for every load.

    The average gap between consecutive commits is last minus first over their
    number: all gaps in between cancel out. So nothing has to be sorted, and a
    load of any size is reduced inside the tasks that read it. Commits without a
    time sort last; only the first of them has a known predecessor.
    """
    per_query = ledger.groupBy("query").agg(
        F.count("curtime").alias("known"),
        F.count(F.lit(1)).alias("all"),
        (F.max(micros_of(F.col("curtime"))) - F.min(micros_of(F.col("curtime")))).alias("span"),
    )
    trailing = F.when((F.col("all") > F.col("known")) & (F.col("known") > 0), 1).otherwise(0)
    gaps = F.col("known") - 1
    return per_query.select(
        "query",
        (F.greatest(gaps, F.lit(0)) + trailing).alias("processed_files"),
        F.when(gaps > 0, F.col("span").cast("double") / gaps / F.lit(1e6)).alias("avg_time_per_file"),
    ).where("processed_files > 0")


def load_timing_of(ledger: DataFrame, query: int) -> DataFrame:
    """The timing of one load; a load nobody has seen has processed 0 files."""
    return ledger.sparkSession.sql(
        """
        WITH timing AS (SELECT * FROM {timings} WHERE query = :query)
        SELECT coalesce(max(processed_files), 0L) AS processed_files,
               max(avg_time_per_file) AS avg_time_per_file
        FROM timing
        """,
        args={"query": query},
        timings=load_timing(ledger),
    )
