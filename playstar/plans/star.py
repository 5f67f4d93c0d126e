"""The star schema: three dimensions and the fact, derived from staging.

The default plans keep every duplicate the definitions imply: a user with two
levels is two rows, an artist name may stand for several artists, and a play is
one fact row per combination. Corrected variants are separate functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstar.functions.moments import clock_key, date_key, epoch_timestamp
from playstar.operators.joins import left_join_in_blocks
from playstar.operators.keys import arrival_keys, ranked_keys
from playstar.schemas import PRIMARY_KEYS, natural_columns, table_schema
from playstar.session import new_folder, store, together

#: Songs of one title and artist that one block of the song lookup takes.
SONG_BLOCK_ROWS = 100_000

#: Facts that one task writes, about.
FACTS_PER_TASK = 4_000_000

# Takes a table name and its rows, writes them, and returns the written rows.
Sink = Callable[[str, DataFrame], DataFrame]


def parquet_sink(root: str) -> Sink:
    """Tables as Parquet folders below ``root``."""
    return lambda table, df: store(df, f"{root}/{table}", packed=table == "fact_songplay")


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of ``table`` in order and type."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema(table)])


def stage(rows: DataFrame, table: str) -> DataFrame:
    """Loaded records with the identity column of their staging table."""
    return conform(arrival_keys(rows.select(natural_columns(table)), PRIMARY_KEYS[table]), table)


# Dimensions ---------------------------------------------------------------


def _distinct(staged: DataFrame, required: str, columns: dict[str, str]) -> DataFrame:
    """Distinct rows of renamed columns where ``required`` is known.

    DISTINCT aggregates within each task first, so repeated rows of a busy user
    or artist never reach the shuffle.
    """
    known = staged.where(F.col(required).isNotNull())
    return known.select([F.col(source).alias(name) for name, source in columns.items()]).distinct()


def user_rows(song_log: DataFrame) -> DataFrame:
    """Who has played something; one row per state a user has been seen in."""
    return _distinct(
        song_log,
        "artist",
        {
            "user_id": "userId",
            "user_first_name": "firstName",
            "user_last_name": "lastName",
            "user_gender": "gender",
            "user_level": "level",
        },
    )


def artist_rows(song_data: DataFrame) -> DataFrame:
    columns = ("artist_id", "artist_name", "artist_location", "artist_latitude", "artist_longitude")
    return _distinct(song_data, "artist_name", {name: name for name in columns})


def song_rows(song_data: DataFrame, dim_artist: DataFrame, null_safe: bool = False) -> DataFrame:
    """Songs with the key of their artist.

    An unknown location equals nothing, so such songs stay without an artist
    key; ``null_safe`` lets two unknown locations match.
    """
    artist = dim_artist.select(
        "artist_key", F.col("artist_id").alias("a_id"), F.col("artist_name").alias("a_name"),
        F.col("artist_location").alias("a_location"),
    )

    def same(a: str, b: str) -> Column:
        return F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b)

    matches = same("artist_id", "a_id") & same("artist_name", "a_name") & same("artist_location", "a_location")
    return (
        song_data.where(F.col("artist_id").isNotNull())
        .join(artist, matches, "left")
        .select(
            "artist_key",
            "song_id",
            "artist_id",
            F.col("title").alias("song_title"),
            F.col("year").alias("song_year"),
            F.col("duration").alias("song_duration"),
        )
        .distinct()
    )


def keyed_dimension(rows: DataFrame, table: str, order_by: list[str] | None = None) -> DataFrame:
    """A dimension under dense keys, in its declared columns."""
    return conform(ranked_keys(rows, PRIMARY_KEYS[table], order_by or natural_columns(table)), table)


# Artists are ranked latitude first, the order their rows are derived in.
ARTIST_ORDER = ["artist_id", "artist_name", "artist_location", "artist_latitude", "artist_longitude"]


# Fact ----------------------------------------------------------------------


def _resolve(names: DataFrame, artist: DataFrame, song: DataFrame) -> DataFrame:
    """``names`` with the keys of each artist of that name and of its song, if known."""
    by_artist = names.join(artist, F.col("artist") == F.col("artist_name"))
    return left_join_in_blocks(by_artist, song, {"song": "song_title", "artist_id": "song_artist_id"}, spread_by="song_key", block_rows=SONG_BLOCK_ROWS)


def songplay_rows(
    song_log: DataFrame, dim_user: DataFrame, dim_artist: DataFrame, dim_song: DataFrame
) -> DataFrame:
    """Distinct plays with the keys of their user, artist and song.

    A play counts when its artist is known by name; user and song may stay
    unknown. Only the log is large, so the plan is about how often it moves:

    * Names are resolved once per distinct (artist, song) pair and the pairs are
      joined to the plays: one more scan of two columns instead of one more
      shuffle of the log, and a hot artist is a handful of pairs. What is small
      enough to be broadcast is left to Spark's own size checks.
    * The user comes last, and DISTINCT includes ``user_id``. Where that join
      has to shuffle, its partitioning by user already serves the DISTINCT.
      (``user_key`` determines ``user_id``, so the rows are the same.)
    """
    plays = song_log.where(F.col("artist").isNotNull() & F.col("userId").isNotNull())
    started = epoch_timestamp(F.col("ts"))
    detail = plays.select(
        "artist",
        "song",
        "userId",
        date_key(started).alias("start_date_key"),
        clock_key(started).alias("start_time_key"),
        started.alias("start_datetime"),
        "auth",
        F.col("sessionId").cast("bigint").alias("session_id"),
        F.col("itemInSession").alias("item_in_session"),
        "method",
        "page",
        "status",
        F.col("userAgent").alias("user_agent"),
        F.col("location").alias("songplay_location"),
        "registration",
    )

    artist = dim_artist.where(F.col("artist_id").isNotNull()).select("artist_name", "artist_id", "artist_key")
    song = dim_song.select("song_title", F.col("artist_id").alias("song_artist_id"), "song_key")
    pairs = _resolve(plays.select("artist", "song").distinct(), artist, song)
    known = pairs.select(F.col("artist").alias("known_artist"), F.col("song").alias("known_song"), "artist_key", "song_key")
    same_pair = (F.col("artist") == F.col("known_artist")) & F.col("song").eqNullSafe(F.col("known_song"))
    resolved = detail.join(known, same_pair)

    user = dim_user.select("user_id", "user_key")
    return (
        resolved.join(user, F.col("userId") == F.col("user_id"), "left")
        .select("userId", *natural_columns("fact_songplay"))
        .distinct()
        .drop("userId")
    )


def one_user_per_id(dim_user: DataFrame) -> DataFrame:
    return dim_user.groupBy("user_id").agg(F.min("user_key").alias("user_key"))


def one_artist_per_name(dim_artist: DataFrame) -> DataFrame:
    return (
        dim_artist.where(F.col("artist_id").isNotNull())
        .groupBy("artist_name")
        .agg(F.min_by("artist_id", "artist_key").alias("artist_id"), F.min("artist_key").alias("artist_key"))
    )


def one_song_per_title(dim_song: DataFrame) -> DataFrame:
    return dim_song.groupBy("song_title", "artist_id").agg(F.min("song_key").alias("song_key"))


def songplay_rows_deduplicated(
    song_log: DataFrame, dim_user: DataFrame, dim_artist: DataFrame, dim_song: DataFrame
) -> DataFrame:
    """Plays that no dimension multiplies: the lowest key stands for each user
    id, artist name, and title of an artist."""
    return songplay_rows(
        song_log, one_user_per_id(dim_user), one_artist_per_name(dim_artist), one_song_per_title(dim_song)
    )


# Plays before they multiply ---------------------------------------------------


def one_artist_per_credit(dim_artist: DataFrame) -> DataFrame:
    return (
        dim_artist.where(F.col("artist_id").isNotNull())
        .groupBy("artist_name", "artist_id")
        .agg(F.min("artist_key").alias("artist_key"))
    )


def songplay_groups(
    song_log: DataFrame, dim_user: DataFrame, dim_artist: DataFrame, dim_song: DataFrame
) -> DataFrame:
    """Distinct plays, one row for each artist id of their artist's name.

    The lowest key stands for all rows of a user id, of an artist's name and id, and of a title of that id.
    So the log is shuffled and made distinct before the dimensions multiply it: with songs that share a title, facts
    grow with the product of log and catalogue, these rows with the log.
    """
    return songplay_rows(song_log, one_user_per_id(dim_user), one_artist_per_credit(dim_artist), one_song_per_title(dim_song))


def spread_plays(groups: DataFrame, dim_user: DataFrame, dim_artist: DataFrame, dim_song: DataFrame) -> DataFrame:
    """The plays of ``songplay_rows`` from written ``songplay_groups`` of the same dimensions.

    Groups share no keys, so there is nothing to make distinct. Facts come out of the last join and are not moved
    again. Plays of one song lie together, so that a table of them packs well.
    """
    spark = groups.sparkSession
    resolved = store(pair_rows(groups, dim_artist, dim_song), new_folder(spark, "pairs"))
    users = store(same_user_rows(dim_user), new_folder(spark, "users"))

    # Twice as many for users with two rows; the number only has to be about right.
    facts = resolved.agg(F.sum("_plays")).first()[0] or 0
    order = ["artist_key", "song_key", "start_datetime", "session_id", "item_in_session"]
    spread = groups.repartitionByRange(1 + facts // FACTS_PER_TASK, *order).sortWithinPartitions(*order)
    by_user = spread.withColumnRenamed("user_key", "_user").join(users, F.col("_user") == F.col("_of_user_key"), "left")
    same_pair = (F.col("_of_artist") == F.col("_artist")) & F.col("_of_song").eqNullSafe(F.col("_song"))
    renamed = by_user.withColumnsRenamed({"artist_key": "_of_artist", "song_key": "_of_song"})
    return renamed.join(resolved, same_pair).select(natural_columns("fact_songplay"))


def pair_rows(groups: DataFrame, dim_artist: DataFrame, dim_song: DataFrame) -> DataFrame:
    """The pairs of artist and song that each pair of ``groups`` stands for, with the number of its plays."""
    artist = _members(dim_artist, one_artist_per_credit(dim_artist), ["artist_name", "artist_id"], "artist_key")
    song = _members(dim_song, one_song_per_title(dim_song), ["song_title", "artist_id"], "song_key")
    counted = groups.groupBy(F.col("artist_key").alias("_artist"), F.col("song_key").alias("_song")).agg(F.count(F.lit(1)).alias("_plays"))
    credits = counted.join(artist, F.col("_artist") == F.col("_of_artist_key")).drop("_of_artist_key")
    resolved = left_join_in_blocks(credits, song, {"_song": "_of_song_key"}, spread_by="song_key", block_rows=SONG_BLOCK_ROWS)
    return resolved.select("_artist", "_song", "_plays", "artist_key", "song_key")


def same_user_rows(dim_user: DataFrame) -> DataFrame:
    """All keys of users next to the key that stands for them."""
    return _members(dim_user, one_user_per_id(dim_user), ["user_id"], "user_key")


def _members(dimension: DataFrame, ones: DataFrame, names: list[str], key: str) -> DataFrame:
    """All keys of a dimension next to the key that stands for them."""
    one = ones.select(*[F.col(name).alias(f"_{name}") for name in names], F.col(key).alias(f"_of_{key}"))
    same = [F.col(name) == F.col(f"_{name}") for name in names]
    return dimension.select(*names, key).join(one, same).select(f"_of_{key}", key)


# All of it -----------------------------------------------------------------


def build_star(song_log: DataFrame, song_data: DataFrame, sink: Sink) -> dict[str, DataFrame]:
    """Derive and write the star tables; each step reads what the ones before wrote."""

    def write_users() -> tuple[DataFrame]:
        return (sink("dim_user", keyed_dimension(user_rows(song_log), "dim_user")),)

    def write_catalogue() -> tuple[DataFrame, DataFrame]:
        artists = sink("dim_artist", keyed_dimension(artist_rows(song_data), "dim_artist", ARTIST_ORDER))
        return artists, sink("dim_song", keyed_dimension(song_rows(song_data, artists), "dim_song"))

    (users,), (artists, songs) = together(write_users, write_catalogue)
    groups = store(songplay_groups(song_log, users, artists, songs), new_folder(song_log.sparkSession, "plays"))
    plays = arrival_keys(spread_plays(groups, users, artists, songs), "songplay_key")
    fact = sink("fact_songplay", conform(plays, "fact_songplay"))
    return {"dim_user": users, "dim_artist": artists, "dim_song": songs, "fact_songplay": fact}
