"""Growing a star by new batches instead of deriving it anew.

The rule: the result equals one full load of all batches, up to the numbers of keys, and keys once given
stay. New rows of users, artists and songs get the next keys. Plays of the new batch are resolved
and added. Plays of earlier batches are resolved again only where a dimension has
grown under them: their artist's name, a song of their artist, or their user has new rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstar.operators.keys import arrival_keys, extend_dimension, next_key
from playstar.plans.star import Sink, artist_rows, conform, song_rows, songplay_rows, user_rows
from playstar.schemas import PRIMARY_KEYS, natural_columns


@dataclass(frozen=True)
class Extended:
    """The star's tables after a batch, and the rows that each has got."""

    tables: dict[str, DataFrame]
    added: dict[str, DataFrame]


def extend_star(
    known: dict[str, DataFrame],
    old_log: DataFrame,
    new_log: DataFrame,
    old_songs: DataFrame,
    new_songs: DataFrame,
    sink: Sink,
) -> Extended:
    """Extend the star tables ``known`` (derived from the old staging rows) by new staging rows.

    ``sink`` writes what is new; dimensions are only appended to. The fact's kept rows are a
    filter of the known ones, so a batch that touches no earlier play is a plain append.
    """
    added: dict[str, DataFrame] = {}

    def grow(table: str, rows: DataFrame) -> DataFrame:
        fresh = conform(extend_dimension(known[table], rows, PRIMARY_KEYS[table]), table)
        added[table] = sink(f"{table}_added", fresh)
        return known[table].unionByName(added[table])

    users = grow("dim_user", user_rows(new_log))
    artists = grow("dim_artist", artist_rows(new_songs))
    # An old song gets one more row for each new row of its artist.
    old_again = song_rows(old_songs.join(added["dim_artist"].select("artist_id"), "artist_id", "left_semi"), added["dim_artist"])
    songs = grow("dim_song", song_rows(new_songs, artists).unionByName(old_again.where("artist_key is not null")))

    by_song = artists.join(added["dim_song"].select("artist_id"), "artist_id", "left_semi").select("artist_name")
    names = added["dim_artist"].select("artist_name").union(by_song).distinct()
    ids = added["dim_user"].select("user_id").distinct()
    touched_artists = known["dim_artist"].join(names, "artist_name", "left_semi").select("artist_key")
    touched_users = known["dim_user"].join(ids, "user_id", "left_semi").select("user_key")
    kept = known["fact_songplay"].join(touched_artists, "artist_key", "left_anti").join(touched_users, "user_key", "left_anti")

    renamed = names.select(F.col("artist_name").alias("artist")), ids.select(F.col("user_id").alias("userId"))
    by_name = old_log.join(renamed[0], "artist", "left_semi")
    by_user = old_log.join(renamed[0], "artist", "left_anti").join(renamed[1], "userId", "left_semi")
    log_columns = natural_columns("staging_song_log")
    plays = new_log.select(log_columns).union(by_name.select(log_columns)).union(by_user.select(log_columns))
    columns = natural_columns("fact_songplay")
    # A repeated record may stand for a play that is kept.
    rows = songplay_rows(plays, users, artists, songs).select(columns).subtract(kept.select(columns))
    keyed = arrival_keys(rows, "songplay_key", next_key(known["fact_songplay"], "songplay_key"))
    added["fact_songplay"] = sink("fact_songplay_added", conform(keyed, "fact_songplay"))
    fact = conform(kept, "fact_songplay").unionByName(added["fact_songplay"])
    return Extended({"dim_user": users, "dim_artist": artists, "dim_song": songs, "fact_songplay": fact}, added)
