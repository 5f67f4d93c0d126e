"""Declared schemas of the raw inputs and the warehouse tables.

All columns are nullable; keys are declared for the integrity reports only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql.types import StringType, StructField, StructType, VarcharType

# Table names, column names and column types of the warehouse.
TABLE_COLUMNS = {
    "staging_song_log": """
        song_log_id BIGINT, artist STRING, auth STRING, firstName STRING, gender STRING,
        itemInSession INT, lastName STRING, length DOUBLE, level STRING, location STRING,
        method STRING, page STRING, registration BIGINT, sessionId INT, song STRING,
        status INT, ts BIGINT, userAgent STRING, userId INT""",
    "staging_song_data": """
        song_data_id BIGINT, num_songs INT, artist_id STRING, artist_latitude DOUBLE,
        artist_longitude DOUBLE, artist_location STRING, artist_name STRING,
        song_id STRING, title STRING, duration DOUBLE, year INT""",
    "dim_time": """
        time_key INT, time_key_sql STRING, hour INT, minute INT, second INT, am_pm VARCHAR(2)""",
    "dim_date": """
        date_key INT, date_key_sql DATE, week INT, month STRING, year INT, is_weekday VARCHAR(8)""",
    "dim_user": """
        user_key BIGINT, user_id INT, user_first_name STRING, user_last_name STRING,
        user_gender VARCHAR(1), user_level STRING""",
    "dim_artist": """
        artist_key BIGINT, artist_id STRING, artist_name STRING, artist_location STRING,
        artist_longitude DOUBLE, artist_latitude DOUBLE""",
    "dim_song": """
        song_key BIGINT, artist_key BIGINT, song_id STRING, artist_id STRING,
        song_title STRING, song_year INT, song_duration DOUBLE""",
    "fact_songplay": """
        songplay_key BIGINT, start_date_key INT, start_time_key INT, user_key BIGINT,
        artist_key BIGINT, song_key BIGINT, start_datetime TIMESTAMP_NTZ, auth STRING,
        session_id BIGINT, item_in_session INT, method STRING, page STRING, status INT,
        user_agent STRING, songplay_location STRING, registration BIGINT""",
}

STAGING_TABLES = ("staging_song_log", "staging_song_data")
STAR_TABLES = ("dim_user", "dim_artist", "dim_song", "fact_songplay")
CALENDAR_TABLES = ("dim_time", "dim_date")

# The key column of every table.
PRIMARY_KEYS = {
    "staging_song_log": "song_log_id",
    "staging_song_data": "song_data_id",
    "dim_time": "time_key",
    "dim_date": "date_key",
    "dim_user": "user_key",
    "dim_artist": "artist_key",
    "dim_song": "song_key",
    "fact_songplay": "songplay_key",
}

# Fixed values: (referencing table, its column, referenced table).
FOREIGN_KEYS = (
    ("fact_songplay", "start_date_key", "dim_date"),
    ("fact_songplay", "start_time_key", "dim_time"),
    ("fact_songplay", "user_key", "dim_user"),
    ("fact_songplay", "artist_key", "dim_artist"),
    ("fact_songplay", "song_key", "dim_song"),
    ("dim_song", "artist_key", "dim_artist"),
)


def table_ddl(table: str) -> str:
    """The column list of ``CREATE TABLE``, bounded text columns included."""
    return " ".join(TABLE_COLUMNS[table].split())


def table_schema(table: str) -> StructType:
    """The same columns as a frame holds them (bounded text is plain text)."""
    declared = StructType.fromDDL(table_ddl(table))
    return StructType(
        [StructField(f.name, StringType() if isinstance(f.dataType, VarcharType) else f.dataType) for f in declared]
    )


def natural_columns(table: str) -> list[str]:
    """All columns except the surrogate key."""
    names = [column.split()[0] for column in TABLE_COLUMNS[table].split(",")]
    return [name for name in names if name != PRIMARY_KEYS[table]]


@dataclass(frozen=True)
class PathMapping:
    """Which JSON path feeds which staging column, in column order."""

    table: str
    paths: tuple[str, ...]

    def columns(self) -> list[tuple[str, StructField]]:
        fields = [f for f in table_schema(self.table) if f.name != PRIMARY_KEYS[self.table]]
        if len(fields) != len(self.paths):
            raise ValueError(f"{self.table} needs {len(fields)} paths, got {len(self.paths)}")
        return list(zip(self.paths, fields))

    def top_level_keys(self) -> list[str] | None:
        """The plain key behind every path, or None when a path goes deeper."""
        keys = [re.fullmatch(r"\$(?:\.(\w+)|\['([^']+)'\])", path) for path in self.paths]
        return [k[1] or k[2] for k in keys] if all(keys) else None


# Every raw key is named like its column: the logs are addressed in bracket form,
# the song records in dot form.
LOG_MAPPING = PathMapping(
    "staging_song_log", tuple(f"$['{name}']" for name in natural_columns("staging_song_log"))
)
SONG_MAPPING = PathMapping(
    "staging_song_data", tuple(f"$.{name}" for name in natural_columns("staging_song_data"))
)
