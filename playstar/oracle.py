"""What each registered query has to return, as SQL for an independent engine.

The statements run on DuckDB over the same Parquet tables. Each is put together
from common table expressions; only those a statement needs are written out.
"""

from __future__ import annotations

import re

from playstar.registry import BUCKET, HEAD, LOG_PREFIX, ONE_LOAD

# Named building blocks. Order matters: a block may use the ones before it.
BLOCKS = {
    "song_log": """
        SELECT
            CASE WHEN ev.event_type NOT IN ('error', 'signup') THEN pa.p_brand END AS artist,
            CASE ev.event_type WHEN 'error' THEN 'Logged Out' ELSE 'Logged In' END AS auth,
            'F' || ev.user_id AS "firstName",
            CASE ev.user_id % 2 WHEN 0 THEN 'F' ELSE 'M' END AS gender,
            CAST(ev.event_id % 50 AS INTEGER) AS "itemInSession",
            'L' || (ev.user_id % 20) AS "lastName",
            pa.p_retailprice AS length,
            CASE ev.event_type WHEN 'purchase' THEN 'paid' ELSE 'free' END AS level,
            na.n_name AS location,
            CASE ev.event_type WHEN 'error' THEN 'GET' ELSE 'PUT' END AS method,
            CASE WHEN ev.event_type IN ('view', 'click', 'purchase') THEN 'NextSong' ELSE 'Home' END AS page,
            ev.user_id * 1000 + 1500000000000 AS registration,
            CAST(ev.user_id * 10 + ev.event_id % 7 AS INTEGER) AS "sessionId",
            CASE
                WHEN ev.event_type IN ('error', 'signup') THEN NULL
                WHEN ev.event_id % 11 = 0 THEN 'no such title'
                ELSE pa.p_name || ' ' || (pa.p_partkey % 250)
            END AS song,
            CASE ev.event_type WHEN 'error' THEN 404 ELSE 200 END AS status,
            epoch_us(ev.ts) // 1000 AS ts,
            'agent/' || ev.event_type AS "userAgent",
            CASE WHEN ev.event_type <> 'error' THEN CAST(ev.user_id AS INTEGER) END AS "userId"
        FROM (SELECT *, event_id % (SELECT count(*) FROM part) AS picked FROM events) AS ev
        INNER JOIN part AS pa ON pa.p_partkey = ev.picked
        INNER JOIN nation AS na ON na.n_nationkey = ev.user_id % 25""",
    "song_data": """
        SELECT
            1 AS num_songs,
            'AR' || p_brand || '-' || (p_size % 2) AS artist_id,
            CASE WHEN p_size % 4 >= 2 THEN CAST(10 + p_size % 2 AS DOUBLE) END AS artist_latitude,
            CASE WHEN p_size % 4 >= 2 THEN CAST(-20 - p_size % 2 AS DOUBLE) END AS artist_longitude,
            CASE
                WHEN p_size % 2 = 0 THEN 'City ' || p_brand
                WHEN p_brand IN ('Brand#1', 'Brand#2') THEN ''
            END AS artist_location,
            p_brand AS artist_name,
            'SO' || p_partkey AS song_id,
            p_name || ' ' || (p_partkey % 250) AS title,
            p_retailprice AS duration,
            CASE WHEN p_size % 10 = 0 THEN 0 ELSE 1960 + p_size END AS year
        FROM part""",
    "seconds": """
        SELECT
            CAST(n AS INTEGER) AS time_key,
            strftime(TIMESTAMP '2000-01-01' + to_seconds(n), '%H:%M:%S') AS time_key_sql,
            CAST(n // 3600 AS INTEGER) AS hour,
            CAST(n // 60 % 60 AS INTEGER) AS minute,
            CAST(n % 60 AS INTEGER) AS second,
            CASE WHEN n < 43200 THEN 'AM' ELSE 'PM' END AS am_pm
        FROM generate_series(0, 86399) AS s(n)""",
    "day_span": """
        SELECT CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day FROM orders""",
    "order_days": """
        SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS d FROM day_span""",
    "busy_days": """
        SELECT
            CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
            d AS date_key_sql,
            CAST(weekofyear(d) AS INTEGER) AS week,
            monthname(d) AS month,
            CAST(year(d) AS INTEGER) AS year,
            CASE WHEN isodow(d) IN (6, 7) THEN 'Weekend' ELSE 'Weekday' END AS is_weekday,
            (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = d) AS n_orders
        FROM order_days""",
    "busy_seconds": """
        SELECT seconds.*, coalesce(hits.n, 0) AS n_events
        FROM seconds
        LEFT JOIN (
            SELECT hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS s, count(*) AS n FROM events GROUP BY 1
        ) AS hits ON hits.s = seconds.time_key""",
    "dim_date": """
        SELECT
            CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
            CASE WHEN isodow(d) IN (6, 7) THEN 'Weekend' ELSE 'Weekday' END AS is_weekday
        FROM (
            SELECT unnest(generate_series(DATE '2015-01-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS d
        )""",
    "users": """
        SELECT DISTINCT "userId" AS user_id, "firstName" AS user_first_name, "lastName" AS user_last_name,
               gender AS user_gender, level AS user_level
        FROM song_log WHERE artist IS NOT NULL""",
    "dim_user": """
        SELECT row_number() OVER (
                   ORDER BY user_id NULLS FIRST, user_first_name NULLS FIRST, user_last_name NULLS FIRST,
                            user_gender NULLS FIRST, user_level NULLS FIRST
               ) AS user_key, *
        FROM users""",
    "artists": """
        SELECT DISTINCT artist_id, artist_name, artist_location, artist_longitude, artist_latitude
        FROM song_data WHERE artist_name IS NOT NULL""",
    "dim_artist": """
        SELECT row_number() OVER (
                   ORDER BY artist_id NULLS FIRST, artist_name NULLS FIRST, artist_location NULLS FIRST,
                            artist_latitude NULLS FIRST, artist_longitude NULLS FIRST
               ) AS artist_key, *
        FROM artists""",
    "songs": """
        SELECT DISTINCT dar.artist_key, sda.song_id, sda.artist_id, sda.title AS song_title,
               sda.year AS song_year, sda.duration AS song_duration
        FROM song_data AS sda
        LEFT JOIN dim_artist AS dar USING (artist_id, artist_name, artist_location)
        WHERE sda.artist_id IS NOT NULL""",
    "dim_song": """
        SELECT row_number() OVER (
                   ORDER BY artist_key NULLS FIRST, song_id NULLS FIRST, artist_id NULLS FIRST,
                            song_title NULLS FIRST, song_year NULLS FIRST, song_duration NULLS FIRST
               ) AS song_key, *
        FROM songs""",
    "plays": """
        SELECT *, make_timestamp(ts // 1000 * 1000000) AS start_datetime
        FROM song_log WHERE artist IS NOT NULL AND "userId" IS NOT NULL""",
    "user_lookup": "SELECT user_id, user_key FROM dim_user",
    "artist_lookup": "SELECT artist_name, artist_id, artist_key FROM dim_artist WHERE artist_id IS NOT NULL",
    "song_lookup": "SELECT song_title, artist_id, song_key FROM dim_song",
    "fact": """
        SELECT DISTINCT CAST(strftime(pl.start_datetime, '%Y%m%d') AS INTEGER) AS start_date_key,
               CAST(strftime(pl.start_datetime, '%H%M%S') AS INTEGER) AS start_time_key,
               ul.user_key, al.artist_key, so.song_key, pl.start_datetime, pl.auth,
               CAST(pl."sessionId" AS BIGINT) AS session_id, pl."itemInSession" AS item_in_session,
               pl.method, pl.page, pl.status, pl."userAgent" AS user_agent,
               pl.location AS songplay_location, pl.registration
        FROM plays AS pl
        INNER JOIN artist_lookup AS al ON al.artist_name = pl.artist
        LEFT JOIN song_lookup AS so ON so.artist_id = al.artist_id AND so.song_title = pl.song
        LEFT JOIN user_lookup AS ul ON ul.user_id = pl."userId" """,
    "day_counts": """
        SELECT dd.is_weekday, ds.song_title, da.artist_name, count(*) AS songplay_count
        FROM fact
        LEFT JOIN dim_date AS dd ON dd.date_key = fact.start_date_key
        LEFT JOIN dim_song AS ds ON ds.song_key = fact.song_key
        LEFT JOIN dim_artist AS da ON da.artist_key = fact.artist_key
        GROUP BY ALL""",
    "log_files": """
        SELECT *, 'log-data/' || strftime(ts, '%Y/%m/%d') || '/' || user_id || '.json' AS key FROM events""",
    "ledger": f"""
        SELECT CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS query,
               's3://{BUCKET}/' || key || CASE event_type WHEN 'purchase' THEN '   ' ELSE '' END AS filename,
               ts AS curtime
        FROM log_files WHERE event_type IN ('click', 'purchase')
        UNION ALL
        SELECT l_suppkey, 's3://{BUCKET}/song-data/' || l_partkey || '.json', l_shipdate FROM lineitem""",
    "committed": f"""
        SELECT trim(filename) AS filename
        FROM (SELECT DISTINCT filename FROM ledger WHERE filename LIKE '%{LOG_PREFIX}%')""",
    "gaps": """
        SELECT *, lag(curtime) OVER (PARTITION BY query ORDER BY curtime, filename) AS previous_time FROM ledger""",
    "timing": """
        SELECT query, count(*) AS processed_files,
               CAST(sum(epoch_us(curtime) - epoch_us(previous_time)) AS DOUBLE) / count(*) / 1e6 AS avg_time_per_file
        FROM gaps WHERE previous_time IS NOT NULL GROUP BY query""",
    "sizes": """
        SELECT 'staging_song_log' AS table_name, (SELECT count(*) FROM song_log) AS row_count
        UNION ALL SELECT 'staging_song_data', (SELECT count(*) FROM song_data)
        UNION ALL SELECT 'dim_time', 86400
        UNION ALL SELECT 'dim_date', (SELECT count(*) FROM dim_date)
        UNION ALL SELECT 'dim_user', (SELECT count(*) FROM dim_user)
        UNION ALL SELECT 'dim_artist', (SELECT count(*) FROM dim_artist)
        UNION ALL SELECT 'dim_song', (SELECT count(*) FROM dim_song)
        UNION ALL SELECT 'fact_songplay', (SELECT count(*) FROM fact)""",
}

# Lookups of the variant in which no dimension multiplies a play.
SINGLE_LOOKUPS = {
    "user_lookup": "SELECT user_id, min(user_key) AS user_key FROM dim_user GROUP BY user_id",
    "artist_lookup": """
        SELECT artist_name, arg_min(artist_id, artist_key) AS artist_id, min(artist_key) AS artist_key
        FROM dim_artist WHERE artist_id IS NOT NULL GROUP BY artist_name""",
    "song_lookup": """
        SELECT song_title, artist_id, min(song_key) AS song_key FROM dim_song GROUP BY song_title, artist_id""",
}


def statement(final: str, blocks: dict[str, str] = BLOCKS) -> str:
    """``final`` under a WITH clause of the blocks it needs, directly or not."""
    needed, open_texts = set(), [final]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        for name in (words & blocks.keys()) - needed:
            needed.add(name)
            open_texts.append(blocks[name])
    parts = [f"{name} AS ({text})" for name, text in blocks.items() if name in needed]
    return f"WITH {', '.join(parts)} {final}" if parts else final


def _null_profile(block: str, key: str, columns: dict[str, str]) -> str:
    per_column = [
        f"SELECT '{name}' AS column_name, (SELECT count(*) - count({source}) FROM {block}) AS null_count"
        for name, source in columns.items()
    ]
    return " UNION ALL ".join([f"SELECT '{key}' AS column_name, 0 AS null_count", *per_column])


# The columns of the staged log and of the fact, in their order.
_LOG_COLUMNS = (
    "artist", "auth", "firstName", "gender", "itemInSession", "lastName", "length", "level", "location", "method", "page",
    "registration", "sessionId", "song", "status", "ts", "userAgent", "userId",
)
_FACT_COLUMNS = (
    "start_date_key", "start_time_key", "user_key", "artist_key", "song_key", "start_datetime", "auth", "session_id",
    "item_in_session", "method", "page", "status", "user_agent", "songplay_location", "registration",
)

_LINKS = (
    ("fact_songplay", "start_date_key", "SELECT start_date_key AS key FROM fact", "SELECT date_key AS key FROM dim_date"),
    ("fact_songplay", "start_time_key", "SELECT start_time_key AS key FROM fact", "SELECT time_key AS key FROM seconds"),
    ("fact_songplay", "user_key", "SELECT user_key AS key FROM fact", "SELECT user_key AS key FROM dim_user"),
    ("fact_songplay", "artist_key", "SELECT artist_key AS key FROM fact", "SELECT artist_key AS key FROM dim_artist"),
    ("fact_songplay", "song_key", "SELECT song_key AS key FROM fact", "SELECT song_key AS key FROM dim_song"),
    ("dim_song", "artist_key", "SELECT artist_key AS key FROM dim_song", "SELECT artist_key AS key FROM dim_artist"),
)

_ORPHANS = " UNION ALL ".join(
    f"""SELECT '{child}' AS table_name, '{column}' AS column_name,
               (SELECT count(*) FROM ({used}) AS u WHERE u.key IS NOT NULL
                AND NOT EXISTS (SELECT 1 FROM ({known}) AS k WHERE k.key = u.key)) AS orphan_rows"""
    for child, column, used, known in _LINKS
)

_PLAYS_PER_HALF = """
    SELECT seconds.am_pm, count(*) AS song_plays
    FROM fact LEFT JOIN seconds ON seconds.time_key = {clock}
    GROUP BY seconds.am_pm"""


def oracle_statements() -> dict[str, str]:
    finals = {
        "load_log_json": "SELECT * FROM song_log",
        "load_manifest_auto": "SELECT * FROM song_data",
        "generate_manifest": """
            SELECT DISTINCT 'day=' || strftime(ts, '%Y-%m-%d') AS folder, TRUE AS mandatory
            FROM events WHERE day(ts) % 2 = 1""",
        "incremental_errors": """
            SELECT 'SO' || p_partkey AS song_id, TRUE AS tighter_rejected FROM part WHERE p_partkey % 10 <> 0""",
        "load_song_json": "SELECT * FROM song_data",
        "load_song_json_by_name": "SELECT * FROM song_data",
        "load_json_maxerror": """
            SELECT CASE WHEN p_size <> 50 THEN 'SO' || p_partkey END AS song_id,
                   CASE WHEN p_size <> 50 THEN p_name || ' ' || (p_partkey % 250) END AS title,
                   CASE WHEN p_size = 50 THEN NULL WHEN p_size % 10 = 0 THEN 0 ELSE 1960 + p_size END AS year,
                   CASE WHEN p_size = 50 THEN 'rejected' ELSE 'loaded' END AS outcome
            FROM part""",
        "csv_roundtrip_dim_date": "SELECT * FROM busy_days",
        "csv_roundtrip_dim_time": "SELECT * FROM busy_seconds",
        "csv_roundtrip_documents": "SELECT * FROM documents",
        "csv_roundtrip_pages": "SELECT * FROM pages",
        "dim_date": "SELECT * FROM busy_days",
        "dim_time": "SELECT * FROM busy_seconds",
        "list_files": "SELECT DISTINCT 'log-data/day=' || strftime(ts, '%Y-%m-%d') AS folder FROM events",
        "list_keys_prefix": "SELECT url FROM pages WHERE starts_with(url, 'https://')",
        "list_keys_head": f"SELECT url FROM pages WHERE starts_with(url, 'https://') ORDER BY url LIMIT {HEAD}",
        "committed_files": "SELECT filename FROM committed",
        "new_files": f"""
            SELECT 's3://{BUCKET}/' || key AS filename FROM log_files WHERE starts_with(key, '{LOG_PREFIX}')
            EXCEPT SELECT filename FROM committed""",
        "manifest_roundtrip": "SELECT DISTINCT url, TRUE AS mandatory FROM pages",
        "staging_song_log": "SELECT * FROM song_log",
        "staging_song_data": "SELECT * FROM song_data",
        "dim_user": "SELECT * FROM dim_user",
        "dim_artist": "SELECT * FROM dim_artist",
        "dim_song": "SELECT * FROM dim_song",
        "dim_song_null_safe": """
            SELECT DISTINCT dar.artist_key, sda.song_id, sda.artist_id, sda.title AS song_title,
                   sda.year AS song_year, sda.duration AS song_duration
            FROM song_data AS sda
            LEFT JOIN dim_artist AS dar
                ON dar.artist_id IS NOT DISTINCT FROM sda.artist_id
                AND dar.artist_name IS NOT DISTINCT FROM sda.artist_name
                AND dar.artist_location IS NOT DISTINCT FROM sda.artist_location
            WHERE sda.artist_id IS NOT NULL""",
        "fact_songplay": "SELECT * FROM fact",
        "epoch_to_keys": """
            SELECT event_id, ms AS ts, t AS start_datetime,
                   CAST(strftime(t, '%Y%m%d') AS INTEGER) AS start_date_key,
                   CAST(strftime(t, '%H%M%S') AS INTEGER) AS start_time_key,
                   CAST(hour(t) * 3600 + minute(t) * 60 + second(t) AS INTEGER) AS second_of_day
            FROM (
                SELECT event_id, epoch_us(ts) // 1000 AS ms, date_trunc('second', ts) AS t FROM events
            )""",
        "table_counts": "SELECT table_name, row_count FROM sizes",
        "plays_by_am_pm": _PLAYS_PER_HALF.format(clock="fact.start_time_key"),
        "plays_by_am_pm_fixed": _PLAYS_PER_HALF.format(
            clock="date_diff('second', date_trunc('day', fact.start_datetime), fact.start_datetime)"
        ),
        "plays_by_hour": """
            SELECT CAST(hour(start_datetime) AS INTEGER) AS hour, count(*) AS song_plays
            FROM fact GROUP BY hour(start_datetime)""",
        "song_artist_daytype_counts": "SELECT * FROM day_counts",
        "top_song_by_daytype": """
            SELECT is_weekday, song_title, artist_name, songplay_count
            FROM day_counts
            QUALIFY row_number() OVER (
                PARTITION BY is_weekday
                ORDER BY songplay_count DESC, song_title ASC NULLS LAST, artist_name ASC NULLS LAST
            ) = 1""",
        "songplay_filter_compare": """
            SELECT count(artist) AS artist_given,
                   count(*) FILTER (page = 'NextSong') AS page_next_song,
                   count(artist) FILTER (page = 'NextSong') AS both,
                   count(artist) FILTER (page IS DISTINCT FROM 'NextSong') AS artist_only,
                   count(*) FILTER (page = 'NextSong' AND artist IS NULL) AS page_only
            FROM song_log""",
        "null_profile_log": _null_profile("song_log", "song_log_id", {c: f'"{c}"' for c in _LOG_COLUMNS}),
        "null_profile_fact": _null_profile("fact", "songplay_key", {c: c for c in _FACT_COLUMNS}),
        "fk_orphans": _ORPHANS,
        "checks_incremental": _ORPHANS,
        "report_incremental": "SELECT * FROM day_counts",
        "pk_duplicates": """
            SELECT table_name, 0 AS duplicate_keys FROM sizes
            UNION ALL
            SELECT 'dim_user by user_id', count(*) FROM (SELECT user_id FROM dim_user GROUP BY user_id HAVING count(*) > 1)
            UNION ALL
            SELECT 'staging_song_log by sessionId', count(*)
            FROM (SELECT "sessionId" FROM song_log GROUP BY "sessionId" HAVING count(*) > 1)""",
        "load_errors": """
            SELECT 'part=' || (number % 4) AS folder, CASE WHEN number % 10 <> 0 THEN 'year' END AS "column",
                   CASE WHEN number % 10 = 0 THEN substr('{"num_songs":1,"artist_id":"AR', 1, 20) ELSE odd_year END AS value,
                   CAST(CASE WHEN number % 10 = 0 THEN 20 ELSE length(odd_year) END AS BIGINT) AS length,
                   CASE WHEN number % 10 = 0 THEN 'not JSON' ELSE 'not int' END AS reason
            FROM (SELECT p_partkey AS number, 'year ' || CASE WHEN p_size % 10 = 0 THEN 0 ELSE 1960 + p_size END AS odd_year FROM part)
            WHERE number % 10 = 0 OR number % 7 = 0""",
        "load_timing_own": "SELECT CAST(0 AS BIGINT) AS query, count(DISTINCT p_partkey % 20) - 1 AS processed_files, TRUE AS takes_time FROM part",
        "incremental_star": """
            SELECT fact.* EXCLUDE (user_key, artist_key, song_key), us.* EXCLUDE (user_key), ar.* EXCLUDE (artist_key),
                   so.song_id, so.song_title, so.song_year
            FROM fact
            LEFT JOIN dim_user AS us ON us.user_key = fact.user_key
            LEFT JOIN dim_artist AS ar ON ar.artist_key = fact.artist_key
            LEFT JOIN dim_song AS so ON so.song_key = fact.song_key""",
        "load_timing": "SELECT query, processed_files, avg_time_per_file FROM timing",
        "load_timing_of_one": f"""
            SELECT count(*) AS processed_files,
                   CAST(sum(epoch_us(curtime) - epoch_us(previous_time)) AS DOUBLE) / count(*) / 1e6
                       AS avg_time_per_file
            FROM gaps WHERE query = {ONE_LOAD} AND previous_time IS NOT NULL""",
        "load_gaps": "SELECT query, filename, curtime, previous_time FROM gaps",
        "insert_append": "SELECT * FROM dim_user",
        "table_lifecycle": """
            SELECT 'refresh' AS step, table_name, row_count FROM sizes
            UNION ALL
            SELECT step, table_name, CASE WHEN table_name IN ('dim_time', 'dim_date') THEN row_count ELSE 0 END
            FROM sizes CROSS JOIN (VALUES ('reset'), ('truncate')) AS s(step)""",
        "incremental_load": _LOADS,
        "incremental_stream": _LOADS,
    }
    oracles = {name: statement(final) for name, final in finals.items()}
    oracles["fact_songplay_deduped"] = statement("SELECT * FROM fact", {**BLOCKS, **SINGLE_LOOKUPS})
    return oracles


_LOADS = """
    SELECT CAST(page IS DISTINCT FROM 'NextSong' AS BIGINT) AS load_batch, count(*) AS n_rows,
           count("userId") AS n_known_users, min(ts) AS first_ts, max(ts) AS last_ts
    FROM song_log GROUP BY 1"""
