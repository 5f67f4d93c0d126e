"""The generated benchmark tables in the role of the warehouse's raw inputs.

``events`` with ``part`` and ``nation`` stand in for the activity log, ``part``
for the song records, and ``events`` with ``lineitem`` for the load ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstar.functions.moments import millis_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def song_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity records, one per event, without the staging identity."""
    part = table(spark, sf_dir, "part")
    # Parts are numbered from 0; the count comes from the Parquet footers.
    picked = F.col("event_id") % F.lit(part.count())
    joined = (
        table(spark, sf_dir, "events")
        .join(part, F.col("p_partkey") == picked)
        .join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("user_id") % 25)
    )
    kind = F.col("event_type")
    title = F.concat("p_name", F.lit(" "), (F.col("p_partkey") % 250).cast("string"))
    unnamed = kind.isin("error", "signup")
    return joined.select(
        F.when(~unnamed, F.col("p_brand")).alias("artist"),
        F.when(kind == "error", "Logged Out").otherwise("Logged In").alias("auth"),
        F.concat(F.lit("F"), F.col("user_id").cast("string")).alias("firstName"),
        F.when(F.col("user_id") % 2 == 0, "F").otherwise("M").alias("gender"),
        (F.col("event_id") % 50).cast("int").alias("itemInSession"),
        F.concat(F.lit("L"), (F.col("user_id") % 20).cast("string")).alias("lastName"),
        F.col("p_retailprice").alias("length"),
        F.when(kind == "purchase", "paid").otherwise("free").alias("level"),
        F.col("n_name").alias("location"),
        F.when(kind == "error", "GET").otherwise("PUT").alias("method"),
        F.when(kind.isin("view", "click", "purchase"), "NextSong").otherwise("Home").alias("page"),
        (F.col("user_id") * 1000 + F.lit(1_500_000_000_000)).alias("registration"),
        (F.col("user_id") * 10 + F.col("event_id") % 7).cast("int").alias("sessionId"),
        F.when(~unnamed, F.when(F.col("event_id") % 11 == 0, "no such title").otherwise(title)).alias("song"),
        F.when(kind == "error", 404).otherwise(200).alias("status"),
        millis_of(F.col("ts")).alias("ts"),
        F.concat(F.lit("agent/"), kind).alias("userAgent"),
        F.when(kind != "error", F.col("user_id").cast("int")).alias("userId"),
    )


def song_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Song records, one per part, without the staging identity."""
    size = F.col("p_size")
    placed = ~(size % 4 < 2)
    place = (
        F.when(size % 2 == 0, F.concat(F.lit("City "), "p_brand"))
        .when(F.col("p_brand").isin("Brand#1", "Brand#2"), "")
        .otherwise(F.lit(None))
    )
    return table(spark, sf_dir, "part").select(
        F.lit(1).alias("num_songs"),
        F.concat(F.lit("AR"), "p_brand", F.lit("-"), (size % 2).cast("string")).alias("artist_id"),
        F.when(placed, (10 + size % 2).cast("double")).alias("artist_latitude"),
        F.when(placed, (-20 - size % 2).cast("double")).alias("artist_longitude"),
        place.alias("artist_location"),
        F.col("p_brand").alias("artist_name"),
        F.concat(F.lit("SO"), F.col("p_partkey").cast("string")).alias("song_id"),
        F.concat("p_name", F.lit(" "), (F.col("p_partkey") % 250).cast("string")).alias("title"),
        F.col("p_retailprice").alias("duration"),
        F.when(size % 10 == 0, 0).otherwise(1960 + size).alias("year"),
    )


def log_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the log files in the bucket: one per user and day."""
    return table(spark, sf_dir, "events").select(_log_key().alias("key")).distinct()


def _log_key():
    day = F.date_format("ts", "yyyy/MM/dd")
    return F.concat(F.lit("log-data/"), day, F.lit("/"), F.col("user_id").cast("string"), F.lit(".json"))


def load_ledger(spark: SparkSession, sf_dir: str, bucket: str) -> DataFrame:
    """(query, filename, curtime): log files some play has been loaded from, and
    song files; the names of paid plays are space-padded as fixed-width text is."""
    kind = F.col("event_type")
    log_name = F.concat(F.lit(f"s3://{bucket}/"), _log_key())
    logs = (
        table(spark, sf_dir, "events")
        .where(kind.isin("click", "purchase"))
        .select(
            F.date_format("ts", "yyyyMMdd").cast("bigint").alias("query"),
            F.when(kind == "purchase", F.concat(log_name, F.lit("   "))).otherwise(log_name).alias("filename"),
            F.col("ts").alias("curtime"),
        )
    )
    songs = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("query"),
        F.concat(F.lit(f"s3://{bucket}/song-data/"), F.col("l_partkey").cast("string"), F.lit(".json")).alias("filename"),
        F.col("l_shipdate").alias("curtime"),
    )
    return logs.unionByName(songs)
