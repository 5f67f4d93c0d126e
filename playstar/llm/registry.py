"""The operators of this subpackage as queries over whole tables: ``opN_<name>``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstar.llm import (
    ann,
    byte_bpe,
    conversation_repair,
    embed_dedup,
    oracles,
    packing,
    quality,
    resampling,
    sharding,
    simhash,
    substring_dedup,
    token_count,
    toxicity,
    url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_distance=2)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), size=4096, end_id=2)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


#: Host, path and verdict of the rules that every url is judged by.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = byte_bpe.decode(byte_bpe.encode(_table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), limit=4096)


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


SHARDS = [f"shard-{i:02d}" for i in range(64)]


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], SHARDS)


def op8_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.train_and_score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.3)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, threshold=0.7).drop("sentences")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.deduplicate(_table(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations as a faulty collector might deliver them, each row's fate drawn by its id and turn; nulls count as one space."""
    spaced = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")}
    fate = F.crc32(F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"]).cast("binary")) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = conversations.select("conv_id", "turn", spaced["role"].alias("role"), spaced["text"].alias("text"), fate.alias("fate"))
    rows = rows.where("fate <> 0").withColumns({"role": F.when(F.col("fate") == 4, "user").otherwise(F.col("role")), "text": text})
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", F.explode(copies).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversation_repair.repair(damaged(given)).report().withColumnRenamed("conv_id", "found_id")
    every = given.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").drop("found_id")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return every.na.fill(0, numbers).select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=25, seed=7)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_simhash,
        op2_packing,
        op3_url_filter,
        op4_byte_bpe,
        op5_token_count,
        op6_ann,
        op7_sharding,
        op8_embed_dedup,
        op9_quality,
        op10_toxicity,
        op11_substring_dedup,
        op12_conversation_repair,
        op13_resampling,
    )
}

_URL_RULES_SQL = ", ".join(str(rule) for rule in URL_RULES)
_SHARD_NAMES_SQL = ", ".join(f"'{name}'" for name in SHARDS)

#: The same rows as DuckDB SQL, where SQL can express the operator.
ORACLES: dict[str, str] = {
    "op3_url_filter": f"""
        WITH cut AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut
        ), rules(rule_host, rule_path, rule_verdict) AS (VALUES {_URL_RULES_SQL})
        SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
        FROM (
            SELECT page_id, host, path, (
                SELECT arg_max({{'rule': rule_host || rule_path, 'verdict': rule_verdict}}, length(rule_host || rule_path))
                FROM rules
                WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            ) AS best
            FROM parts
        )""",
    "op7_sharding": f"""
        WITH slots AS (
            SELECT doc_id, CAST(CAST('0x' || substr(md5(
                CASE WHEN doc_id IS NULL THEN 'null' ELSE length(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
            ), 1, 15) AS BIGINT) % {sharding.TABLE_SIZE} AS INTEGER) AS slot
            FROM documents
        )
        SELECT doc_id, slot, [{_SHARD_NAMES_SQL}][{sharding.lookup_table(SHARDS)}[slot + 1] + 1] AS shard
        FROM slots""",
    "op11_substring_dedup": oracles.SUBSTRINGS,
    "op12_conversation_repair": oracles.CONVERSATIONS,
    "op13_resampling": oracles.RESAMPLING,
}
