"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, media, mixing, ngram_join, packing, sharding, store, substring_dedup, token_counts, tokens, toxicity
from .common import documents

SHARDS = 40


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), tokens.vocabulary("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(documents(spark, sf_dir))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = store.write(documents(spark, sf_dir), tokens.vocabulary("word_bpe_49k.json"))
    return store.digest(spark, made)


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = media.read_media(media.store_text(documents(spark, sf_dir)))
    shown = F.transform("clips", lambda c: F.concat_ws(":", c["first_frame"], c["n_frames"], c["level"]))
    return read.select(
        "doc_id", "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -64, 64)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(";", shown).alias("feature"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    index = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, index).select("doc_id", "held_out", "score", "predicted")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokens.vocabulary("piece_bpe_32k.model"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("source")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir), sharding.topology(SHARDS), sharding.topology(SHARDS + 1))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(documents(spark, sf_dir)).drop("row", "first")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_substring_dedup, op3_ngram_join, op4_token_store, op5_media, op6_toxicity, op7_token_counts, op8_mixing, op9_sharding, op10_exact_dedup)}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring_dedup": substring_dedup.SQL,
        "op3_ngram_join": ngram_join.SQL,
        "op8_mixing": mixing.SQL,
        "op9_sharding": sharding.sql(sharding.topology(SHARDS), sharding.topology(SHARDS + 1)),
        "op10_exact_dedup": exact_dedup.SQL,
    }
