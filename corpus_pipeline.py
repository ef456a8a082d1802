"""The corpus pipeline: five stages, each over all rows that its predecessor kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame that is written and read again as the next one's docs. All but the last
return the columns of documents. Each stage takes nulls, empty and very long texts, ties,
repeated rows and further columns as its operator states; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftgraph.llm import exact_dedup, mixing, ngram_join, packing, tokens, toxicity
from weftgraph.llm.common import documents, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.5 or more go. Null and empty texts have the prior's
    score and stay; repeated rows go or stay together; without labels nothing goes."""
    index = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, index)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for A-Z's case, the row with the largest doc_id stays; null
    texts count as empty ones; of rows that tie in the id, or have none, one stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of Jaccard similarity 0.75 or more connect, the one with the least
    doc_id stays. Texts without words link with none, so all of them stay; of repeated rows one does."""
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: whole epochs, and the part of one that the
    budget's rest takes. Texts without words go; a null source is one of its own."""
    return mixing.apply(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents in sequences of at most 1024 tokens, each with its end id; null texts are that alone."""
    return packing.pack(docs, tokens.vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: Scores and token ids are beyond SQL; tests/llm/test_whole.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"stage{k}")
    return docs
