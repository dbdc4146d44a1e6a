"""A training corpus in five stages; each reads what the one before has written."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orefold.llm import encoding, mixing, near, quality, spans
from orefold.llm.stored import documents, importable, stored

#: Words of a shingle, and hundredths of similarity, of near copies.
SHINGLE, SIMILAR = 5, 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    importable(spark)
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id."""
    importable(spark)
    return near.keep(docs, SHINGLE, SIMILAR)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; ``n_chars`` follows the text."""
    importable(spark)
    return spans.dedup_rows(docs).selectExpr(*[
        "CAST(char_length(text) AS BIGINT) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns
    ])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    importable(spark)
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) and the text they decode to."""
    importable(spark)
    return encoding.encode(docs, encoding.vocabulary(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("passages", drop_repeated_passages),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: The stages are not expressible in SQL: tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
