"""The operators as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, centroids, encoding, fingerprints, jaccard, licences, mixing, near, outliers, quality, sequences, spans, toxicity
from .stored import documents, importable

VOCABULARY = "word_bpe_49k.json"
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "passages"
    )


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return licences.label(docs, licences.fit(docs)).withColumn("families", F.array_join("families", ","))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = quality.select(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return chosen.select("doc_id", "log_weight", "key", "kept")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(documents(spark, sf_dir))


def op5_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def op6_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    description = encoding.vocabulary(public_tokenizers.path(VOCABULARY))
    return sequences.read(sequences.write(documents(spark, sf_dir), description, end_id=2))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encoding.encode(documents(spark, sf_dir), encoding.vocabulary(public_tokenizers.path(VOCABULARY)))
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op9_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The digest is of the words, one blank between them.
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    out = spans.dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_units", "n_removed", F.md5(words.cast("binary")).alias("kept_md5"))


def op10_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = near.join(documents(spark, sf_dir), k=4, percent=80)
    return joined.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op11_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir), k=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path(PIECES), "rb") as file:
        model = file.read()
    return alignment.align(documents(spark, sf_dir), encoding.vocabulary(public_tokenizers.path(BYTES)), model)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_licences, op3_quality, op4_fingerprints, op5_outliers, op6_sequences, op7_bpe, op8_mixing, op9_spans, op10_near,
        op11_jaccard, op12_centroids, op13_alignment,
    )
}

ORACLE_SQL: dict[str, str] = {"op9_spans": spans.ORACLE, "op12_centroids": centroids.oracle()}
