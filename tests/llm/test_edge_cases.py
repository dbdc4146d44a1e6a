"""Whole operators on tables of nulls only, and with extra columns of odd types and names."""

import json

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orefold.llm import mixing, near, quality, spans

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory, spark, labels):
    folder = str(tmp_path_factory.mktemp("tables"))
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def nulls(spark, empty):
    return spark.createDataFrame([(1, None, None, None, None), (None, "", None, None, 0), (2, None, "en", "s", None)], COLUMNS)


@pytest.fixture(scope="module")
def odd(spark, docs):
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").filter("doc_id < 99 OR doc_id > 99 OR doc_id IS NULL")
    extra = F.struct(F.lit(1).alias("x y"), F.lit("a").alias("k:v"), F.array(F.lit(2)).alias("`t")).alias("rest, <of> it")
    return rows.withColumn("text ", F.lit("b")).select("*", extra, F.create_map(F.lit("k"), F.lit(1)).alias("m"))


def test_quality_of_null_texts(nulls, labels):
    out = quality.select(nulls, labels).collect()
    assert len(out) == 3 and all(r.log_weight == 0 and r.kept for r in out)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_null_texts(spark, nulls, sf_dir, name):
    out = dict(corpus_pipeline.STAGES)[name](spark, nulls, sf_dir)
    rows = out.collect()
    assert all(r.doc_id in (1, 2, None) for r in rows)
    if name in ("quality", "near_copies", "passages"):
        assert len(rows) == 3 and out.columns == nulls.columns


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_empty_tables(spark, empty, sf_dir, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, empty, sf_dir).count() == 0


def test_extra_columns(odd, labels):
    seen = {json.dumps(r.asDict(True), default=str, sort_keys=True) for r in odd.drop("text", "n_chars").collect()}
    for out in (quality.keep(odd, labels), near.keep(odd), spans.dedup_rows(odd), mixing.mix(odd)):
        assert out.columns == odd.columns
        rows = out.drop("text", "n_chars").collect()
        assert rows and {json.dumps(r.asDict(True), default=str, sort_keys=True) for r in rows} <= seen
