"""From raw documents to packed training sequences: language, quality, near duplicates, benchmark passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import decontaminate, langid, packing, quality, simhash
from parcelflow.llm.common import every_column
from parcelflow.session import materialise

MIN_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: texts without letters and uncertain ones go."""
    whole = docs.select(F.struct(*every_column(docs)).alias("row"), F.col("text").alias("text"))
    found = langid.predict(whole, langid.train(docs))
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def clean_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text is within their language's threshold."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), threshold=0.8, shingle=5)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their places in training sequences."""
    found = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), cut="space", end_id=0, size=2048)
    return packing.pack(found, size=2048)


STAGES = [
    ("language", language),
    ("quality", clean_text),
    ("near_duplicates", near_duplicates),
    ("decontaminate", benchmark_free),
    ("packing", sequences),
]

ORACLE_SQL = None  # language, quality and packing are no SQL; tests/llm/test_pipeline.py holds every stage against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
