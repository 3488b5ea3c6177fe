"""The corpus pipeline: stages over documents, each written as Parquet and reread.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of documents, of whatever names (those that
begin with _wf_ are reserved).
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.llm import byte_bpe, decontaminate, language, minhash, quality
from wayfold.llm.common import in_remainder, materialize, new_path

#: Texts whose n-grams a language's filter explains less than this are in none of the learned languages.
LEAST_LANGUAGE_SCORE = 0.3
LEAST_QUALITY = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learned language; rejects those without letters or in none of them."""
    model = language.learn(docs, F.col("doc_id").isNotNull() & ~in_remainder("doc_id", 4, 2))
    named = language.predict(docs, model, lang_out="_wf_lang", score_out="_wf_score")
    kept = (F.col("_wf_lang") != language.UNKNOWN) & (F.col("_wf_score") >= LEAST_LANGUAGE_SCORE)
    return named.where(kept).select(*docs.columns)


def rank_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents at or above the quality threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    measured = materialize(quality.features(docs, ["doc_id"]), "quality-features")
    model = quality.learn(measured, labels, ~in_remainder("doc_id", 5, 0))
    scored = quality.score(quality.features(docs, docs.columns), model, "_wf_quality")
    return scored.where(F.col("_wf_quality") >= LEAST_QUALITY).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked at similarity 0.8 of five-word shingles."""
    return minhash.with_text(minhash.near_duplicates(docs, prefix="_wf_").where("_wf_keeper"), docs).select(*docs.columns)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents that hold a benchmark window of ten words."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of them and of what they decode to."""
    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("quality", rank_quality),
    ("near_duplicates", remove_near_duplicates),
    ("decontaminate", decontaminate_benchmark),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Stages learn classifiers, which SQL can't express; tests hold them against brute force.
ORACLE_SQL: str | None = None
