"""The queries of this package and the SQL that tells the same, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.llm import byte_bpe, decontaminate, language, line_dedup, minhash, periodic_runs, quality, spherical_caps, token_count, toxicity, url_filter, warc_zip, whitening
from wayfold.llm.common import in_remainder, materialize, new_path


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = materialize(quality.features(_read(spark, sf_dir, "documents"), ["doc_id"]), "quality-features")
    held_out = in_remainder("doc_id", 5, 0)
    model = quality.learn(measured, _read(spark, sf_dir, "labels"), ~held_out)
    scored = quality.score(measured, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_count.count_tokens(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _read(spark, sf_dir, "documents"), in_remainder("doc_id", 5, 0)
    model = toxicity.learn(docs, _read(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spherical_caps.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), in_remainder("doc_id", 4, 2)
    model = language.learn(docs, F.col("doc_id").isNotNull() & ~held_out)
    return language.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


#: Rules of the query: verdict, host and path.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, ngram=4).select("doc_id", "n_shingles", "component_id", "kept")


def op10_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = _read(spark, sf_dir, "pages"), new_path(spark, "packages")
    records = warc_zip.read_packages(warc_zip.write_packages(pages, folder), folder, pages.schema["page_id"].dataType.simpleString())
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    chosen = F.when(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, periodic_runs.split_words(F.col("text")))
    docs = docs.withColumn("_wf_words", F.explode(F.array(chosen)))  # explode of one item binds the words once
    found = periodic_runs.periodic_runs(docs.select("doc_id", periodic_runs.planted().alias("text")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period", F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_quality": op2_quality,
    "op3_token_count": op3_token_count,
    "op4_toxicity": op4_toxicity,
    "op5_spherical_caps": op5_spherical_caps,
    "op6_decontaminate": op6_decontaminate,
    "op7_language": op7_language,
    "op8_url_filter": op8_url_filter,
    "op9_minhash": op9_minhash,
    "op10_warc_zip": op10_warc_zip,
    "op11_line_dedup": op11_line_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_whitening": op13_whitening,
}
ORACLE_SQL: dict[str, str] = {
    "op5_spherical_caps": spherical_caps.LINKS_SQL,
    "op6_decontaminate": decontaminate.DIGEST_SQL,
    "op9_minhash": minhash.COMPONENTS_SQL,
    "op10_warc_zip": warc_zip.RECORDS_SQL,
    "op11_line_dedup": line_dedup.KEPT_SQL,
}
