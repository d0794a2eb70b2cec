"""Registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (conversation_repair, decontamination, license_scan, maxent_lm, ngram_jaccard, periodic_runs, quality_rules, secret_scan, sentencepiece_nbest,
               suffix_dedup, token_counts, toxicity, warc_bundles)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _bench(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(_docs(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_components(_docs(spark, sf_dir))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(_docs(spark, sf_dir))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(_docs(spark, sf_dir))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(_docs(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_docs(spark, sf_dir))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(_docs(spark, sf_dir), _bench(spark, sf_dir))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best segmentation (pieces, digest of its ids), the three best scores as text, whether decoding gives the text back, and the digests of the ids of all three."""
    df = sentencepiece_nbest.encode_digest(_docs(spark, sf_dir))
    return df.select("doc_id", "n_pieces", "ids_sha256", F.array_join(F.transform("scores", lambda s: s.cast("decimal(20,0)").cast("string")), ",").alias("scores"), "round_trip",
                     F.array_join("nbest_sha256", ",").alias("nbest_sha256"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.lm_scores(_docs(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(_docs(spark, sf_dir))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_bundles.page_records(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_quality_rules, op2_ngram_jaccard_join, op3_secret_scans, op4_suffix_array_dedup, op5_license_scans, op6_toxicity, op7_token_counts, op8_benchmark_decontamination,
    op9_sentencepiece, op10_lm_scoring, op11_conversation_repair, op12_periodic_runs, op13_warc, pipeline)}

ORACLES: dict[str, str] = {
    "op2_ngram_jaccard_join": ngram_jaccard.ORACLE,
    "op4_suffix_array_dedup": suffix_dedup.ORACLE,
    "op8_benchmark_decontamination": decontamination.ORACLE,
}
