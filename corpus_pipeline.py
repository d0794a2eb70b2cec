"""Corpus pipeline: five stages of the training-data operators, each written and read again.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last return the columns of ``documents``, and
each works on all that its predecessor kept:

1. quality rules         documents that the weighted rules reject go
2. n-gram Jaccard join   of each group of linked documents the smallest doc_id stays
3. decontamination       documents in which a benchmark window occurs go
4. secret scans          secrets in the texts are replaced by a mark
5. SentencePiece         piece ids of the best segmentation, its score, and whether they decode to the text

Empty tables pass through; rows are kept or dropped one by one, so nulls and
repeated rows follow the operators' own rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontamination, ngram_jaccard, quality_rules, secret_scan, sentencepiece_nbest
from tidemark.llm._stage import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_nbest.encode(docs).select("doc_id", "n_pieces", "ids", F.col("scores")[0].alias("score"), "round_trip")


STAGES = [("quality rules", quality), ("n-gram jaccard join", jaccard), ("benchmark decontamination", decontaminate),
          ("secret scans", secrets), ("sentencepiece", pieces)]

#: The votes are weighed by expectation-maximisation, which SQL cannot express; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, "pipeline")
    return docs
