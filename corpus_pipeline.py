"""Corpus pipeline: quality classifier, near-dedup, decontamination, secret masking, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next stage's ``docs``. All
stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabkit.llm import decontaminate, minhash, packing, quality, secrets
from tabkit.llm.common import parquet, ship_package, written
from tabkit.llm.queries import VOCABULARY


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier predicts 0 for."""
    ship_package(spark)
    return quality.keep_good(docs, parquet(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the smallest doc_id, of each group of near copies."""
    ship_package(spark)
    return minhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    ship_package(spark)
    return decontaminate.keep_clean(docs, parquet(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret that the scan reports; keeps every document."""
    ship_package(spark)
    return secrets.masked(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences; one row per piece, with its ids."""
    ship_package(spark)
    return packing.pack_documents(docs, VOCABULARY, with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: Trained scores, MinHash and a tokeniser's ids have no SQL form; tests hold the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
