"""From raw documents to packed sequences: classify, apply rules, drop near duplicates, mask secrets, pack.

Each stage reads the Parquet that the one before it wrote. All but the last return the columns of documents, whatever
further columns there are. Every stage takes NULLs in any column, repeated rows and ids, and very long texts (worked on
whole), and turns an empty table into an empty one; what becomes of NULL and empty texts is said with each.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.functions.storage import materialize
from emberline.llm.common import read_table
from emberline.llm.ngram_join import deduplicate
from emberline.llm.packing import pack_documents
from emberline.llm.quality_classifier import keep_good
from emberline.llm.quality_rules import keep_by_rules
from emberline.llm.secret_scan import mask_secrets


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by the labels of ``sf_dir``, predicts as good; NULL and empty texts are scored as texts without words."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base checks and that the rules' votes find good: NULL and empty texts don't."""
    return keep_by_rules(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest id, of each component of linked documents; see ``deduplicate`` for repeated ids and NULL."""
    return deduplicate(docs)


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced in their texts; n_chars follows, and stays where the text is NULL."""
    return mask_secrets(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences; NULL and empty texts are the end mark alone."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


STAGES = [("quality_classifier", classify), ("quality_rules", apply_rules), ("ngram_join", drop_near_duplicates),
          ("secret_scan", mask), ("best_fit_packing", pack)]

#: Learnt weights and token ids can't be had in SQL: tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
