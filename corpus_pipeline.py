"""Corpus pipeline over ``documents``: quality rules, language ID, near-duplicate
removal, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and reread as the next stage's ``docs``, so a lost executor
never reaches back beyond the running stage. All stages but the last return
the columns of ``documents``; every stage works on all rows that the one
before it kept. Null, empty and repeated rows are treated as the operators'
docstrings say: null and empty texts fail the quality rules, repeated rows
leave one row after the third stage, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiforge.llm import language_id, order_minhash, packing, quality_rules, secret_scan
from kpiforge.llm.queries import vocabulary
from kpiforge.session import cut_lineage


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in their language's band of
    n-gram perplexity."""
    return quality_rules.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are mainly in one of the corpus's languages."""
    return language_id.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each near-duplicate class."""
    return order_minhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts and n_chars to match."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the documents, one row per piece of a document."""
    return packing.pack(docs, vocabulary())


STAGES = [("quality_rules", rules), ("language_id", language), ("near_duplicates", near_duplicates),
          ("secret_scan", secrets), ("packing", pack)]

# language models, alignments and a tokenizer are beyond SQL: see tests/llm/test_cotraining_and_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
