"""A training corpus from the table documents: filter, deduplicate, redact, mix and pack.

Every stage takes nulls in any column, empty and very long texts, repeated rows and empty tables,
and passes on all columns of its input, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from registrum.llm import minhash, mixing, packing, pii, rules
from registrum.llm.workspace import Workspace
from registrum.session import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule and no host verdict rejects.

    A null text has no words and is rejected; null sources are one host; equal rows fare alike.
    """
    ship(spark)
    return rules.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares at least 0.8 of its five-word shingles: the smallest doc_id.

    Rows with a null or wordless text or a null doc_id all stay; of equal rows one stays; of rows that
    share a doc_id each is judged by its own text.
    """
    ship(spark)
    return minhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; a null text stays null, and every row stays."""
    ship(spark)
    return pii.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights, as many tokens as there are.

    Null languages and sources are leaves of their own; equal rows are interchangeable; rows that tie
    in the seeded order are told apart by their texts.
    """
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens; a null text is the end id alone, a null doc_id stays null."""
    ship(spark)
    return packing.packed(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_duplicates),
    ("pii", personal_data),
    ("mixing", mixture),
    ("packing", sequences),
]

#: the stages are not all expressible in SQL; tests compare run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents, each written before the next reads it."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = ws.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
