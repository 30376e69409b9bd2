"""The training-data pipeline: documents through the operators of ``wordloom.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wordloom.llm.jaccard_join import keep_one
from wordloom.llm.langid import keep_known, likeness_cuts, train_identifier
from wordloom.llm.packing import pack_documents
from wordloom.llm.quality import keep_good
from wordloom.llm.token_count import token_counts
from wordloom.session import stage

LEAST_QUALITY = 0.3
VOCABULARY = "byte_bpe_50k.json"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that no language profile of the corpus resembles as its own training texts of like length do.

    Null and empty texts and texts without a letter go, as do all rows if no row with a language and a text is there to learn from.
    Repeated rows share one decision, ties of likeness go to the language first by name, null ids are kept or dropped by their text.
    Columns are passed on by place, whatever their names; an empty table stays empty.
    """
    identifier = train_identifier(docs)
    return keep_known(docs, identifier, likeness_cuts(docs, identifier))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are unlikely to be labelled good: a score below ``LEAST_QUALITY``, the score itself is kept.

    Null texts are scored as empty ones; repeated rows share one decision; null ids are scored like others but teach nothing;
    other columns are passed on by place; an empty table stays empty.
    """
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), LEAST_QUALITY)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, likeness 0.8 or more.

    The least id of a group stays, and one of several rows with that id. Null and empty texts are like nothing and stay;
    other columns are passed on by place; an empty table stays empty.
    """
    return keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in training sequences, their lengths in tokens of the byte-level vocabulary and one end token each.

    Null and empty texts are one token long; repeated rows and null ids are packed each; an empty table gives no rows.
    """
    return pack_documents(token_counts(docs, public_tokenizers.path(VOCABULARY)), length="n_tokens")


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_copies", near_copies),
    ("packing", packed),
]

#: No stage but the last could be said in SQL; tests/llm holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents table, each to what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
