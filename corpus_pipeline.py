"""From raw documents to packed training sequences, one operator per stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rosterlake.llm.curriculum import mix_documents
from rosterlake.llm.packing import pack
from rosterlake.llm.near_copies import keep_one
from rosterlake.llm.rule_ensemble import keep_good
from rosterlake.llm.tables import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores at least 0.5."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group alike in 0.8 or more of its five-word shingles.

    Pairs are found by the deletion variants of SimHash fingerprints, those out of their reach by MinHash keys.
    """
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their sources' targets take them, sorted by their place in training."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of up to 4096 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]

# Trained rules, hashes of shingles and token ids have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
