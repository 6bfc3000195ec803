"""A corpus pipeline: quality model, exact dedup, near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.  All give
no rows for an empty table, and columns besides pass through whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, near_dedup, packing, quality_model, simhash, substring_dedup
from tidemark.llm.common import forget, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.3 or more; fitted to the labels of the training rows among ``docs``.

    Null and blank texts have a score, too; equal texts have equal ones, so repeated rows stay or go together.
    """
    return quality_model.keep(docs, quality_model.train(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space: the longest, then of the smallest id.

    Null, empty and blank texts are one group; a null id counts as largest; of repeated rows one stays.
    """
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of documents linked at 0.8 of their five-word shingles or more.

    Null and blank texts are one class, and shorter texts are one shingle; a null id counts as largest; of rows of one id in
    a class that of the smallest hash of its text stays, and of repeated rows one.
    """
    return simhash.dedup(docs, radius=near_dedup.RADIUS, shingle=near_dedup.SHINGLE, similarity=near_dedup.SIMILARITY)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 13 words or more that documents of smaller ids have; those left empty go.

    Texts without words, null ones too, stay as they are; a null id counts as largest; rows of one id take nothing from each other.
    """
    return substring_dedup.dedup(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens.  A null text is empty, with its end token; repeated rows are packed again."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [("quality_model", quality), ("exact_dedup", exact), ("simhash_dedup", near), ("substring_dedup", passages), ("packing", pack)]

#: SQL can express none of the learnt, linked or packed stages; tests hold the whole against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage wrote is deleted when the next has read it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
