"""Corpus preparation: language ID, exact dedup, near dedup, personal data, packing.

Every stage works on all rows its predecessor kept; its result is written as Parquet into the shared folder and read
again, so a stage never recomputes another and survives lost executors. All stages but the last return the columns of
``documents``. Null texts have no language and go in the first stage; empty tables pass through as empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from silsila.llm import exact_dedup, langid, packing, pii, simhash
from silsila.llm.common import documents, stage_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; without a letter, or with a best probability below 0.35, they go."""
    return langid.accept(docs, langid.train(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row, with the largest doc_id."""
    return exact_dedup.drop_copies(docs, one_row=True)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by their fingerprints the row with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked by its kind in brackets."""
    return pii.mask_personal_data(docs, pii.train(spark))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its sequence and place."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("simhash", near_copies),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: Trained models, fingerprints and tokens are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
