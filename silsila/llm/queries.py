"""Registered queries of the operators, each over its whole table, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silsila.llm import (
    alignment, exact_dedup, langid, licenses, neighbours, packing, paragraphs, pieces, pii, quality_rules, runs, simhash, tensored,
)
from silsila.llm.common import documents, labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def fold(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string"))


@query("op1_quality_rules")
def op1_quality_rules(spark, sf_dir):
    return quality_rules.quality_verdicts(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op2_sentencepiece")
def op2_sentencepiece(spark, sf_dir):
    return pieces.encode_documents(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query("op3_repeated_passages")
def op3_repeated_passages(spark, sf_dir):
    return paragraphs.repeated_passages(documents(spark, sf_dir))


@query("op4_licenses", licenses.oracle())
def op4_licenses(spark, sf_dir):
    return licenses.scan_licenses(documents(spark, sf_dir))


@query("op5_personal_data")
def op5_personal_data(spark, sf_dir):
    return pii.find_personal_data(documents(spark, sf_dir), pii.train(spark))


@query("op6_exact_dedup", f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
WINDOW w AS (PARTITION BY t)""")
def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(documents(spark, sf_dir))


@query("op7_best_fit_packing")
def op7_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_quality_neighbours")
def op8_quality_neighbours(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = neighbours.classify(docs, neighbours.train(docs, labels(spark, sf_dir)))
    return found.select("doc_id", F.coalesce(fold() % 5 == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op9_simhash")
def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", F.coalesce(fold() % 4 == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op11_minhash")
def op11_minhash(spark, sf_dir):
    return tensored.near_duplicates(documents(spark, sf_dir))


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    return runs.periodic_runs(documents(spark, sf_dir))


@query("op13_alignment")
def op13_alignment(spark, sf_dir):
    return alignment.align_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))
