"""Reported relations between entities: evidence from lists, reconciliation, list support."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silsila.functions import keys as K
from silsila.functions.text import stable_id
from silsila.operators.blocking import prefix_index, unique_keys


def longest_unique_segments(segments: DataFrame, index: DataFrame, lo: int = 2, hi: int = 6) -> DataFrame:
    """(segment, entity): longest unique key at the start of a segment, on a token edge."""
    unique = unique_keys(index).select("key", "entity")
    distinct = segments.select("segment").distinct()
    rows = distinct.select("segment", F.explode(K.prefixes(K.tokens("segment"), lo, hi)).alias("p")).select("segment", "p.key", "p.len")
    best = rows.join(unique, "key").groupBy("segment").agg(F.max(F.struct("len", "entity")).alias("b"))
    return best.select("segment", F.col("b.entity").alias("entity"), F.col("b.len").alias("matched_len"))


def reported_evidence(cards: DataFrame, card: str, teachers: Column, students: Column, anchors: DataFrame,
                      anchor: str, anchor_name: str) -> DataFrame:
    """Evidence rows (student, teacher, direction, segment) from the two lists of each card.

    ``teachers`` and ``students`` are arrays of normalised segments. The own teacher list gives
    self -> x, the own student list x -> self; nobody relates to themselves.
    """
    lists = cards.select(F.col(card).alias("card"), F.lit("teacher_list").alias("direction"), F.explode(teachers).alias("segment")).unionByName(
        cards.select(F.col(card).alias("card"), F.lit("student_list").alias("direction"), F.explode(students).alias("segment")))
    lists = lists.distinct()
    matched = lists.join(longest_unique_segments(lists, prefix_index(anchors, anchor, anchor_name, 2, 6)), "segment")
    matched = matched.filter(F.col("entity") != F.col("card"))
    own = F.col("direction") == "teacher_list"
    return matched.select(
        F.when(own, F.col("card")).otherwise(F.col("entity")).alias("student"),
        F.when(own, F.col("entity")).otherwise(F.col("card")).alias("teacher"),
        "direction", "segment").withColumn("evidence_id", stable_id("RE_", "student", "teacher", "direction", "segment"))


def reconcile(evidence: DataFrame) -> DataFrame:
    """One row per (student, teacher): which list reports it, and whether both do."""
    flags = evidence.groupBy("student", "teacher").agg(
        F.max((F.col("direction") == "teacher_list").cast("int")).alias("teacher_list_evidence"),
        F.max((F.col("direction") == "student_list").cast("int")).alias("student_list_evidence"))
    return flags.withColumn(
        "status", F.when((F.col("teacher_list_evidence") == 1) & (F.col("student_list_evidence") == 1), "bilateral_reported")
        .when(F.col("teacher_list_evidence") == 1, "teacher_list_only").otherwise("student_list_only"))


def listed_nodes(lists: DataFrame, card: str, text: str, node_keys: DataFrame, max_tokens: int = 8) -> DataFrame:
    """(card, node): a key of the node occurs, on token edges, in the card's list text.

    ``node_keys``: node, key. The list is cut into token runs that are equi joined with the
    keys, linear in the text. Keys longer than ``max_tokens`` meet by their first tokens and are
    then compared in full. A key inside a longer word is no evidence.
    """
    keys = node_keys.select("node", "key").distinct().withColumn("__size", F.size(F.split("key", " ")))
    base = lists.select(F.col(card).alias("card"), F.col(text).alias("text"))
    t = K.tokens("text")
    grams = base.select("card", F.explode(F.array_distinct(F.transform(K.ngrams(t, 1, max_tokens), lambda g: g["key"]))).alias("key"))
    short = grams.join(keys.filter(F.col("__size") <= max_tokens).select("node", "key"), "key").select("card", "node")
    heads = base.select("card", "text", F.explode(F.array_distinct(F.transform(K.ngrams(t, max_tokens, max_tokens), lambda g: g["key"]))).alias("head"))
    long = keys.filter(F.col("__size") > max_tokens).withColumn("head", F.substring_index("key", " ", max_tokens))
    padded = F.concat(F.lit(" "), "text", F.lit(" "))
    longer = heads.join(long, "head").filter(padded.contains(F.concat(F.lit(" "), "key", F.lit(" ")))).select("card", "node")
    return short.unionByName(longer).distinct()
