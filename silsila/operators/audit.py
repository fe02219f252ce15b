"""Integrity audits and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str], check: str) -> DataFrame:
    """Key violations: (check, violations) with the number of keys held more than once."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count_if(F.col("n") > 1).alias("violations")).select(F.lit(check).alias("check"), "violations")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, check: str) -> DataFrame:
    """Child rows whose non-null key the parent does not hold."""
    known = parent.select(F.col(parent_key).alias(child_key)).distinct()
    lost = child.filter(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(check).alias("check"), "violations")


def violations(df: DataFrame, **checks: Column) -> DataFrame:
    """Rows that break a predicate (false or NULL), all checks in one scan."""
    counts = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    return counts.unpivot([], list(checks), "check", "violations")


def conservation(df: DataFrame, total: str, parts: list[str], check: str) -> DataFrame:
    """Rows whose parts do not sum to the total."""
    whole = sum((F.coalesce(F.col(p), F.lit(0)) for p in parts), F.lit(0))
    return df.agg(F.count_if(whole != F.col(total)).alias("violations")).select(F.lit(check).alias("check"), "violations")


def status_counts(df: DataFrame, status: str, layer: str) -> DataFrame:
    return df.groupBy(F.col(status).alias("status")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(layer).alias("layer"), "status", "n")


def extraction_report(records: DataFrame, chains: DataFrame, book: str, kind: str, kinds: list[str]) -> DataFrame:
    """Per book: records by type and chain candidates."""
    by_type = records.groupBy(book).agg(
        F.count(F.lit(1)).alias("records"), *[F.count_if(F.col(kind) == k).alias(k) for k in kinds])
    found = chains.groupBy(book).agg(F.count(F.lit(1)).alias("chains"))
    return by_type.join(found, book, "left").withColumn("chains", F.coalesce("chains", F.lit(0)))


def boundary_report(chains: DataFrame) -> DataFrame:
    """Chains per boundary method with their flagged counts."""
    return chains.groupBy("boundary_method").agg(
        F.count(F.lit(1)).alias("chains"), F.sum("needs_extension_review").alias("extension_review"), F.sum("needs_review").alias("flagged"))


def flag_report(cards: DataFrame, by: str, flags: list[str]) -> DataFrame:
    """Cards per class with the number that carry each 0/1 flag."""
    return cards.groupBy(by).agg(F.count(F.lit(1)).alias("cards"), *[F.sum(f).alias(f) for f in flags])


def support_thresholds(edges: DataFrame, count: str = "distinct_chain_count", levels=(2, 5), named: str = "named_candidate") -> DataFrame:
    """Edge patterns in all and with at least so many distinct chains (named to named only)."""
    both = (F.col("from_type") == named) & (F.col("to_type") == named)
    return edges.agg(F.count(F.lit(1)).alias("edges"), *[F.count_if(both & (F.col(count) >= n)).alias(f"in_{n}_chains") for n in levels])


def relation_coverage(observed: DataFrame, reported: DataFrame) -> DataFrame:
    """Observed resolved pairs: all, reported, reported on both sides."""
    rows = observed.join(reported.select("student", "teacher", "status"), ["student", "teacher"], "left")
    return rows.agg(
        F.count(F.lit(1)).alias("pairs"), F.count("status").alias("reported"),
        F.count_if(F.col("status") == "bilateral_reported").alias("bilateral"))


def label_coverage(occ: DataFrame, name: str, labels: DataFrame, label: str) -> DataFrame:
    """Occurrences whose name is a known label, of all."""
    known = labels.select(F.col(label).alias(name), F.lit(1).alias("hit")).distinct()
    counted = occ.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    rows = counted.join(known, name, "left")
    return rows.agg(F.sum("n").alias("occurrences"), F.sum(F.when(F.col("hit") == 1, F.col("n")).otherwise(0)).alias("covered"))
