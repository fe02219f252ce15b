"""Ordered chains: positions, guarded neighbours, adjacent pairs, observed edges.

A chain can be huge (think of one chain holding a third of all rows), so nothing here sorts
or windows a whole chain. Atoms are first combined per position on the map side; neighbours
differ by exactly one in sequence, hence a chain can be cut into blocks of sequence numbers
that share only their border positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from silsila.functions.text import stable_id

CHAIN = ["chain_id", "branch_hint"]
POSITION = [*CHAIN, "sequence_index"]


def positions(occ: DataFrame, payload: list[str], flag: str | None = None) -> DataFrame:
    """One row per position: ``atoms`` and, for a single atom, its payload (else NULL)."""
    n = F.count(F.lit(1))
    extra = [F.sum(F.col(flag).cast("int")).alias(f"n_{flag}")] if flag else []
    return occ.groupBy(*POSITION).agg(
        n.alias("atoms"), *extra, *[F.when(n == 1, F.min(c)).alias(c) for c in payload])


def guarded_neighbours(occ: DataFrame, payload: list[str], sides=("prev", "next"), block: int = 64) -> DataFrame:
    """Singleton positions with the payload of their neighbours as ``prev_*`` / ``next_*``.

    A neighbour counts only when its sequence number differs by exactly one and it is a
    singleton itself; else its columns are NULL (``has_prev`` / ``has_next`` tell). Windows run
    over blocks of 64 sequence numbers; the first and last number of a block are also sent to
    the block next to it, so no window ever sees more than 66 rows of a chain.
    """
    n = F.count(F.lit(1))
    single = occ.groupBy(*POSITION).agg(n.alias("__n"), *[F.min(c).alias(c) for c in payload]).filter("__n = 1").drop("__n")
    if not sides:
        return single
    at = F.col("sequence_index")
    own, place = F.floor(at / block), F.pmod(at, F.lit(block))
    seen_in = F.when(place == 0, F.array(own, own - 1)).when(place == block - 1, F.array(own, own + 1)).otherwise(F.array(own))
    rows = single.select("*", own.alias("__own"), F.explode(seen_in).alias("__block"))
    w = W.partitionBy(*CHAIN, "__block").orderBy("sequence_index")
    look = {"prev": (F.lag, -1), "next": (F.lead, 1)}
    seen = [look[s][0](c).over(w).alias(f"__{s}_{c}") for s in sides for c in ["sequence_index", *payload]]
    rows = rows.select("*", *seen)
    out = [F.col(c) for c in payload]
    for s in sides:
        beside = F.coalesce(F.col(f"__{s}_sequence_index") == at + look[s][1], F.lit(False))
        out.append(beside.alias(f"has_{s}"))
        out += [F.when(beside, F.col(f"__{s}_{c}")).alias(f"{s}_{c}") for c in payload]
    return rows.filter(F.col("__block") == F.col("__own")).select(*POSITION, *out)


def adjacent_pairs(occ: DataFrame, payload: list[str]) -> DataFrame:
    """Pairs of singleton positions with consecutive numbers: ``from_*`` (earlier), ``to_*``."""
    pairs = guarded_neighbours(occ, payload, sides=("prev",)).filter("has_prev")
    return pairs.select(
        *CHAIN, (F.col("sequence_index") - 1).alias("from_sequence"), F.col("sequence_index").alias("to_sequence"),
        *[F.col(f"prev_{c}").alias(f"from_{c}") for c in payload], *[F.col(c).alias(f"to_{c}") for c in payload])


def link_counts(occ: DataFrame, resolved: str = "resolved") -> DataFrame:
    """Per chain and branch: occurrences, resolved ones, links over all positions in order.

    Links also span gaps and groups (those can never be resolved), so their number is the
    number of positions less one; no ordering is needed to count them.
    """
    at = occ.groupBy(*POSITION).agg(F.count(F.lit(1)).alias("atoms"), F.sum(F.col(resolved).cast("int")).alias("done"))
    return at.groupBy(*CHAIN).agg(
        F.sum("atoms").alias("total_occurrences"), F.sum("done").alias("resolved_occurrences"),
        (F.count(F.lit(1)) - 1).alias("total_links"))


EDGE = ["from_name", "to_name", "from_type", "to_type", "term"]


def position_edges(occ: DataFrame, name: str = "normalized_name", kind: str = "occurrence_type",
                   term: str = "transmission_term", named: str = "named_candidate") -> DataFrame:
    """Edge evidence per position: all atoms of a position to all atoms of the next one.

    Atoms are counted per distinct name first, so a position of many equal atoms joins as one
    row and its evidence is a product of counts. Equal named atoms form no edge.
    """
    base = occ.select(*POSITION, F.col(name).alias("name"), F.col(kind).alias("type"), F.col(term).alias("term"))
    to = base.groupBy(*POSITION, "name", "type", "term").agg(F.count(F.lit(1)).alias("to_count"))
    frm = base.groupBy(*POSITION, "name", "type").agg(F.count(F.lit(1)).alias("from_count"))
    frm = frm.select(*CHAIN, (F.col("sequence_index") + 1).alias("sequence_index"),
                     F.col("name").alias("from_name"), F.col("type").alias("from_type"), "from_count")
    to = to.select(*POSITION, F.col("name").alias("to_name"), F.col("type").alias("to_type"), "term", "to_count")
    same = (F.col("from_name") == F.col("to_name")) & (F.col("from_type") == named)
    return frm.join(to, POSITION).filter(~same).select(
        *EDGE, *CHAIN, (F.col("sequence_index") - 1).alias("from_sequence"), "from_count", "to_count",
        (F.col("from_count") * F.col("to_count")).alias("evidence_count"))


def observed_edges(evidence: DataFrame, chains: DataFrame, chain: str = "chain_id", source: str = "source_file_id",
                   named: str = "named_candidate") -> DataFrame:
    """Edge patterns with evidence, distinct chains and distinct source files.

    The counts go through one row per (edge, chain), so only one real distinct is left.
    """
    per_chain = evidence.groupBy(*EDGE, "chain_id").agg(F.sum("evidence_count").alias("n"))
    meta = chains.select(F.col(chain).alias("chain_id"), F.col(source).alias("__source"))
    edges = per_chain.join(meta, "chain_id").groupBy(*EDGE).agg(
        F.sum("n").alias("evidence_count"), F.count(F.lit(1)).alias("distinct_chain_count"),
        F.countDistinct("__source").alias("distinct_source_count"))
    review = (F.col("from_type") != named) | (F.col("to_type") != named)
    return edges.withColumn("needs_review", review.cast("int"))


def edge_facts(evidence: DataFrame, chains: DataFrame, chain: str = "chain_id", source: str = "source_file_id",
               record: str = "record_id") -> DataFrame:
    """Evidence rows under a stable edge id, one per edge and position, with the source file and record of the chain.

    The occurrence pairs behind a row are the from-atoms times the to-atoms of that position;
    they stay factored (two counts), and :func:`edge_pairs` expands them.
    """
    meta = chains.select(F.col(chain).alias("chain_id"), F.col(source).alias("source_file_id"), F.col(record).alias("record_id"))
    return evidence.join(meta, "chain_id").select(
        stable_id("E_", *EDGE).alias("edge_id"), *CHAIN, "source_file_id", "record_id", "from_sequence", "from_count", "to_count", "evidence_count")


def edge_pairs(evidence: DataFrame, occ: DataFrame, name: str = "normalized_name", kind: str = "occurrence_type",
               term: str = "transmission_term") -> DataFrame:
    """(edge_id, position, from_occurrence, to_occurrence): the pairs behind chosen evidence rows."""
    at = [*CHAIN, "from_sequence"]
    frm = occ.select(*CHAIN, F.col("sequence_index").alias("from_sequence"), F.col(name).alias("from_name"), F.col(kind).alias("from_type"),
                     F.col("occurrence_id").alias("from_occurrence"))
    to = occ.select(*CHAIN, (F.col("sequence_index") - 1).alias("from_sequence"), F.col(name).alias("to_name"), F.col(kind).alias("to_type"),
                    F.col(term).alias("term"), F.col("occurrence_id").alias("to_occurrence"))
    rows = evidence.join(frm, [*at, "from_name", "from_type"]).join(to, [*at, "to_name", "to_type", "term"])
    return rows.select(stable_id("E_", *EDGE).alias("edge_id"), *at, "from_occurrence", "to_occurrence")


def resolved_pairs(occ: DataFrame, entity: str = "entity") -> DataFrame:
    """Observed (student, teacher) pairs of adjacent resolved singletons."""
    pairs = adjacent_pairs(occ, [entity]).filter(F.col(f"from_{entity}").isNotNull() & F.col(f"to_{entity}").isNotNull())
    per_chain = pairs.groupBy(F.col(f"from_{entity}").alias("student"), F.col(f"to_{entity}").alias("teacher"), "chain_id").agg(
        F.count(F.lit(1)).alias("n"))
    return per_chain.groupBy("student", "teacher").agg(
        F.sum("n").alias("evidence_count"), F.count(F.lit(1)).alias("distinct_chain_count"))
