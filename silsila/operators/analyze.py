"""Link analysis: relation support, chronology, warnings, continuity status, branch roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silsila import lexicon as lx
from silsila.functions.text import stable_id
from silsila.operators.chains import CHAIN, adjacent_pairs, link_counts

CARD_COLUMNS = ("grade", "tabaqa", "birth_year", "death_year", "has_tadlis")


def chronology(sb, sd, tb, td, sc, tc) -> Column:
    """Chronology of a (student, teacher) pair from birth, death and class. 0 is no value."""
    def known(c):
        return F.coalesce(c, F.lit(0)) != 0

    return (
        F.when(known(sb) & known(td) & (sb > td), "conflict_student_born_after_teacher_death")
        .when(known(sc) & known(tc) & (sc + 1 < tc), "possible_generation_reversal")
        .when((known(sb) | known(sd)) & (known(tb) | known(td)), "compatible_no_obvious_conflict")
        .otherwise("unknown"))


def continuity(chronology_status, reported, tadlis, observed) -> Column:
    """Ordered status rules of a link."""
    reported, tadlis = F.coalesce(reported, F.lit(False)), F.coalesce(tadlis, F.lit(False))
    return (
        F.when(chronology_status.startswith("conflict"), "chronology_conflict")
        .when(reported & ~tadlis, "supported_reported_and_observed")
        .when(reported & tadlis, "reported_but_tadlis_review")
        .when((observed >= 2) & ~tadlis, "observed_repeated_needs_reported_source")
        .when(tadlis, "tadlis_review")
        .otherwise("observed_only_needs_review"))


def weakness(student_grade, teacher_grade, weak=lx.WEAK_GRADES) -> Column:
    flags = F.array_compact(F.array(
        F.when(student_grade.isin(*weak), F.concat(F.lit("student:"), student_grade)),
        F.when(teacher_grade.isin(*weak), F.concat(F.lit("teacher:"), teacher_grade))))
    return F.when(F.size(flags) > 0, F.array_join(flags, ";")).otherwise("none")


def analyze_links(occ: DataFrame, reported: DataFrame, observed: DataFrame, cards: DataFrame,
                  plain_terms=("عن",), weak=lx.WEAK_GRADES) -> DataFrame:
    """One row per adjacent resolved link with its evidence and status.

    ``occ``: position columns, occurrence_id, entity, term. ``reported``: student, teacher,
    status. ``observed``: student, teacher, evidence_count. ``cards``: entity and CARD_COLUMNS.
    Pairs repeat over many chains, so the pair facts are joined once per distinct pair and term.
    """
    links = adjacent_pairs(occ, ["occurrence_id", "entity", "term"])
    links = links.filter(F.col("from_entity").isNotNull() & F.col("to_entity").isNotNull()).select(
        *CHAIN, "from_sequence", F.col("from_occurrence_id").alias("from_occurrence"), F.col("to_occurrence_id").alias("to_occurrence"),
        F.col("from_entity").alias("student"), F.col("to_entity").alias("teacher"), F.col("to_term").alias("term"))
    pairs = links.select("student", "teacher", "term").distinct()
    facts = judge_pairs(pairs, reported, observed, cards, plain_terms, weak)
    out = links.join(facts, ["student", "teacher", "term"])
    return out.withColumn("edge_id", stable_id("AE_", *CHAIN, "from_occurrence", "to_occurrence"))


def judge_pairs(pairs: DataFrame, reported: DataFrame, observed: DataFrame, cards: DataFrame,
                plain_terms=("عن",), weak=lx.WEAK_GRADES) -> DataFrame:
    """Evidence and status of distinct (student, teacher, term) rows."""
    rows = pairs.join(reported.select("student", "teacher", F.col("status").alias("reported_status")), ["student", "teacher"], "left")
    rows = rows.join(observed.select("student", "teacher", F.col("evidence_count").alias("observed_count")), ["student", "teacher"], "left")
    for side in ("student", "teacher"):
        rows = rows.join(cards.select(F.col("entity").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in CARD_COLUMNS]), side, "left")
    rows = rows.withColumn("observed_count", F.coalesce("observed_count", F.lit(0)))
    rows = rows.withColumn("chronology_status", chronology(*[F.col(c) for c in (
        "student_birth_year", "student_death_year", "teacher_birth_year", "teacher_death_year", "student_tabaqa", "teacher_tabaqa")]))
    tadlis = (F.coalesce("student_has_tadlis", F.lit(0)) != 0) & F.coalesce("term", F.lit("")).isin(*plain_terms)
    rows = rows.withColumn("tadlis_warning", tadlis.cast("int"))
    rows = rows.withColumn("weakness", weakness(F.col("student_grade"), F.col("teacher_grade"), weak))
    return rows.withColumn("continuity_status", continuity(
        F.col("chronology_status"), F.col("reported_status").isNotNull(), F.col("tadlis_warning") == 1, F.col("observed_count")))


def evidence_json() -> Column:
    """Evidence document of a link, for sinks that store text."""
    return F.to_json(F.struct("reported_status", "observed_count", *[
        f"{side}_{c}" for c in ("grade", "tabaqa", "birth_year", "death_year") for side in ("student", "teacher")]))


def branch_summary(occ: DataFrame, links: DataFrame, supported: str = "supported_reported_and_observed") -> DataFrame:
    """Roll-up per chain and branch. ``occ`` has a ``resolved`` column (0/1)."""
    done = links.groupBy(*CHAIN).agg(
        F.count(F.lit(1)).alias("resolved_links"),
        F.sum((F.col("continuity_status") == supported).cast("int")).alias("supported_links"))
    rows = link_counts(occ).join(done, CHAIN, "left")
    n = F.coalesce("resolved_links", F.lit(0))
    s = F.coalesce("supported_links", F.lit(0))
    return rows.select(
        *CHAIN, "total_occurrences", "resolved_occurrences", "total_links", n.alias("resolved_links"), s.alias("supported_links"),
        (n - s).alias("warning_links"), (F.col("total_links") - n).alias("unresolved_links"),
        (F.col("total_occurrences") == F.col("resolved_occurrences")).cast("int").alias("complete_identity_resolution"))


def card_edges(occ: DataFrame, anchor_pairs: DataFrame, listed: DataFrame) -> DataFrame:
    """Adjacent card links with their support class.

    ``occ``: position columns, occurrence_id, card_ref, term. ``anchor_pairs``: student, teacher
    already in the relation graph. ``listed``: student, teacher, direction (teacher_list /
    student_list) from the source lists.
    """
    links = adjacent_pairs(occ, ["occurrence_id", "card_ref", "term"]).filter(
        F.col("from_card_ref").isNotNull() & F.col("to_card_ref").isNotNull())
    pairs = links.select(F.col("from_card_ref").alias("student"), F.col("to_card_ref").alias("teacher")).distinct()
    graph = anchor_pairs.select("student", "teacher").distinct().withColumn("in_graph", F.lit(1))
    sides = listed.groupBy("student", "teacher").agg(
        F.max((F.col("direction") == "teacher_list").cast("int")).alias("by_student"),
        F.max((F.col("direction") == "student_list").cast("int")).alias("by_teacher"))
    facts = pairs.join(graph, ["student", "teacher"], "left").join(sides, ["student", "teacher"], "left")
    both = F.coalesce("by_student", F.lit(0)) + F.coalesce("by_teacher", F.lit(0))
    support = (F.when(F.col("in_graph") == 1, "existing_anchor_graph").when(both == 2, "bilateral_source_lists")
               .when(both == 1, "one_source_direction").otherwise("needs_relationship_evidence"))
    facts = facts.select("student", "teacher", support.alias("relationship_support"))
    named = links.select(
        *CHAIN, "from_sequence", F.col("from_occurrence_id").alias("from_occurrence"), F.col("to_occurrence_id").alias("to_occurrence"),
        F.col("from_card_ref").alias("student"), F.col("to_card_ref").alias("teacher"), F.col("to_term").alias("term"))
    return named.join(facts, ["student", "teacher"])


def resolution_progress(occ: DataFrame, card_type: str = "card_type", card: str = "card_id") -> DataFrame:
    """Resolved and remaining occurrences and distinct cards, by card type."""
    kinds = occ.groupBy(F.coalesce(card_type, F.lit("unresolved")).alias("card_type"), card).agg(F.count(F.lit(1)).alias("n"))
    return kinds.groupBy("card_type").agg(F.sum("n").alias("occurrences"), F.count(card).alias("distinct_cards"))


def unresolved_queue(occ: DataFrame, name: str = "name", entity: str = "entity") -> DataFrame:
    """Unresolved names with their frequency; the caller orders or limits the report."""
    return occ.filter(F.col(entity).isNull()).groupBy(name).agg(F.count(F.lit(1)).alias("occurrences"))


def warning_counts(links: DataFrame) -> DataFrame:
    return links.agg(
        F.count(F.lit(1)).alias("links"), F.count_if(F.col("weakness") != "none").alias("weak_or_unknown_links"),
        F.count_if(F.col("tadlis_warning") == 1).alias("tadlis_links"),
        F.count_if(F.col("chronology_status").startswith("conflict")).alias("conflict_links"))
