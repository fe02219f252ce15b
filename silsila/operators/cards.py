"""Card builders: entry index, summary cards, aliases, source cards, links, provisional cards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silsila import lexicon as lx
from silsila.functions import keys as K
from silsila.functions import rules as R
from silsila.functions.text import (
    CARDS, HEADINGS, LINEAGE, LOOSE_LABELS, PLAIN, STRICT_LABELS, Labels, canonical_name, death_phrases, entry_heading,
    identity_text, normalize, staged, stable_id,
)
from silsila.operators.blocking import longest_prefix_match, prefix_index, unique_number_link


def entry_index(entries: DataFrame, body: str = "body", labels: Labels = STRICT_LABELS, **name_rules) -> DataFrame:
    """Heading, canonical name, teacher and student lists and confidence of each entry.

    ``LOOSE_LABELS`` is the later reading: the colon may be missing and "from" is never taken
    for "from him". ``name_rules`` go to :func:`canonical_name`.
    """
    rows = staged(entries, heading=entry_heading(body, labels.heading_end()), teachers_raw=labels.teacher_list(body),
                  students_raw=labels.student_list(body))
    rows = staged(rows, canonical_name=canonical_name("heading", **name_rules))
    t, s = F.col("teachers_raw") != "", F.col("students_raw") != ""
    return rows.withColumn("canonical_norm", normalize("canonical_name", PLAIN)).withColumn(
        "confidence", F.when(t & s, 0.95).when(t | s, 0.80).otherwise(0.35))


def summary_cards(anchors: DataFrame, entries: DataFrame, summaries: DataFrame, death_verbs=lx.DEATH_VERBS) -> DataFrame:
    """Anchor + its entry + the summary whose text starts with the anchor's name, if unique.

    ``anchors``: anchor, entry_id, canonical_name. ``entries``: entry_id, locator, body,
    teachers_raw, students_raw. ``summaries``: summary_no, summary_page, summary_text.
    """
    named = anchors.withColumn("__n", normalize("canonical_name", LINEAGE))
    texts = summaries.withColumn("__id", stable_id("SU_", "summary_no", "summary_page", "summary_text"))
    index = prefix_index(texts.withColumn("__n", normalize("summary_text", LINEAGE)), "__id", "__n", 2, 7)
    match = longest_prefix_match(named, "anchor", "__n", index, 2, 6).select("anchor", F.col("entity").alias("__id"))
    cards = named.drop("__n").join(entries, "entry_id").join(match, "anchor", "left").join(texts, "__id", "left").drop("__id")
    return cards.withColumn("death_text", death_phrases(F.coalesce("summary_text", F.lit("")), death_verbs)).withColumn(
        "card_status", F.when(F.col("summary_text").isNotNull(), "entry+summary").otherwise("entry_only"))


def alias_table(anchors: DataFrame, headings: DataFrame | None = None) -> DataFrame:
    """Canonical names and matched source headings (two tokens and more) as aliases.

    ``anchors``: anchor, canonical_name. ``headings``: anchor, source, entry_id, heading.
    """
    own = anchors.select("anchor", F.col("canonical_name").alias("alias_text"), F.lit("canonical").alias("alias_type"),
                         F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("entry_id"))
    if headings is not None:
        own = own.unionByName(headings.select(
            "anchor", F.col("heading").alias("alias_text"), F.lit("source_heading").alias("alias_type"), "source", "entry_id"))
    rows = own.withColumn("alias_norm", normalize("alias_text", HEADINGS))
    rows = rows.filter((F.col("alias_type") == "canonical") | (F.size(K.tokens("alias_norm")) >= 2))
    return rows.withColumn("alias_id", stable_id("AL_", "anchor", "alias_type", "source", "entry_id", "alias_norm")).dropDuplicates(["alias_id"])


def source_cards(entries: DataFrame, no: str = "entry_no", page: str = "page", text: str = "text",
                 cuts=lx.IDENTITY_CUTS) -> DataFrame:
    """Source cards: identity text, its norm, full text."""
    rows = staged(entries, identity_text=identity_text(text, cuts))
    return rows.select(
        stable_id("TQ_", no, page, text).alias("card_id"), F.col(no).alias("entry_no"), F.col(page).alias("page"),
        "identity_text", normalize("identity_text", CARDS).alias("identity_norm"), F.col(text).alias("full_text"))


def source_card_aliases(cards: DataFrame, **words) -> DataFrame:
    rows = cards.select("card_id", F.explode(K.card_aliases("identity_norm", **words)).alias("a"))
    return rows.select("card_id", "a.alias", "a.alias_type")


def anchor_links(stage_cards: DataFrame, cards: DataFrame) -> DataFrame:
    """Source card to anchor by the shared entry number, where one card carries it."""
    links = unique_number_link(stage_cards.filter(F.col("entry_no").isNotNull()), cards, "anchor", "card_id", "entry_no")
    return links.groupBy("card_id").agg(F.min("anchor").alias("anchor"))


def secondary_links(cards: DataFrame, entries: DataFrame) -> DataFrame:
    """Source card to the secondary entry with the longest unique heading prefix."""
    index = prefix_index(entries.withColumn("__n", normalize("heading", CARDS)), "entry_id", "__n", 2, 7)
    found = longest_prefix_match(cards, "card_id", "identity_norm", index, 2, 6)
    return found.select("card_id", F.col("entity").alias("entry_id"))


def relationship_text(links: DataFrame, entries: DataFrame, body: str = "body", labels: Labels = LOOSE_LABELS) -> DataFrame:
    """Teacher and student text of each linked card, with the "from him/her" spellings."""
    rows = links.join(entries.select("entry_id", body), "entry_id")
    return rows.select("card_id", "entry_id", labels.teacher_list(body).alias("teachers_raw"), labels.student_list(body).alias("students_raw"))


def provisional_cards(resolutions: DataFrame, cards: DataFrame, links: DataFrame, texts: DataFrame, bodies: DataFrame,
                      grade=R.source_card_grade) -> DataFrame:
    """One card per source card that got occurrences and has no anchor.

    ``resolutions``: occurrence_id, card_id. ``links``: card_id, anchor. ``texts``: card_id,
    entry_id, teachers_raw, students_raw. ``bodies``: entry_id, body.
    """
    counts = resolutions.groupBy("card_id").agg(F.count(F.lit(1)).alias("occurrences"))
    free = cards.join(links.select("card_id"), "card_id", "left_anti").join(counts, "card_id")
    rows = free.join(texts, "card_id", "left").join(bodies, "entry_id", "left")
    return rows.select(
        stable_id("P_", "card_id").alias("provisional_id"), "card_id", "identity_text", "entry_no", "page", "full_text",
        grade("full_text").alias("grade"), R.class_ordinal("full_text").alias("tabaqa"), "entry_id",
        F.coalesce("body", F.lit("")).alias("biography"), "teachers_raw", "students_raw", "occurrences")


def card_map(resolved: DataFrame, links: DataFrame, anchors: DataFrame, cards: DataFrame, grade=R.source_card_grade) -> DataFrame:
    """Occurrence to card: the linked anchor when there is one, else the provisional card.

    ``resolved``: occurrence_id, card_id, method. ``anchors``: anchor, canonical_name, grade.
    """
    rows = resolved.join(links.select("card_id", "anchor"), "card_id", "left").join(anchors, "anchor", "left")
    rows = rows.join(cards.select("card_id", "identity_text", "full_text"), "card_id", "left")
    known = F.col("anchor").isNotNull()
    return rows.select(
        "occurrence_id", F.when(known, "existing_anchor").otherwise("provisional_source_card").alias("card_type"),
        F.when(known, F.col("anchor").cast("string")).otherwise(stable_id("P_", "card_id")).alias("card_ref_id"),
        F.when(known, F.col("canonical_name")).otherwise(F.col("identity_text")).alias("display_name"),
        F.when(known, F.col("grade")).otherwise(grade("full_text")).alias("grade"), F.col("method").alias("status"))
