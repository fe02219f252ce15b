"""Reader mart: seven tables published from the research tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silsila.functions.text import card_ref
from silsila.sources.tables import one_per_key, refresh


def mart_cards(anchors: DataFrame, provisional: DataFrame) -> DataFrame:
    """Anchored and provisional cards in one schema. Both inputs carry the same value columns
    (display_name, grade, tabaqa, birth_year, death_year, ...) and their id as ``card_id``."""
    a = anchors.withColumn("card_type", F.lit("existing_anchor"))
    p = provisional.withColumn("card_type", F.lit("provisional_source_card"))
    both = a.unionByName(p, allowMissingColumns=True)
    return both.withColumn("card_ref", card_ref("card_type", "card_id"))


def mart_statements(first: DataFrame, second: DataFrame | None = None) -> DataFrame:
    """Critic statements of two stages under tagged ids; one row per id."""
    tag = lambda df, t: df.withColumn("statement_ref", F.concat(F.lit(t), F.col("statement_id"))).withColumn(
        "card_ref", F.concat(F.lit("A:"), F.col("anchor"))).drop("statement_id", "anchor")
    both = tag(first, "S2:")
    if second is not None:
        both = both.unionByName(tag(second, "S4:"), allowMissingColumns=True)
    return one_per_key(both, ["statement_ref"], [F.col("card_ref")])


def mart_chains(chains: DataFrame, files: DataFrame, records: DataFrame) -> DataFrame:
    """Chains with book and record provenance; a chain without a record row stays."""
    return chains.join(files, "source_file_id").join(records, "record_id", "left")


def mart_nodes(occ: DataFrame, cards: DataFrame) -> DataFrame:
    """Every occurrence with its card, or ``unresolved``; the evidence of the resolution too where ``cards`` has it."""
    told = [c for c in ("evidence",) if c in cards.columns]
    rows = occ.join(cards.select("occurrence_id", "card_type", "card_id", "status", *told), "occurrence_id", "left")
    known = F.col("card_id").isNotNull()
    return rows.withColumn("card_ref", F.when(known, card_ref("card_type", "card_id"))).withColumn(
        "resolution_status", F.coalesce("status", F.lit("unresolved"))).drop("card_type", "card_id", "status")


def mart_repairs(repairs: DataFrame, hidden: DataFrame) -> DataFrame:
    """Terminal repairs with the card of the hidden name, if it was resolved.

    ``hidden``: occurrence_id, card_type, card_id, evidence.
    """
    rows = repairs.join(hidden.select("occurrence_id", "card_type", "card_id", "evidence"), "occurrence_id", "left")
    return rows.withColumn("hidden_card_ref", F.when(F.col("card_id").isNotNull(), card_ref("card_type", "card_id"))).drop("card_type", "card_id")


def publish(path: str, **tables: DataFrame) -> None:
    """Write each mart table under its name."""
    for name, df in tables.items():
        refresh(df, f"{path}/{name}")
