"""Blocking joins. Prefix, alias and label matching are equi joins on exploded keys, and
uniqueness is min = max over a map-side combined aggregation, never a list of a block."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silsila.functions import keys as K


def prefix_index(entities: DataFrame, entity: str, name: str, lo: int, hi: int | None) -> DataFrame:
    """(key, len, entity): every token prefix of every entity name (normalised, single spaces).

    ``hi=None`` takes all prefixes, for names of bounded length such as canonical names.
    """
    head = F.col(name) if hi is None else F.substring_index(name, " ", hi)
    rows = entities.select(F.col(entity).alias("entity"), F.explode(K.prefixes(K.tokens(head), lo, hi)).alias("p"))
    return rows.select("p.key", "p.len", "entity").distinct()


def block_bounds(index: DataFrame, key: str = "key", entity: str = "entity", keep=()) -> DataFrame:
    """Smallest and largest entity per key; they are equal exactly when the key is unique."""
    return index.groupBy(key, *keep).agg(F.min(entity).alias("first_entity"), F.max(entity).alias("last_entity"))


def unique_keys(index: DataFrame, key: str = "key", entity: str = "entity", keep=()) -> DataFrame:
    """Keys held by exactly one entity."""
    one = block_bounds(index, key, entity, keep).filter(F.col("first_entity") == F.col("last_entity"))
    return one.select(key, *keep, F.col("first_entity").alias(entity))


def block_sizes(index: DataFrame, key: str = "key", entity: str = "entity") -> DataFrame:
    """Distinct entities per key."""
    return index.select(key, entity).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("block_size"))


def longest_prefix_match(probes: DataFrame, probe: str, name: str, index: DataFrame, lo: int = 2, hi: int = 6,
                         exact_short: bool = False) -> DataFrame:
    """(probe, entity, matched_len): the longest probe prefix found in the index, if unique there.

    ``exact_short`` is the compatibility rule for two-token matches: one of the two names must
    end there (the index then needs a ``size`` column with the entity's token count).
    """
    t = K.tokens(name)
    rows = probes.select(F.col(probe).alias("probe"), F.size(t).alias("__size"), F.explode(K.prefixes(t, lo, hi)).alias("p"))
    rows = rows.select("probe", "__size", "p.key", "p.len")
    if exact_short:
        ends = F.when(F.col("size") == F.col("len"), F.col("entity"))
        blocks = index.groupBy("key").agg(
            F.min("entity").alias("lo_all"), F.max("entity").alias("hi_all"), F.min(ends).alias("lo_end"), F.max(ends).alias("hi_end"))
        free = (F.col("len") >= 3) | (F.col("__size") == F.col("len"))
        hits = rows.join(blocks, "key").select(
            "probe", "len", F.when(free, F.col("lo_all")).otherwise(F.col("lo_end")).alias("first_entity"),
            F.when(free, F.col("hi_all")).otherwise(F.col("hi_end")).alias("last_entity")).filter(F.col("first_entity").isNotNull())
    else:
        hits = rows.join(block_bounds(index), "key")
    best = hits.groupBy("probe").agg(F.max(F.struct("len", "first_entity", "last_entity")).alias("b"))
    best = best.filter(F.col("b.first_entity") == F.col("b.last_entity"))
    return best.select(F.col("probe").alias(probe), F.col("b.first_entity").alias("entity"), F.col("b.len").alias("matched_len"))


def match_either(mentions: DataFrame, entities: DataFrame, mention: str = "mention_id", name: str = "normalized_name",
                 entity: str = "entity_id", short: str = "short_norm", long: str = "long_norm") -> DataFrame:
    """Exact match on the short or the long name (short wins), classed unique or ambiguous.

    The disjunction is a union of two equi joins. Names are matched once per distinct name.
    """
    names = mentions.select(F.col(name).alias("name")).distinct()
    sides = entities.select(F.col(entity).alias("entity"), F.col(short).alias("name"), F.lit(0).alias("m")).unionByName(
        entities.select(F.col(entity).alias("entity"), F.col(long).alias("name"), F.lit(1).alias("m")))
    hits = names.join(sides, "name").groupBy("name", "entity").agg(F.min("m").alias("m"))
    sizes = hits.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    labelled = hits.join(sizes, "name").select(
        "name", "entity", F.when(F.col("m") == 0, "exact_short").otherwise("exact_long").alias("match_method"),
        F.when(F.col("n") == 1, "unique_exact").otherwise("ambiguous_exact").alias("match_status"))
    return labelled


def label_candidates(names: DataFrame, labels: DataFrame, name: str, label: str, entry: str) -> DataFrame:
    """Entries whose label equals a name, with the number of entries for that name."""
    wanted = names.select(F.col(name).alias("name")).distinct()
    hits = wanted.join(labels.select(F.col(label).alias("name"), F.col(entry).alias("entry")), "name")
    sizes = hits.groupBy("name").agg(F.count(F.lit(1)).alias("candidate_count"))
    return hits.join(sizes, "name")


def unique_number_link(left: DataFrame, right: DataFrame, left_id: str, right_id: str, number: str) -> DataFrame:
    """Link by a shared number, only where the right side holds it once."""
    once = right.filter(F.col(number).isNotNull()).groupBy(number).agg(
        F.count(F.lit(1)).alias("n"), F.min(right_id).alias(right_id)).filter("n = 1").drop("n")
    return left.select(left_id, number).join(once, number)


def name_index(cards: DataFrame, names: DataFrame, entity: str = "entity", texts=("identity_norm",),
               name: str = "name", lineage: str = "بن", kunya: str = "ابو", max_tokens: int = 12,
               aliases: DataFrame | None = None) -> DataFrame:
    """(name, entity, name_score) for the names that occur as a token run in an entity text.

    Score: 10 whole text, 9 prefix, 8 second place after a leading lineage word, 7 within the
    first two places, 5 within the first four, 2 further in. A run inside a text counts when any
    text of the entity opens with the same token, or the name is a single token, or it opens with
    the lineage or kunya word. Built by an equi join of the runs with the wanted names, so no block
    of a common first token is ever enumerated per name. Names longer than ``max_tokens`` meet by
    their first tokens and are then compared in full. ``aliases`` (name, entity) score 9.
    """
    wanted = names.select(F.col(name).alias("name")).distinct().withColumn("size", F.size(F.split("name", " ")))
    parts = []
    heads = F.array_distinct(F.array_compact(F.array(*[F.get(K.tokens(text), F.lit(0)) for text in texts])))
    for text in texts:
        t = K.tokens(text)
        parts.append(cards.select(F.col(entity).alias("entity"), heads.alias("heads"), t.alias("t")).filter(F.size("t") > 0))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    runs = rows.select("entity", F.size("t").alias("n"), "heads",
                       F.explode(K.ngrams("t", 1, max_tokens)).alias("g"))
    runs = runs.select("entity", "n", "heads", F.col("g.key").alias("name"), F.col("g.pos").alias("pos"), F.col("g.len").alias("len"))
    hits = runs.join(wanted.filter(F.col("size") <= max_tokens).select("name"), "name")
    starts = rows.select("entity", "heads", "t", F.explode(K.ngrams("t", max_tokens, max_tokens)).alias("g"))
    starts = starts.select("entity", "heads", "t", F.col("g.key").alias("start"), F.col("g.pos").alias("pos"))
    long = wanted.filter(F.col("size") > max_tokens).withColumn("start", F.substring_index("name", " ", max_tokens))
    longer = starts.join(long, "start").filter(F.array_join(F.slice("t", F.col("pos") + 1, F.col("size")), " ") == F.col("name"))
    hits = hits.select("entity", "n", "heads", "name", "pos", "len").unionByName(longer.select(
        "entity", F.size("t").alias("n"), "heads", "name", "pos", F.col("size").alias("len")))
    first = F.substring_index("name", " ", 1)
    second = F.get(F.split("name", " "), F.lit(1))
    pooled = (F.array_contains("heads", first) | ((F.col("len") == 1) & (F.length("name") >= 3))
              | ((first == lineage) & (F.length(second) >= 3)) | ((first == kunya) & (F.length(second) >= 3)))
    score = (F.when((F.col("pos") == 0) & (F.col("len") == F.col("n")), 10).when(F.col("pos") == 0, 9)
             .when((first == lineage) & (F.col("pos") == 1), 8).when(F.col("pos") <= 1, 7).when(F.col("pos") <= 3, 5).otherwise(2))
    # the first place of the run decides, like a search from the left
    hits = hits.filter(pooled).groupBy("name", "entity", "n", "len").agg(F.min("pos").alias("pos"))
    scored = hits.withColumn("s", score).select("name", "entity", "s")
    if aliases is not None:
        scored = scored.unionByName(aliases.join(wanted.select("name"), "name", "left_semi").select("name", "entity", F.lit(9).alias("s")))
    return scored.groupBy("name", "entity").agg(F.max("s").alias("name_score"))
