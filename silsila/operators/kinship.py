"""Kinship pointers. "His father" is never a name; it resolves from the governing entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silsila import lexicon as lx
from silsila.functions import keys as K
from silsila.functions.text import cut_at_words
from silsila.operators.blocking import prefix_index
from silsila.operators.chains import POSITION, guarded_neighbours
from silsila.operators.resolve import best_two, top_k
from silsila.plans.session import checkpointed


def kin_tokens(c, kind, tokens=lx.KIN_TOKENS, relational: str = "relational_or_unknown",
               cuts=lx.RELATIVE_CUTS):
    """(token, explicit relative text): the bare token of a relational mention, or the token
    that opens a longer expression together with what follows it."""
    c = F.col(c) if isinstance(c, str) else c
    kind = F.col(kind) if isinstance(kind, str) else kind
    lead = "^(" + "|".join(lx.quote(t) for t in tokens) + ") (.+)$"
    token = F.when((kind == relational) & c.isin(*tokens), c).otherwise(F.nullif(F.regexp_extract(c, lead, 1), F.lit("")))
    return token, cut_at_words(F.regexp_extract(c, lead, 2), cuts)


def label_matches(labels: DataFrame, entries: DataFrame, kunya_index: DataFrame, kunya=("ابي", "ابو")) -> DataFrame:
    """(label, entry, score) for explicit relative names.

    A plain name takes the longest entry prefix it starts with (9 from three tokens on, else 6).
    A kunya looks up its first two tokens among the entries' own kunyas; further tokens must
    all occur in the entry's introduction (9 with, 6 without such tokens). Labels with further tokens
    meet the distinct introductions by trigrams, never the whole block of a common kunya.

    ``entries``: entry, name_norm, intro. ``kunya_index``: key, entry.
    """
    t = K.tokens("label")
    rows = labels.select("label", t.alias("t")).distinct()
    is_kunya = F.get("t", F.lit(0)).isin(*kunya)
    probes = rows.filter(~is_kunya).select("label", F.explode(K.prefixes("t", 2, 7)).alias("p")).select("label", "p.key", "p.len")
    index = prefix_index(entries, "entry", "name_norm", 2, 8)
    keys = index.select("key").distinct()
    longest = probes.join(keys, "key").groupBy("label").agg(F.max("len").alias("len"))
    named = probes.join(longest, ["label", "len"]).join(index.select("key", "entity"), "key").select(
        "label", F.col("entity").alias("entry"), F.when(F.col("len") >= 3, 9).otherwise(6).alias("score"))
    head = F.concat(F.lit(kunya[1] + " "), F.get("t", F.lit(1)))
    wanted = rows.filter(is_kunya).select("label", head.alias("key"), F.filter(F.slice("t", F.lit(3), F.size("t")), lambda x: F.length(x) > 2).alias("extras"))
    # a text is judged once per key, however many entries share it
    called = kunya_index.join(wanted.select("key").distinct(), "key", "left_semi").join(entries.select("entry", "intro"), "entry")
    called = called.withColumn("text_id", F.sha2("intro", 256))
    every = wanted.filter(F.size("extras") == 0).join(called, "key").select("label", "entry", F.lit(6).alias("score"))
    held = _texts_with_all(wanted.filter(F.size("extras") > 0), called.select("key", "text_id", "intro").distinct())
    some = held.join(called.select("key", "text_id", "entry"), ["key", "text_id"]).select("label", "entry", F.lit(9).alias("score"))
    return named.unionByName(every).unionByName(some)


def _trigrams(c):
    return F.array_distinct(F.regexp_extract_all(c, F.lit("(?s)(?=(.{3}))"), F.lit(1)))


def _texts_with_all(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """(label, key, text_id): texts of the key that contain all ``extras`` of the label, each of three characters or more.

    A text that contains a word contains its trigrams, so a label meets only the texts of its key that hold its rarest one.
    ``wanted``: label, key, extras. ``texts``: key, text_id, intro.
    """
    asked = wanted.select("label", "key", F.explode(F.array_distinct(F.flatten(F.transform("extras", _trigrams)))).alias("gram"))
    grams = texts.select("key", "text_id", F.explode(_trigrams(F.col("intro"))).alias("gram")).join(
        asked.select("key", "gram").distinct(), ["key", "gram"], "left_semi")
    counts = grams.groupBy("key", "gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = asked.join(counts, ["key", "gram"], "left").groupBy("label", "key").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r")).select("label", "key", "r.gram")
    met = rarest.join(grams, ["key", "gram"]).select("label", "key", "text_id")
    met = met.join(texts, ["key", "text_id"]).join(wanted, ["label", "key"])
    return met.filter(F.forall("extras", lambda x: F.col("intro").contains(x))).select("label", "key", "text_id")


def ancestor_matches(names: DataFrame, index: DataFrame, name: str, lineage: str = "بن",
                     skip=("ابي", "ابو"), lo: int = 3, hi: int = 7) -> DataFrame:
    """(name, key, entry bounds): entries named by the longest prefix of what follows the first lineage word.

    Bounds suffice: two different entries under one key tie and resolve nothing.
    """
    tail = names.select(name).distinct().withColumn("__t", K.tokens(K.lineage_tail(name, lineage)))
    if skip:
        tail = tail.filter(~F.coalesce(F.get("__t", F.lit(0)), F.lit("")).isin(*skip))
    probes = tail.select(name, F.explode(K.prefixes("__t", lo, hi)).alias("p")).select(name, "p.key", "p.len")
    bounds = index.groupBy("key").agg(F.min("entity").alias("first"), F.max("entity").alias("last"))
    hit = probes.join(bounds, "key").groupBy(name).agg(F.max(F.struct("len", "key", "first", "last")).alias("b"))
    return hit.select(name, F.col("b.key").alias("key"), F.col("b.first").alias("first"), F.col("b.last").alias("last"))


def resolve_kinship(occ: DataFrame, entries: DataFrame, explicit: DataFrame | None = None, lineage: str = "بن",
                    father=lx.FATHER_TOKENS, grandfather=lx.GRANDFATHER_TOKENS) -> DataFrame:
    """Resolve kinship nodes from their governing node (the singleton right before them; the node itself may share its
    position with others).

    ``occ``: position columns, occurrence_id, entity (NULL when open), token (NULL for names),
    label (explicit relative, '' when none). ``entries``: entry, name_norm; entities are entries.
    ``explicit``: label, entry, score from :func:`label_matches`.

    Father: the lineage tail of the governing name, three tokens and more; score 7. Grandfather:
    the same, when the governing node is itself a resolved father pointer; score 8. A tie, or a
    best score below 7 or less than 2 ahead, stays unresolved and is recorded with the number of its
    candidates and the five best of them (``candidate_count``, ``top``; both NULL for resolved nodes). A node depends
    only on the node before it, so passes run until nothing new is resolved; a chain of pointers may be of any length.
    """
    index = prefix_index(entries, "entry", "name_norm", 2, 8).select("key", "entity")
    if explicit is not None:
        explicit = checkpointed(explicit.withColumnRenamed("entry", "candidate").groupBy("label", "candidate").agg(F.sum("score").alias("score")))
    # a tail that opens with a kunya word is no lineage for the father rule
    fathers = ancestor_matches(entries, index, "name_norm", lineage).select(
        F.col("name_norm").alias("gov_name"), F.col("key").alias("fk"), F.col("first").alias("f1"), F.col("last").alias("f2"))
    grands = ancestor_matches(entries, index, "name_norm", lineage, skip=()).select(
        F.col("name_norm").alias("gov_name"), F.col("key").alias("gk"), F.col("first").alias("g1"), F.col("last").alias("g2"))
    kin = entries.select(F.col("entry").alias("gov"), F.col("name_norm").alias("gov_name")).join(fathers, "gov_name", "left").join(grands, "gov_name", "left")
    kin = checkpointed(kin.drop("gov_name"))
    single = guarded_neighbours(occ, ["entity", "token"], sides=())
    before = single.select("chain_id", "branch_hint", (F.col("sequence_index") + 1).alias("sequence_index"), F.col("entity").alias("gov"),
                           F.col("token").isin(*father).alias("after_father"))
    nodes = occ.filter(F.col("token").isNotNull() & F.col("entity").isNull()).select(*POSITION, "occurrence_id", "token", "label")
    state = nodes.join(before, POSITION).join(single.select(*POSITION, F.lit(True).alias("alone")), POSITION, "left")
    waiting, out, number = checkpointed(state), None, 0
    while True:
        number += 1
        ready = waiting.filter(F.col("gov").isNotNull())
        judged = _judge_kin(ready, kin, explicit, father, grandfather).withColumn("pass_no", F.lit(number))
        judged = checkpointed(judged)
        if judged.isEmpty():
            break
        out = judged if out is None else out.unionByName(judged)
        # only a node that stands alone governs the next one
        news = judged.filter("status = 'resolved' AND alone").select(
            "chain_id", "branch_hint", (F.col("sequence_index") + 1).alias("sequence_index"), F.col("entity").alias("__gov"))
        waiting = checkpointed(
            waiting.filter(F.col("gov").isNull()).join(news, POSITION, "left")
            .withColumn("gov", F.col("__gov")).drop("__gov"))
    return with_best_candidates((judged if out is None else out).drop("alone"), index, explicit)


def with_best_candidates(judged: DataFrame, index: DataFrame, explicit: DataFrame | None, k: int = 5) -> DataFrame:
    """Add ``candidate_count`` and ``top``, the ``k`` best (candidate, score), to the unresolved nodes.

    Blocks and labels are ranked once each and in bounded form, so a node that shares its block with many is met by one row.
    ``index``: key, entity; ``explicit``: label, candidate, score.
    """
    open_ = F.col("status") == "unresolved"
    keys = judged.filter(open_ & F.col("key").isNotNull()).select("key").distinct()
    blocks = index.join(keys, "key", "left_semi").select("key", F.col("entity").alias("candidate"), F.lit(0).alias("score"))
    by_key = top_k(blocks, ["key"], "score", k).withColumnRenamed("top", "key_top").join(
        blocks.groupBy("key").agg(F.count(F.lit(1)).alias("key_count")), "key")
    rows = judged.join(by_key, "key", "left")
    top = F.transform("key_top", lambda c: F.struct(c["candidate"].alias("candidate"), F.col("score").alias("score")))
    count = F.col("key_count")
    if explicit is not None:
        labels = judged.filter(open_ & (F.col("label") != "")).select("label").distinct()
        named = explicit.join(labels, "label", "left_semi")
        by_label = top_k(named, ["label"], "score", k).withColumnRenamed("top", "label_top").join(
            named.groupBy("label").agg(F.count(F.lit(1)).alias("label_count")), "label")
        rows = rows.join(by_label, "label", "left")
        top, count = F.coalesce("label_top", top), F.coalesce("label_count", count)
    none = F.array().cast(f"array<struct<candidate:{index.schema['entity'].dataType.simpleString()},score:int>>")
    return rows.select(*[c for c in judged.columns if c != "key"], F.when(open_, F.coalesce(count, F.lit(0))).alias("candidate_count"),
                       F.when(open_, F.coalesce(top, none)).alias("top"))


def _judge_kin(ready: DataFrame, kin: DataFrame, explicit: DataFrame | None, father, grandfather) -> DataFrame:
    rows = ready.join(kin, "gov", "left")
    plain = F.col("label") == ""
    use_father = plain & F.col("token").isin(*father)
    use_grand = plain & F.col("token").isin(*grandfather) & F.coalesce("after_father", F.lit(False))
    implied = rows.select(
        *POSITION, "occurrence_id", "alone", "token", "label", "gov",
        F.when(use_father, F.col("fk")).when(use_grand, F.col("gk")).alias("key"),
        F.when(use_father, F.col("f1")).when(use_grand, F.col("g1")).alias("first"),
        F.when(use_father, F.col("f2")).when(use_grand, F.col("g2")).alias("last"),
        F.when(use_father, 7).when(use_grand, 8).alias("s"))
    if explicit is not None:
        best = best_two(explicit, ["label"], "score", []).select(
            "label", F.col("candidate").alias("ex"), F.col("score").alias("exs"), F.col("runner_up").alias("exr"))
        implied = implied.join(best, "label", "left")
    else:
        implied = implied.withColumn("ex", F.lit(None)).withColumn("exs", F.lit(None).cast("int")).withColumn("exr", F.lit(None).cast("int"))
    one = F.col("first") == F.col("last")
    score = F.coalesce(F.col("exs"), F.when(F.col("first").isNotNull(), F.col("s")), F.lit(0)).cast("int")
    entity = (F.when(F.col("ex").isNotNull(), F.when((F.col("exs") >= 7) & (F.col("exr").isNull() | (F.col("exs") >= F.col("exr") + 2)), F.col("ex")))
              .when(one, F.col("first")))
    done = implied.withColumn("score", score).withColumn("entity", entity)
    status = F.when(F.col("entity").isNull(), "unresolved").otherwise("resolved")
    method = F.when(F.col("label") != "", "explicit_relative").when(F.col("token").isin(*grandfather), "grandfather_after_father").otherwise("father_lineage")
    return done.select(*POSITION, "occurrence_id", "alone", "token", "label", "key", "gov", "entity", "score", F.col("exr").alias("runner_up"),
                       status.alias("status"), method.alias("method"))


def resolve_strict_father(open_nodes: DataFrame, cards: DataFrame, next_edges: DataFrame, father=lx.FATHER_TOKENS,
                          lineage: str = "بن", compound=("عبد", "ابو", "ام")) -> DataFrame:
    """Card-level father: father + grandfather of the governing card name one card, and the
    next resolved node is among that card's teachers. All guards must hold.

    ``open_nodes``: position columns, occurrence_id, token, prev, next. ``cards``: card,
    identity_norm. ``next_edges``: candidate, node.
    """
    segs = F.transform(F.split("identity_norm", rf"\s+{lx.quote(lineage)}\s+"), lambda s: K.person_name(s, compound))
    lines = cards.select("card", segs.alias("s"))
    link = f" {lineage} "
    ahead = lines.filter(F.size("s") >= 3).select(F.col("card").alias("prev"), F.array_join(F.slice("s", 2, 2), link).alias("key"))
    own = lines.filter(F.size("s") >= 2).select("card", F.array_join(F.slice("s", 1, 2), link).alias("key"))
    unique = own.groupBy("key").agg(F.min("card").alias("a"), F.max("card").alias("b")).filter("a = b").select("key", F.col("a").alias("entity"))
    rows = open_nodes.filter(F.col("token").isin(*father)).join(ahead, "prev").join(unique, "key")
    proof = next_edges.select(F.col("candidate").alias("entity"), F.col("node").alias("next")).distinct()
    return rows.join(proof, ["entity", "next"], "left_semi")
