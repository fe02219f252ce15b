"""Evidence mining from entry texts: attributed statements, dates, traits, source grades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silsila import lexicon as lx
from silsila.functions import keys as K
from silsila.functions import rules as R
from silsila.functions.rules import light_text
from silsila.functions.text import HEADINGS, _col, normalize, staged, stable_id

SAID = "(?:و)?قال"


def statements(c, words=lx.STATEMENT_WORDS, excluded=lx.EXCLUDED_ATTRIBUTIONS, said: str = SAID, opens: str | None = "وقال",
               via: str = "عن", max_critic: int = 80, sentence_end: str = ".؛", colon: str = ":：", folded: bool = True) -> Column:
    """Array of (critic, attribution, statement) for "X said: statement" sentences.

    Kept only when the statement holds a grade word; the critic is the last link of the
    attribution ("X from Y" -> Y).
    """
    # a new "and X said" opens a sentence of its own
    text = F.regexp_replace(_col(c), rf"(?<!^)({opens}\s+)", ".$1") if opens else _col(c)
    pattern = rf"(?:^|[{sentence_end}])\s*{said}\s+([^{colon}]{{2,120}})[{colon}]\s*([^.;؛]{{1,500}})"
    who = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    what = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    rows = F.transform(F.arrays_zip(who.alias("a"), what.alias("s")), lambda r: F.struct(F.trim(r["a"]).alias("attribution"), F.trim(r["s"]).alias("statement")))
    rows = F.transform(rows, lambda r: F.struct(
        F.trim(F.element_at(F.split(r["attribution"], rf"\s+{via}\s+"), -1)).alias("critic"), r["attribution"].alias("attribution"), r["statement"].alias("statement")))

    def kept(r):
        drop = F.lit(False)
        for e in excluded:
            drop = drop | r["attribution"].contains(e)
        n = F.length(r["critic"])
        return R.contains_any(r["statement"], words, folded=folded) & ~drop & (n >= 2) & (n <= max_critic)

    return F.filter(rows, kept)


def critic_rows(cards: DataFrame, card: str, text: str, judge, keep: tuple[str, ...] = (), **kw) -> DataFrame:
    """One row per attributed statement with its judgment class."""
    rows = staged(cards.select(card, *keep, F.col(text).alias("__t")), __s=statements(light_text("__t"), **kw))
    rows = rows.select(card, *keep, F.explode("__s").alias("s")).select(card, *keep, "s.critic", "s.attribution", "s.statement")
    rows = rows.distinct()
    return rows.withColumn("judgment", judge("statement")).withColumn("statement_id", stable_id("CS_", card, *keep, "attribution", "statement"))


def _kept(text: Column, most: int | None) -> Column:
    return F.substring(text, 1, most) if most else text


def word_dates(c, birth=lx.BIRTH_VERBS, death=lx.DEATH_VERBS_WORDS, year: str = "سنة", tails=lx.DATE_TAILS,
               stops: str = "،؛.", number=R.number_words, max_text: int | None = None) -> Column:
    """Array of (event, year, text, confidence) for dates written in words. ``max_text`` cuts the stored text; by default it
    stays whole."""
    cut = rf"\s+{lx.any_of(tails, vocal=False)}{lx.WORD_END}"

    def dated(event, verbs):
        pattern = rf"({lx.any_of(verbs, vocal=False)}[^{stops}]{{0,120}}?\s{year}\s+([^{stops}\]\[]+))"
        whole = F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(1))
        phrase = F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(2))
        found = F.transform(F.arrays_zip(whole.alias("w"), phrase.alias("p")), lambda r: F.struct(
            number(F.split(F.trim(r["p"]), cut, 2)[0]).alias("year"), _kept(r["w"], max_text).alias("text")))
        return F.transform(found, lambda r: F.struct(
            F.lit(event).alias("event"), r["year"].alias("year"), r["text"].alias("text"),
            F.when(r["year"].isNotNull(), 0.92).otherwise(0.55).alias("confidence")))

    return F.concat(dated("birth", birth), dated("death", death))


def digit_dates(c, verbs=(("death", lx.DEATH_VERBS), ("birth", ("ولد", "مولده"))), year_words=lx.YEAR_WORDS,
                stops: str = ".;؛", max_text: int | None = None) -> Column:
    """Array of (event, year, text, confidence) for dates written in digits; ``max_text`` as in :func:`word_dates`."""
    def dated(event, words):
        pattern = rf"({lx.any_of(words, vocal=False)}[^{stops}]{{0,100}}?{lx.any_of(year_words, vocal=False)}\s*\(?\s*(\d{{2,4}}))"
        whole = F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(1))
        digits = F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(2))
        return F.transform(F.arrays_zip(whole.alias("w"), digits.alias("d")), lambda r: F.struct(
            F.lit(event).alias("event"), r["d"].cast("int").alias("year"), _kept(r["w"], max_text).alias("text"), F.lit(0.94).alias("confidence")))

    return F.concat(*[dated(event, words) for event, words in verbs])


def best_years(evidence: DataFrame, entity: str = "entity", event: str = "event", year: str = "year", order: str = "pos") -> DataFrame:
    """Best birth year: the most frequent, the earliest named on a tie. Best death year: the last named.

    Counted per (entity, year) first, so a heavily documented entity is no hot group.
    """
    known = evidence.filter(F.col(year).isNotNull())
    counts = known.groupBy(entity, event, year).agg(
        F.count(F.lit(1)).alias("n"), F.min(order).alias("first"), F.max(order).alias("last"))
    return counts.groupBy(entity).agg(
        F.min_by(F.when(F.col(event) == "birth", F.col(year)), F.when(F.col(event) == "birth", F.struct(-F.col("n"), "first"))).alias("birth_year"),
        F.max_by(F.when(F.col(event) == "death", F.col(year)), F.when(F.col(event) == "death", F.col("last"))).alias("death_year"))


def trait_rows(cards: DataFrame, card: str, flags: list[str], text: str | None = None) -> DataFrame:
    """One evidence row per true flag."""
    values = [text] if text else []
    long = cards.select(card, *values, *flags).unpivot([card, *values], flags, "trait", "value")
    return long.filter("value = 1").drop("value")


def structured_cards(cards: DataFrame, card: str, summary: str, years: DataFrame) -> DataFrame:
    """Grade, class, trait flags and best years of each card from its summary and dates."""
    rows = cards.select(card, summary, R.summary_grade(summary).alias("grade"), R.class_ordinal(summary).alias("tabaqa"), *R.trait_flags(summary))
    rows = rows.join(years.withColumnRenamed("entity", card), card, "left")
    has = F.coalesce(F.col(summary), F.lit("")) != ""
    return rows.withColumn("grade", R.shared_grade("grade")).withColumn(
        "structured_status", F.when(has, "structured_summary").otherwise("no_summary"))


def match_secondary(anchors: DataFrame, entries: DataFrame, anchor: str = "anchor", name: str = "name_norm",
                    entry: str = "entry_id", heading: str = "heading_norm", source: str = "source") -> DataFrame:
    """(anchor, source, entry): per source, the entry found by the longest unique heading prefix.

    The source is part of the index, so all sources are matched in one join.
    """
    t = K.tokens(heading)
    keyed = entries.select(F.col(source).alias("source"), F.col(entry).alias("entity"), F.size(t).alias("size"),
                           F.explode(K.prefixes(t, 2, 7)).alias("p"))
    keyed = keyed.select("source", "entity", "size", F.col("p.key").alias("k"), F.col("p.len").alias("len"))
    ends = F.when(F.col("size") == F.col("len"), F.col("entity"))
    blocks = keyed.groupBy("source", "k", "len").agg(
        F.min("entity").alias("lo_all"), F.max("entity").alias("hi_all"), F.min(ends).alias("lo_end"), F.max(ends).alias("hi_end"))
    t = K.tokens(name)
    probes = anchors.select(anchor, F.size(t).alias("__size"), F.explode(K.prefixes(t, 2, 6)).alias("p"))
    hits = probes.select(anchor, "__size", F.col("p.key").alias("k")).join(blocks, "k")
    free = (F.col("len") >= 3) | (F.col("__size") == F.col("len"))
    hits = hits.select(anchor, "source", "len", F.when(free, F.col("lo_all")).otherwise(F.col("lo_end")).alias("a"),
                       F.when(free, F.col("hi_all")).otherwise(F.col("hi_end")).alias("b")).filter("a IS NOT NULL")
    best = hits.groupBy(anchor, "source").agg(F.max(F.struct("len", "a", "b")).alias("m")).filter("m.a = m.b")
    return best.select(anchor, F.col("source").alias(source), F.col("m.a").alias(entry), F.col("m.len").alias("matched_len"))


def source_grades(matched: DataFrame, source: str, text: str, triggers=None) -> DataFrame:
    """Grade evidence of the sources that speak for one critic.

    ``triggers``: start of the source title -> (words, characters kept of the text or None for all, critic, confidence).
    """
    triggers = triggers or lx.SOURCE_GRADE_TRIGGERS
    norm = normalize(text, HEADINGS)
    critic = kept = conf = None
    for start, (words, chars, who, confidence) in triggers.items():
        hit = F.col(source).startswith(start) & R.contains_any(norm, words)
        critic = F.when(hit, who) if critic is None else critic.when(hit, who)
        kept = F.when(hit, _kept(F.col(text), chars)) if kept is None else kept.when(hit, _kept(F.col(text), chars))
        conf = F.when(hit, confidence) if conf is None else conf.when(hit, confidence)
    rows = staged(matched, critic=critic, exact_text=kept, confidence=conf).filter(F.col("critic").isNotNull())
    return rows.withColumn("judgment", R.secondary_grade("exact_text"))


def coverage(matched: DataFrame, source: str, anchor: str) -> DataFrame:
    """Cards with evidence per source."""
    return matched.select(source, anchor).distinct().groupBy(source).agg(F.count(F.lit(1)).alias("cards"))
