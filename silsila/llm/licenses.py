"""License scan: ordered signature rules gated by keywords, resolved by priority and interval containment.

DataFrame functions only. Texts without an anchor word leave early; the rest is reduced to its words, and each rule of
a family whose keyword occurs marks its matches in one pass. A match inside a match of the same or a better tier is
suppressed; of equal intervals the rule that comes first stays.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silsila.llm.common import cut, join_classes
from silsila.llm.license_rules import ANCHORS, GROUPS, LONE_ANCHORS, PHRASES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_OPEN, _CLOSE = "\u0001", "\u0002"                     # neither is a word character
TIERS = (1, 2, 3, 4)


def word_text(text: Column) -> Column:
    """The words of a text with A-Z lower-cased, one blank before, between and after them."""
    return F.translate(F.concat(F.lit(" "), F.trim(F.regexp_replace(text, _BETWEEN, " ")), F.lit(" ")), UPPER, LOWER)


def _gate(text: Column) -> Column:
    low = F.lower(text)

    def has(words):
        return reduce(or_, (F.contains(low, F.lit(w)) for w in words))

    return has(ANCHORS) | (has(LONE_ANCHORS) & low.rlike(rf"(^|[^a-z])({'|'.join(LONE_ANCHORS)})([^a-z]|$)"))


def _groups() -> Column:
    """The rules as one constant; phrases are rules of tier 0, numbered below the others."""
    groups = [{"keywords": [p], "rules": [{"number": i - len(PHRASES), "label": label, "tier": 0, "confidence": 1.0, "pattern": p}]}
              for i, (p, label) in enumerate(PHRASES)]
    groups += [{"keywords": words, "rules": [r._asdict() for r in rules]} for words, rules in GROUPS]
    rule = "struct<number:int,label:string,tier:int,confidence:double,pattern:string>"
    return F.from_json(F.lit(json.dumps(groups)), f"array<struct<keywords:array<string>,rules:array<{rule}>>>")


def matches(words: DataFrame) -> DataFrame:
    """(key, label, tier, number, confidence, first, last) per match of a rule or phrase in ``words`` (key, word_text).

    Positions are words from 0. Rows of one key must have one text; its matches come once."""
    tried = F.flatten(F.transform(
        F.filter(_groups(), lambda g: F.exists(g["keywords"], lambda k: F.contains("word_text", k))), lambda g: g["rules"]))
    rows = words.select("key", "word_text", F.explode(tried).alias("r"))
    pattern = F.concat(F.lit("(?<= )("), F.col("r.pattern"), F.lit(")(?= )"))
    rows = rows.filter(F.rlike("word_text", pattern))
    marked = F.split(F.trim(F.regexp_replace("word_text", pattern, F.lit(f"{_OPEN}$1{_CLOSE}"))), " ")

    def places(test):
        return F.filter(F.transform("marked", lambda w, i: F.when(test(w), i)), lambda i: i.isNotNull())

    rows = rows.select("key", "r", marked.alias("marked")).select("key", "r", F.explode(F.arrays_zip(
        places(lambda w: F.startswith(w, F.lit(_OPEN))).alias("first"),
        places(lambda w: F.endswith(w, F.lit(_CLOSE))).alias("last"))).alias("p"))
    return rows.select("key", "r.label", "r.tier", "r.number", "r.confidence", F.col("p.first").cast("long").alias("first"),
                       F.col("p.last").cast("long").alias("last")).distinct()


def resolve(found: DataFrame) -> DataFrame:
    """Matches that stay: those not inside another of the same or a better tier (of equal ones the first rule)."""
    before = Window.partitionBy("key").orderBy("first", F.desc("last"), "tier", "number").rowsBetween(
        Window.unboundedPreceding, -1)
    reach = found
    for t in TIERS:
        reach = reach.withColumn(f"__reach{t}", F.max(F.when(F.col("tier") <= t, F.col("last"))).over(before))
    own = F.lit(None).cast("long")
    for t in TIERS:
        own = F.when(F.col("tier") == t, F.col(f"__reach{t}")).otherwise(own)
    return reach.filter(F.coalesce(own < F.col("last"), F.lit(True))).select(*found.columns)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the best confidence of what was found (a phrase has 1), 0 without any. Null text counts as empty: no
    words, no places, empty labels, null positions. Copies are resolved once; repeated rows repeat; empty input gives no
    rows; columns besides doc_id and text are not read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = cut(docs.select("doc_id", text.alias("text")).select(
        "doc_id", F.regexp_count("text", F.lit(_WORD)).cast("long").alias("n_words"),
        F.when(_gate(F.col("text")), F.struct(F.sha2("text", 256).alias("key"), word_text(F.col("text")).alias("word_text"))).alias("g")))
    some = rows.filter("g is not null").select("doc_id", "n_words", "g.*")
    found = cut(matches(some.select("key", "word_text")))
    base = found.filter("tier = 0").groupBy("key").agg(
        F.count("*").alias("n_base"), F.min("first").alias("first_word"), F.max("first").alias("last_word"),
        F.collect_set("label").alias("base"))
    kept = resolve(found.filter("tier > 0")).groupBy("key").agg(F.collect_set("label").alias("more"), F.max("confidence").alias("best"))
    none = F.array().cast("array<string>")
    copies = some.groupBy("key").agg(F.count("*").alias("copies"))
    labelled = copies.join(base.join(kept, "key", "full"), "key").select(
        "key", "copies", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(F.coalesce("base", none), F.coalesce("more", none))), ",").alias("labels"),
        F.greatest("best", F.when(F.col("n_base") > 0, F.lit(1.0))).alias("score"))
    out = join_classes(some.select("doc_id", "n_words", "key"), cut(labelled), "key", "copies").drop("key", "copies")
    out = out.unionByName(rows.filter("g is null").select("doc_id", "n_words"), allowMissingColumns=True)
    return out.fillna({"n_base": 0, "base_labels": "", "labels": "", "score": 0.0})


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def oracle() -> str:
    """The same scan in DuckDB SQL: blanks are doubled so that neighbouring matches do not share one."""
    rules = [(i - len(PHRASES), label, 0, 1.0, [p], p) for i, (p, label) in enumerate(PHRASES)]
    rules += [(r.number, r.label, r.tier, r.confidence, words, r.pattern) for words, group in GROUPS for r in group]
    values = ",\n".join(
        f"({n}, {_quoted(label)}, {t}, {c}, [{', '.join(map(_quoted, k))}], {_quoted(' (?:' + p.replace(' ', '  ') + ') ')})"
        for n, label, t, c, k, p in rules)
    reach = "CASE tier " + " ".join(
        f"WHEN {t} THEN max(CASE WHEN tier <= {t} THEN last_at END) OVER before" for t in TIERS) + " END"
    return rf"""
WITH rules(number, label, tier, confidence, keywords, pattern) AS (VALUES {values}),
docs AS (SELECT row_number() OVER () AS k, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS words
         FROM documents),
flat AS (SELECT k, doc_id, len(words) AS n_words, '  ' || array_to_string(words, '  ') || '  ' AS t, ' ' || array_to_string(words, ' ') || ' ' AS s
         FROM docs),
tried AS (SELECT k, t, rules.* FROM flat JOIN rules ON len(list_filter(keywords, lambda w: contains(s, w))) > 0),
cuts AS (SELECT k, number, label, tier, confidence, list_transform(string_split_regex(t, pattern), lambda x: len(regexp_extract_all(x, '[^ ]+'))) AS gaps,
                list_transform(regexp_extract_all(t, pattern), lambda x: len(regexp_extract_all(x, '[^ ]+'))) AS sizes FROM tried),
found AS (SELECT k, number, label, tier, confidence, list_sum(gaps[1:i]) + coalesce(list_sum(sizes[1:i - 1]), 0) AS first_at,
                 list_sum(gaps[1:i]) + list_sum(sizes[1:i]) - 1 AS last_at
          FROM (SELECT *, unnest(range(1, len(sizes) + 1)) AS i FROM cuts WHERE len(sizes) > 0)),
base AS (SELECT k, count(*) AS n_base, min(first_at) AS first_word, max(first_at) AS last_word, list(DISTINCT label) AS base
         FROM found WHERE tier = 0 GROUP BY k),
ranked AS (SELECT *, {reach} AS reach FROM found WHERE tier > 0
           WINDOW before AS (PARTITION BY k ORDER BY first_at, last_at DESC, tier, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
kept AS (SELECT k, list(DISTINCT label) AS more, max(confidence) AS best FROM ranked WHERE reach IS NULL OR reach < last_at GROUP BY k)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ',') AS labels,
       CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS DOUBLE) AS score
FROM flat LEFT JOIN base USING (k) LEFT JOIN kept USING (k)"""
