"""Queries over cards, evidence, link analysis, reports, audits and the reader mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silsila.functions import keys as K
from silsila.functions import rules as R
from silsila.functions import text as T
from silsila.operators import analyze as AN
from silsila.operators import audit as AU
from silsila.operators import blocking as B
from silsila.operators import cards as CD
from silsila.operators import chains as C
from silsila.operators import evidence as EV
from silsila.operators import extract as E
from silsila.operators import resolve as RS
from silsila.operators.relations import reconcile
from silsila.plans import mart as M
from silsila.plans.bindings import (
    LINES, PROSE, documents, flagged_pairs, line_atoms, line_nodes, named_line_nodes, supplier_index, supplier_years, table,
)
from silsila.plans.chain_queries import (
    _BILATERAL, _CARD, _LAYERS, _SPAN, card_edges, layers, open_lines, pair_evidence, supplier_spans,
)
from silsila.plans.registry import ORACLES, query
from silsila.plans.text_queries import plain
from silsila.sources.manifest import run_audit
from silsila.sources.tables import insert_absent

# -- entries and cards ----------------------------------------------------------------------

PROSE_LABELS = T.Labels(" with ", " for ", " and ", " the ")
_WITH = r"CASE WHEN regexp_matches({c}, '(?i){a}') THEN trim(regexp_extract(regexp_replace({c}, '(?is)^.*?{a}', ''), '(?is)^(.*?)(?:{e}|$)', 1)) ELSE '' END"


def _section(c: str, a: str, e: str) -> str:
    return _WITH.format(c=c, a=a, e=e)


@query("entry_index", rf"""
WITH s AS (SELECT doc_id, trim(substr(regexp_extract(text, '(?s)^(.*?)(?: with | for |$)', 1), 1, 900)) AS heading,
      {_section("text", " with ", " for | and ")} AS teachers, {_section("text", " for ", " and | the ")} AS students FROM documents),
n AS (SELECT *, substr(trim(regexp_extract(regexp_replace(heading, '^\s*(?:[A-Z]\s)?', ''), '(?s)^(.*?)(?:[.,]|$)', 1), ' ،؛;:.()-'), 1, 400) AS name FROM s)
SELECT doc_id, {plain("name")} AS canonical_norm, sha256(teachers) AS teachers_sha, sha256(students) AS students_sha,
       CASE WHEN teachers <> '' AND students <> '' THEN 0.95 WHEN teachers <> '' OR students <> '' THEN 0.80 ELSE 0.35 END::DOUBLE AS confidence FROM n""")
def entry_index(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", F.col("text").alias("body"))
    rows = CD.entry_index(docs, "body", PROSE_LABELS, sigla=r"^\s*(?:[A-Z]\s)?", ends="[.,]")
    return rows.select("doc_id", "canonical_norm", F.sha2("teachers_raw", 256).alias("teachers_sha"), F.sha2("students_raw", 256).alias("students_sha"), "confidence")


@query("summary_cards", rf"""
WITH a AS (SELECT doc_id AS anchor, split_part(text, '.', 1) AS nm FROM documents),
ant AS (SELECT anchor, list_filter(string_split(trim(regexp_replace(nm, '\s+', ' ', 'g'), ' ،؛;:.-'), ' '), lambda x: x <> '') AS t FROM a),
st AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(text, '\s+', ' ', 'g'), ' ،؛;:.-'), ' '), lambda x: x <> '') AS t FROM documents),
k AS (SELECT DISTINCT doc_id, l, array_to_string(t[1:l], ' ') AS key FROM (SELECT doc_id, t, unnest(range(2, least(7, len(t)) + 1)) AS l FROM st)),
p AS (SELECT anchor, l, array_to_string(t[1:l], ' ') AS key FROM (SELECT anchor, t, unnest(range(2, least(6, len(t)) + 1)) AS l FROM ant)),
b AS (SELECT anchor, p.l, min(doc_id) AS s, count(DISTINCT doc_id) AS n FROM p JOIN k USING (key) GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY p.l DESC) = 1),
j AS (SELECT a.anchor, b.s FROM a LEFT JOIN b ON a.anchor = b.anchor AND n = 1),
x AS (SELECT anchor, s, list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '((?:de)\s+.{{0,180}})', 1), lambda m: trim(regexp_extract(m, '(?s)^([^.؛\[\]]*)', 1))), lambda m: m <> '') AS ph
      FROM j LEFT JOIN documents d ON d.doc_id = j.s),
u AS (SELECT anchor, s, list_filter(ph, lambda m, i: list_position(ph, m) = i) AS ph FROM x)
SELECT anchor, s AS summary_no, array_to_string(ph[1:3], ' | ') AS death_text, CASE WHEN s IS NULL THEN 'entry_only' ELSE 'entry+summary' END AS card_status FROM u""")
def summary_cards(spark, d):
    docs = documents(spark, d)
    anchors = docs.select(F.col("doc_id").alias("anchor"), F.col("doc_id").alias("entry_id"), F.substring_index("text", ".", 1).alias("canonical_name"))
    entries = docs.select(F.col("doc_id").alias("entry_id"), "source")
    summaries = docs.select(F.col("doc_id").alias("summary_no"), F.lit("").alias("summary_page"), F.col("text").alias("summary_text"))
    return CD.summary_cards(anchors, entries, summaries, ("de",)).select("anchor", "summary_no", "death_text", "card_status")


@query("alias_table", rf"""
WITH a AS (SELECT p_partkey AS anchor, p_name AS alias_norm, 'canonical' AS alias_type FROM part
  UNION ALL SELECT p_partkey, p_brand || ' ' || p_name, 'source_heading' FROM part
  UNION ALL SELECT p_partkey, p_brand, 'source_heading' FROM part WHERE contains(p_brand, ' '))
SELECT DISTINCT anchor, alias_type, alias_norm FROM a""")
def alias_table(spark, d):
    part = table(spark, d, "part")
    anchors = part.select(F.col("p_partkey").alias("anchor"), F.col("p_name").alias("canonical_name"))
    heads = part.select(F.col("p_partkey").alias("anchor"), F.lit("a").alias("source"), F.col("p_partkey").cast("string").alias("entry_id"), F.concat_ws(" ", "p_brand", "p_name").alias("heading")).unionByName(
        part.select(F.col("p_partkey").alias("anchor"), F.lit("b").alias("source"), F.col("p_partkey").cast("string").alias("entry_id"), F.col("p_brand").alias("heading")))
    return CD.alias_table(anchors, heads).select("anchor", "alias_type", "alias_norm")


_IDENT = r"trim(substr(regexp_extract(regexp_replace(text, '^\s*\d+\s*-\s*', ''), '(?s)^(.*?)(?:\s+(?:the|de|of)|$)', 1), 1, 600))"


def prose_cards(spark: SparkSession, d: str) -> DataFrame:
    """Documents as source cards; the identity ends before the first cut word."""
    docs = documents(spark, d).select(F.col("doc_id").alias("entry_no"), F.col("source").alias("page"), "text")
    return CD.source_cards(docs, cuts=("the", "de", "of"))


@query("source_cards", rf"""
SELECT doc_id AS entry_no, source AS page, 'TQ_' || substr(sha256(concat_ws(chr(31), doc_id::VARCHAR, source, text)), 1, 20) AS card_id, {_IDENT} AS identity_text,
       trim(regexp_replace(translate({_IDENT}, '[]«»()', '      '), '\s+', ' ', 'g'), ' ،؛;:.-') AS identity_norm FROM documents""")
def source_cards(spark, d):
    return prose_cards(spark, d).drop("full_text")


@query("source_card_aliases", rf"""
WITH c AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(translate({_IDENT}, '[]«»()', '      '), '\s+', ' ', 'g'), ' ،؛;:.-'), ' '), lambda x: x <> '') AS t FROM documents),
u AS (SELECT doc_id, array_to_string(t, ' ') AS alias, 'identity' AS alias_type FROM c UNION SELECT doc_id, t[1], 'first_name' FROM c WHERE len(t) > 0
      UNION SELECT doc_id, array_to_string(t[1:l], ' '), 'name_prefix' FROM (SELECT doc_id, t, unnest(range(2, least(6, len(t)) + 1)) AS l FROM c))
SELECT doc_id AS entry_no, alias_type, count(*) AS aliases, max(alias) AS last_alias FROM u WHERE length(alias) >= 2 GROUP BY 1, 2""")
def source_card_aliases(spark, d):
    cards = prose_cards(spark, d)
    rows = CD.source_card_aliases(cards, lineage="xbn", kunya=("xabu",)).join(cards.select("card_id", "entry_no"), "card_id")
    return rows.groupBy("entry_no", "alias_type").agg(F.count(F.lit(1)).alias("aliases"), F.max("alias").alias("last_alias"))


_LINKED = rf"""
c AS (SELECT doc_id, text, list_filter(string_split(trim(regexp_replace(translate({_IDENT}, '[]«»()', '      '), '\s+', ' ', 'g'), ' ،؛;:.-'), ' '), lambda x: x <> '') AS t FROM documents),
en AS (SELECT conv_id * 100 + turn AS entry_id, text AS body, list_filter(string_split(trim(regexp_replace(translate(split_part(text, '.', 1), '[]«»()', '      '), '\s+', ' ', 'g'), ' ،؛;:.-'), ' '), lambda x: x <> '') AS t FROM conversations
       UNION ALL SELECT 1000000000 + doc_id, text, t FROM c),
k AS (SELECT DISTINCT entry_id, array_to_string(t[1:l], ' ') AS key FROM (SELECT entry_id, t, unnest(range(2, least(7, len(t)) + 1)) AS l FROM en)),
p AS (SELECT doc_id, l, array_to_string(t[1:l], ' ') AS key FROM (SELECT doc_id, t, unnest(range(2, least(6, len(t)) + 1)) AS l FROM c)),
b AS (SELECT doc_id, l, min(entry_id) AS entry_id, count(DISTINCT entry_id) AS n FROM p JOIN k USING (key) GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY l DESC) = 1)"""


@query("card_relationship_text", rf"""
WITH {_LINKED} SELECT doc_id AS entry_no, entry_id, sha256({_section("body", " with ", " for | and ")}) AS teachers_sha, sha256({_section("body", " for ", " and | the ")}) AS students_sha
FROM b JOIN en USING (entry_id) WHERE n = 1""")
def card_relationship_text(spark, d):
    """Cards linked to entries by the longest unique heading prefix, with the entry's list texts."""
    cards = prose_cards(spark, d)
    conv = table(spark, d, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("entry_id"), F.col("text").alias("body"), F.substring_index("text", ".", 1).alias("heading"))
    own = cards.select((F.col("entry_no") + 1_000_000_000).alias("entry_id"), F.col("full_text").alias("body"), F.col("identity_text").alias("heading"))
    entries = conv.unionByName(own)
    texts = CD.relationship_text(CD.secondary_links(cards, entries), entries, labels=PROSE_LABELS)
    return texts.join(cards.select("card_id", "entry_no"), "card_id").select(
        "entry_no", "entry_id", F.sha2("teachers_raw", 256).alias("teachers_sha"), F.sha2("students_raw", 256).alias("students_sha"))


@query("card_anchor_links", """
WITH one AS (SELECT p_size * 100000 + floor(p_retailprice)::BIGINT AS entry_no, min(p_partkey) AS card_id FROM part GROUP BY 1 HAVING count(*) = 1)
SELECT card_id, min(l) AS anchor FROM (SELECT p_partkey AS l, p_size * 100000 + floor(p_retailprice)::BIGINT AS entry_no FROM part) JOIN one USING (entry_no) GROUP BY 1""")
def card_anchor_links(spark, d):
    no = (F.col("p_size") * 100000 + F.floor("p_retailprice")).cast("long").alias("entry_no")
    part = table(spark, d, "part")
    return CD.anchor_links(part.select(F.col("p_partkey").alias("anchor"), no), part.select(F.col("p_partkey").alias("card_id"), no))


def _sup_cards(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("card_id"), F.col("s_name").alias("identity_text"), F.col("s_suppkey").alias("entry_no"), F.col("s_nationkey").alias("page"),
        F.when(F.col("s_acctbal") < 0, "weak record").when(F.col("s_acctbal") < 3000, "plain record").otherwise("trusted record").alias("full_text"))


def _sup_links(spark: SparkSession, d: str) -> DataFrame:
    """Even suppliers already have an anchor."""
    return table(spark, d, "supplier").filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("card_id"), (F.col("s_suppkey") + 1_000_000).alias("anchor"))


def _word_grade(c):
    return R.first_rule(c, (("weak", ("weak",)), ("thiqa", ("trusted",))), folded=False)


def _sup_resolutions(spark: SparkSession, d: str) -> DataFrame:
    prev, nxt = card_edges(spark, d)
    opened = open_lines(spark, d)
    found = RS.resolve_source_cards(opened, RS.source_card_candidates(opened, RS.plain_index(supplier_index(spark, d)), prev, nxt))
    return found.select("occurrence_id", F.col("entity").alias("card_id"), F.lit("source_card_context").alias("method"))


_RES = f"{_CARD}, res AS (SELECT c * 8 + q AS occurrence_id, cand AS card_id FROM rk WHERE rn = 1 AND ps + xs > 0 AND (run IS NULL OR score > run))"


@query("provisional_cards", f"""
WITH {LINES}, {_RES}
SELECT card_id, s_name AS identity_text, CASE WHEN s_acctbal < 0 THEN 'weak' WHEN s_acctbal >= 3000 THEN 'thiqa' END AS grade, count(*) AS occurrences
FROM res JOIN supplier ON s_suppkey = card_id WHERE card_id % 2 = 1 GROUP BY 1, 2, 3""")
def provisional_cards(spark, d):
    sup = table(spark, d, "supplier")
    texts = sup.select(F.col("s_suppkey").alias("card_id"), F.col("s_nationkey").alias("entry_id"), F.lit("").alias("teachers_raw"), F.lit("").alias("students_raw"))
    bodies = table(spark, d, "nation").select(F.col("n_nationkey").alias("entry_id"), F.col("n_name").alias("body"))
    rows = CD.provisional_cards(_sup_resolutions(spark, d), _sup_cards(spark, d), _sup_links(spark, d), texts, bodies, _word_grade)
    return rows.select("card_id", "identity_text", "grade", "occurrences")


@query("card_map", f"""
WITH {LINES}, {_RES}
SELECT occurrence_id, CASE WHEN card_id % 2 = 0 THEN 'existing_anchor' ELSE 'provisional_source_card' END AS card_type,
       CASE WHEN card_id % 2 = 0 THEN (card_id + 1000000)::VARCHAR ELSE 'P_' || substr(sha256(card_id::VARCHAR), 1, 20) END AS card_ref_id,
       CASE WHEN card_id % 2 = 0 THEN 'A ' || s_name ELSE s_name END AS display_name,
       CASE WHEN card_id % 2 = 0 THEN 'saduq' WHEN s_acctbal < 0 THEN 'weak' WHEN s_acctbal >= 3000 THEN 'thiqa' END AS grade, 'source_card_context' AS status
FROM res JOIN supplier ON s_suppkey = card_id""")
def card_map(spark, d):
    anchors = table(spark, d, "supplier").select((F.col("s_suppkey") + 1_000_000).alias("anchor"), F.concat(F.lit("A "), "s_name").alias("canonical_name"), F.lit("saduq").alias("grade"))
    return CD.card_map(_sup_resolutions(spark, d), _sup_links(spark, d), anchors, _sup_cards(spark, d), _word_grade)


@query("direct_seeds", f"""
WITH {LINES}, px AS (SELECT s_suppkey, 'S ' || n_name || ' ' || left(s_suppkey::VARCHAR, 1) || ' ' || s_suppkey AS nm FROM supplier JOIN nation ON s_nationkey = n_nationkey),
un AS (SELECT array_to_string(string_split(nm, ' ')[1:3], ' ') AS k, min(s_suppkey) AS ent FROM px GROUP BY 1 HAVING count(*) = 1)
SELECT l_orderkey AS chain_id, l_linenumber AS sequence_index, un.ent AS entity,
       CASE WHEN un.ent % 2 = 0 THEN 'existing_anchor' ELSE 'provisional_source_card' END AS card_type
FROM lineitem JOIN px ON px.s_suppkey = l_suppkey AND l_linestatus <> 'F' JOIN un ON k = array_to_string(string_split(px.nm, ' ')[1:3], ' ')""")
def direct_seeds(spark, d):
    """Unresolved names of three tokens that are a unique prefix over all cards need no neighbour; those of groups count too."""
    sup = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    cards = sup.select(F.col("s_suppkey").alias("supplier"), F.concat_ws(" ", F.lit("S"), "n_name", F.substring(F.col("s_suppkey").cast("string"), 1, 1), "s_suppkey").alias("full"))
    index = B.prefix_index(cards, "supplier", "full", 3, 8).select("key", "entity")
    names = cards.select("supplier", F.substring_index("full", " ", 3).alias("name"))
    free = line_nodes(spark, d).filter("entity IS NULL").join(names, "supplier").drop("entity").filter(F.size(K.tokens("name")) >= 3)
    seeds = RS.resolve_unique_names(free, index).join(_sup_links(spark, d).select(F.col("card_id").alias("entity"), "anchor"), "entity", "left")
    kind = F.when(F.col("anchor").isNotNull(), "existing_anchor").otherwise("provisional_source_card")
    return seeds.select("chain_id", "sequence_index", "entity", kind.alias("card_type"))


# -- evidence -----------------------------------------------------------------------------------


@query("best_dates", """
WITH e AS (SELECT user_id, event_id, CASE event_type WHEN 'click' THEN 'birth' WHEN 'error' THEN 'death' END AS ev, floor(value / 10)::INT AS y FROM events),
b AS (SELECT user_id, y FROM (SELECT user_id, y, count(*) AS n, min(event_id) AS f FROM e WHERE ev = 'birth' GROUP BY 1, 2)
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) = 1),
x AS (SELECT user_id, y FROM e WHERE ev = 'death' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT coalesce(b.user_id, x.user_id) AS entity, b.y AS birth_year, x.y AS death_year FROM b FULL JOIN x ON b.user_id = x.user_id""")
def best_dates(spark, d):
    e = table(spark, d, "events").filter(F.col("event_type").isin("click", "error")).select(
        F.col("user_id").alias("entity"), F.when(F.col("event_type") == "click", "birth").otherwise("death").alias("event"),
        F.floor(F.col("value") / 10).cast("int").alias("year"), F.col("event_id").alias("pos"))
    return EV.best_years(e)


@query("word_dates", r"""
WITH m AS (SELECT doc_id, 'birth' AS event, unnest(regexp_extract_all(text, '((?:with)[^,.]{0,120}?\sthe\s+([^,.\]\[]+))', 1)) AS w,
                  unnest(regexp_extract_all(text, '((?:with)[^,.]{0,120}?\sthe\s+([^,.\]\[]+))', 2)) AS p FROM documents
           UNION ALL SELECT doc_id, 'death', unnest(regexp_extract_all(text, '((?:for)[^,.]{0,120}?\sthe\s+([^,.\]\[]+))', 1)),
                  unnest(regexp_extract_all(text, '((?:for)[^,.]{0,120}?\sthe\s+([^,.\]\[]+))', 2)) FROM documents),
t AS (SELECT doc_id, event, w, list_filter(string_split_regex(trim(trim(regexp_replace(regexp_extract(trim(p), '(?s)^(.*?)(?:\s+(?:and)(?:[^\p{L}\p{M}\p{N}_]|$)|$)', 1), '\s+', ' ', 'g')), ' ،؛.'), '\s+'), lambda x: x <> '') AS t FROM m),
v AS (SELECT *, list_filter(list_transform(t, lambda x: CASE x WHEN 'of' THEN 1 WHEN 'is' THEN 20 WHEN 'that' THEN 300 END), lambda x: x IS NOT NULL) AS v FROM t),
y AS (SELECT doc_id, event, CASE WHEN len(v) > 0 AND len(v) >= greatest(1, len(t) - 1) THEN list_sum(v)::INT END AS year, w AS text FROM v)
SELECT doc_id, event, year, text, CASE WHEN year IS NULL THEN 0.55 ELSE 0.92 END::DOUBLE AS confidence, count(*) AS n FROM y GROUP BY 1, 2, 3, 4, 5""")
def word_dates(spark, d):
    dates = EV.word_dates("text", ("with",), ("for",), "the", ("and",), ",.",
                          lambda c: R.number_words(c, {"of": 1, "is": 20, "that": 300}, conjunction="", drop=()))
    rows = documents(spark, d).select("doc_id", F.explode(dates).alias("e"))
    return rows.groupBy("doc_id", "e.event", "e.year", "e.text", "e.confidence").agg(F.count(F.lit(1)).alias("n"))


@query("digit_dates", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'death' ELSE 'birth' END AS event, year(o_orderdate)::INT AS year, 0.94::DOUBLE AS confidence,
       o_orderstatus || ' on ' || o_orderpriority || ' year ' || year(o_orderdate) AS text FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def digit_dates(spark, d):
    text = F.concat(F.lit("order "), "o_orderstatus", F.lit(" on "), "o_orderpriority", F.lit(" year "), F.year("o_orderdate").cast("string"), F.lit(" end"))
    found = EV.digit_dates("note", (("death", ("F on",)), ("birth", ("O on",))), ("year",))
    rows = table(spark, d, "orders").select("o_orderkey", text.alias("note")).select("o_orderkey", F.explode(found).alias("e"))
    return rows.select("o_orderkey", "e.event", "e.year", "e.confidence", "e.text")


@query("traits_unpivot", """
SELECT doc_id, 'quality' AS trait FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1""")
def traits_unpivot(spark, d):
    return EV.trait_rows(table(spark, d, "labels"), "doc_id", ["quality", "toxic"])


_GRADES = (("rejected", ("tionth", "spam")), ("weak", ("with avec", "hathe")), ("saduq", ("Is ", "Des ")), ("thiqa", ("the", "les")))


@query("grade_rules", r"""
SELECT doc_id, CASE WHEN contains(text, 'tionth') OR contains(text, 'spam') THEN 'rejected' WHEN contains(text, 'with avec') OR contains(text, 'hathe') THEN 'weak'
   WHEN contains(text, 'Is ') OR contains(text, 'Des ') THEN 'saduq' WHEN contains(text, 'the') OR contains(text, 'les') THEN 'thiqa' ELSE 'other' END AS grade,
  CASE WHEN regexp_matches(text, '(^|[^\p{L}\p{M}\p{N}_])(or|ou)([^\p{L}\p{M}\p{N}_]|$)') THEN 'weak' WHEN regexp_matches(text, '(^|[^\p{L}\p{M}\p{N}_])(is|es)([^\p{L}\p{M}\p{N}_]|$)') THEN 'thiqa' END AS word_grade,
  (contains(text, 'hed') OR contains(text, 'eau'))::INT AS has_first, contains(text, 'tion')::INT AS has_second FROM documents""")
def grade_rules(spark, d):
    return documents(spark, d).select(
        "doc_id", R.first_rule("text", _GRADES, "other", folded=False).alias("grade"),
        R.first_rule("text", (("weak", ("or", "ou")), ("thiqa", ("is", "es"))), whole=True, folded=False).alias("word_grade"),
        *R.trait_flags("text", (("first", ("hed", "eau")), ("second", ("tion",)))))


@query("secondary_match", """
WITH e AS (SELECT p_type AS source, p_partkey AS entry_id, string_split(CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_name || ' ' || p_brand || ' ' || p_size END, ' ') AS t FROM part),
k AS (SELECT source, entry_id, l, len(t) AS size, array_to_string(t[1:l], ' ') AS key FROM (SELECT source, entry_id, t, unnest(range(2, least(7, len(t)) + 1)) AS l FROM e)),
a AS (SELECT p_partkey AS anchor, string_split(CASE WHEN p_size % 4 = 0 THEN p_name ELSE p_name || ' ' || p_brand END, ' ') AS t FROM part),
p AS (SELECT anchor, l, len(t) AS psize, array_to_string(t[1:l], ' ') AS key FROM (SELECT anchor, t, unnest(range(2, least(6, len(t)) + 1)) AS l FROM a)),
b AS (SELECT anchor, source, p.l, min(entry_id) AS entry_id, count(DISTINCT entry_id) AS n FROM p JOIN k USING (key) WHERE p.l >= 3 OR psize = p.l OR size = p.l
      GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY anchor, source ORDER BY p.l DESC) = 1)
SELECT anchor, source, entry_id, l::INT AS matched_len FROM b WHERE n = 1""")
def secondary_match(spark, d):
    return EV.match_secondary(*_secondary(spark, d))


def _secondary(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, d, "part")
    heading = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(F.concat_ws(" ", "p_name", "p_brand", "p_size"))
    entries = part.select(F.col("p_type").alias("source"), F.col("p_partkey").alias("entry_id"), heading.alias("heading_norm"))
    name = F.when(F.col("p_size") % 4 == 0, F.col("p_name")).otherwise(F.concat_ws(" ", "p_name", "p_brand"))
    return part.select(F.col("p_partkey").alias("anchor"), name.alias("name_norm")), entries


#: Arabic summaries with the grade, the class and the two traits they tell, chosen by the supplier number.
_SUMMARIES = (
    ("ثِقَةٌ ثبت", "thiqa", 0, 0), ("صدوق مدلس", "saduq", 1, 0), ("ضعيف جداً", "very_weak", 0, 0), ("لين الحديث", "weak", 0, 0),
    ("مجهول الحال", "unknown", 0, 0), ("متروك", "rejected", 0, 0), ("صدوق اختلط", "saduq", 0, 1), ("مقبول", "acceptable", 0, 0),
)
_CLASSES = ("الأولى", "الثانية", "الثالثة", "الرابعة", "الخامسة", "السادسة", "السابعة", "الثامنة", "التاسعة", "العاشرة", "الحادية عشرة", "الثانية عشرة")


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


@query("structured_cards", f"""
WITH g(i, grade, tadlis, ikhtilat) AS ({_values((i, *r[1:]) for i, r in enumerate(_SUMMARIES))}),
s AS (SELECT s_suppkey AS card, s_suppkey % 9 AS i, s_suppkey % 13 AS k FROM supplier),
y AS (SELECT l_suppkey, min(year(l_shipdate)) AS b, max(year(l_shipdate)) AS d FROM lineitem GROUP BY 1)
SELECT card, grade, CASE WHEN s.i < 8 AND k < 12 THEN k + 1 END::INT AS tabaqa, coalesce(tadlis, 0)::INT AS has_tadlis, coalesce(ikhtilat, 0)::INT AS has_ikhtilat,
       0 AS has_late_memory_change, 0 AS has_poor_memory, b::INT AS birth_year, d::INT AS death_year,
       CASE WHEN s.i < 8 THEN 'structured_summary' ELSE 'no_summary' END AS structured_status
FROM s LEFT JOIN g ON g.i = s.i LEFT JOIN y ON l_suppkey = card""")
def structured_cards(spark, d):
    """C-03 as a whole: grade, class, traits and years of summaries built from the supplier number; lines date the cards."""
    k = F.col("s_suppkey")
    grade = F.get(F.array(*[F.lit(r[0]) for r in _SUMMARIES]), (k % 9).cast("int"))
    group = F.get(F.array(*[F.lit(w) for w in _CLASSES]), (k % 13).cast("int"))
    summary = F.concat_ws(" ", grade, F.concat(F.lit("من "), group))
    cards = table(spark, d, "supplier").select(k.alias("card"), F.when(grade.isNotNull(), summary).otherwise("").alias("summary"))
    return EV.structured_cards(cards, "card", "summary", supplier_years(spark, d)).drop("summary")


#: Verdicts and their class under the rules for statements, secondary sources and source cards.
_VERDICTS = (
    ("هو ثِقَة", "thiqa", "thiqa", "thiqa"), ("ليس بثقة", "weak", "thiqa", "thiqa"), ("كذَّاب", "rejected", "rejected", "rejected"),
    ("فيه نظر", "other", "weak", "weak"), ("لا بأس به", "acceptable", "acceptable", None), ("صالح الحديث", "acceptable", "acceptable", None),
    ("حافظ إمام", "praise", "other", None), ("له رواية", "other", "other", None), ("واهي الحديث", "weak", "very_weak", "very_weak"),
    ("صحابي", "other", "other", "companion"), ("مقبول", "other", "other", "acceptable"), ("لا يحتج به", "weak", "weak", None),
    ("مجهول ضعيف", "weak", "weak", "weak"),
)


@query("verdict_rules", f"""
WITH v(i, statement, secondary, card) AS ({_values((i, *("" if x is None else x for x in r[1:])) for i, r in enumerate(_VERDICTS))})
SELECT p_partkey, statement, secondary, nullif(card, '') AS card FROM part JOIN v ON i = p_partkey % {len(_VERDICTS)}""")
def verdict_rules(spark, d):
    """Vocalised and plain verdicts before the name of a part, under three rule lists."""
    said = F.get(F.array(*[F.lit(r[0]) for r in _VERDICTS]), (F.col("p_partkey") % len(_VERDICTS)).cast("int"))
    text = F.concat_ws(" ", said, "p_name")
    return table(spark, d, "part").select(
        "p_partkey", R.statement_judgment(text).alias("statement"), R.secondary_grade(text).alias("secondary"), R.source_card_grade(text).alias("card"))


@query("secondary_evidence", r"""
WITH n AS (SELECT doc_id, source, text, trim(regexp_replace(translate(text, '[]«»()', '      '), '\s+', ' ', 'g'), ' ،؛;:.-') AS nt FROM documents),
g AS (SELECT doc_id, source, CASE WHEN starts_with(source, 'src1') AND (contains(nt, 'hed') OR contains(nt, 'eau')) THEN 'one' WHEN starts_with(source, 'src2') AND contains(nt, 'tion') THEN 'two' END AS critic,
   text AS exact FROM n)
SELECT doc_id, source, critic, CASE critic WHEN 'one' THEN 0.86 ELSE 0.90 END::DOUBLE AS confidence, sha256(exact) AS exact_sha, 'other' AS judgment FROM g WHERE critic IS NOT NULL""")
def secondary_evidence(spark, d):
    docs = documents(spark, d).select("doc_id", "source", F.col("text").alias("body"))
    rows = EV.source_grades(docs, "source", "body", {"src1": (("hed", "eau"), None, "one", 0.86), "src2": (("tion",), None, "two", 0.90)})
    return rows.select("doc_id", "source", "critic", "confidence", F.sha2("exact_text", 256).alias("exact_sha"), "judgment")


@query("terminal_repair", r"""
WITH s AS (SELECT doc_id, unnest(string_split(text, '.')) AS raw, generate_subscripts(string_split(text, '.'), 1) AS k FROM documents),
n AS (SELECT doc_id, k, trim(regexp_replace(raw, '\s+', ' ', 'g'), ' ،؛;:.-') AS n FROM s),
f AS (SELECT * FROM n),
p AS (SELECT *, CASE WHEN regexp_matches(n, '\s+(?:of|the)\s+that([^\p{L}\p{M}\p{N}_]|$)') THEN trim(regexp_extract(n, '^(.*?)\s+(?:of|the)\s+that(?:[^\p{L}\p{M}\p{N}_]|$)', 1), ' ،؛:.-') END AS pre FROM f),
c AS (SELECT *, CASE WHEN starts_with(n, 'that') THEN 'pure_prophet' WHEN pre IS NOT NULL AND pre <> '' THEN 'narrator_plus_prophet' WHEN pre IS NOT NULL THEN 'pure_prophet'
      WHEN contains(n, 'that') THEN 'narrator_descriptor_only' ELSE 'other' END AS kind FROM p)
SELECT doc_id, k::INT AS sentence_no, kind AS repair_kind, CASE kind WHEN 'pure_prophet' THEN '' WHEN 'narrator_plus_prophet' THEN pre ELSE n END AS hidden_name,
       (kind IN ('pure_prophet', 'narrator_plus_prophet'))::INT AS needs_terminal FROM c""")
def terminal_repair(spark, d):
    return prose_repairs(spark, d).select("doc_id", "sentence_no", "repair_kind", "hidden_name", "needs_terminal")


def prose_repairs(spark: SparkSession, d: str) -> DataFrame:
    rows = documents(spark, d).select("doc_id", F.posexplode(F.split("text", r"\.")).alias("i", "raw"))
    rows = rows.select("doc_id", (F.col("i") + 1).alias("sentence_no"), "raw")
    return E.repair_terminals(rows, "raw", ("that",), (r"\s+(?:of|the)\s+SUBJECT",))


# -- link analysis -------------------------------------------------------------------------------

_GRADE_SQL = "CASE WHEN s_suppkey % 11 = 0 THEN 'weak' WHEN s_suppkey % 13 = 0 THEN 'unknown' ELSE 'thiqa' END"


def supplier_cards(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    s = table(spark, d, "supplier").select(
        k.alias("entity"), F.when(k % 11 == 0, "weak").when(k % 13 == 0, "unknown").otherwise("thiqa").alias("grade"), (k % 12 + 1).alias("tabaqa"),
        (k % 3 == 0).cast("int").alias("has_tadlis"))
    return s.join(supplier_spans(spark, d), "entity")


def line_links(spark: SparkSession, d: str) -> DataFrame:
    occ = line_nodes(spark, d).withColumn("term", F.col("flag"))
    return AN.analyze_links(occ, reported_pairs(spark, d), C.resolved_pairs(occ), supplier_cards(spark, d), plain_terms=(0,))


def reported_pairs(spark: SparkSession, d: str) -> DataFrame:
    return reconcile(pair_evidence(spark, d))


_LINKS = f"""
{_BILATERAL}, {_SPAN},
cd AS (SELECT s_suppkey AS e, {_GRADE_SQL} AS grade, s_suppkey % 12 + 1 AS tab, (s_suppkey % 3 = 0)::INT AS tad, b, d FROM supplier JOIN yr ON yr.e = s_suppkey),
obs AS (SELECT e1 AS student, e2 AS teacher, count(*) AS n FROM adj WHERE e1 IS NOT NULL AND e2 IS NOT NULL GROUP BY 1, 2),
lk AS (SELECT a.c, a.q1, a.e1 AS student, a.e2 AS teacher, bil2.status AS rep, obs.n AS observed, s.grade AS sg, t.grade AS tg,
   CASE WHEN s.b > t.d THEN 'conflict_student_born_after_teacher_death' WHEN s.tab + 1 < t.tab THEN 'possible_generation_reversal' ELSE 'compatible_no_obvious_conflict' END AS chron,
   (s.tad = 1 AND a.rf2 = 'N')::INT AS tad
   FROM adj a JOIN cd s ON s.e = a.e1 JOIN cd t ON t.e = a.e2 JOIN obs ON obs.student = a.e1 AND obs.teacher = a.e2
   LEFT JOIN bil2 ON bil2.student = a.e1 AND bil2.teacher = a.e2 WHERE a.e1 IS NOT NULL AND a.e2 IS NOT NULL),
links AS (SELECT *, CASE WHEN chron LIKE 'conflict%' THEN 'chronology_conflict' WHEN rep IS NOT NULL AND tad = 0 THEN 'supported_reported_and_observed'
   WHEN rep IS NOT NULL THEN 'reported_but_tadlis_review' WHEN observed >= 2 AND tad = 0 THEN 'observed_repeated_needs_reported_source'
   WHEN tad = 1 THEN 'tadlis_review' ELSE 'observed_only_needs_review' END AS status,
   coalesce(nullif(concat_ws(';', CASE WHEN sg <> 'thiqa' THEN 'student:' || sg END, CASE WHEN tg <> 'thiqa' THEN 'teacher:' || tg END), ''), 'none') AS weak FROM lk)"""


@query("edge_analysis", f"""
WITH {LINES}, {_LINKS} SELECT c AS chain_id, q1 AS from_sequence, student, teacher, rep AS reported_status, observed AS observed_count, chron AS chronology_status,
       tad AS tadlis_warning, weak AS weakness, status AS continuity_status FROM links""")
def edge_analysis(spark, d):
    return line_links(spark, d).select("chain_id", "from_sequence", "student", "teacher", "reported_status", "observed_count", "chronology_status",
                                       "tadlis_warning", "weakness", "continuity_status")


@query("branch_summary", f"""
WITH {LINES}, {_LINKS},
g AS (SELECT l_orderkey AS c, count(*) AS total, sum((l_linestatus = 'F')::INT)::BIGINT AS res, count(DISTINCT l_linenumber) - 1 AS tl FROM lineitem GROUP BY 1),
k AS (SELECT c, count(*) AS rl, count(*) FILTER (WHERE status = 'supported_reported_and_observed') AS sl FROM links GROUP BY 1)
SELECT g.c AS chain_id, total AS total_occurrences, res AS resolved_occurrences, tl AS total_links, coalesce(rl, 0) AS resolved_links, coalesce(sl, 0) AS supported_links,
       coalesce(rl, 0) - coalesce(sl, 0) AS warning_links, tl - coalesce(rl, 0) AS unresolved_links, (total = res)::INT AS complete_identity_resolution
FROM g LEFT JOIN k ON g.c = k.c""")
def branch_summary(spark, d):
    return AN.branch_summary(line_nodes(spark, d), line_links(spark, d)).drop("branch_hint")


@query("warning_counts", f"""
WITH {LINES}, {_LINKS} SELECT count(*) AS links, count(*) FILTER (WHERE weak <> 'none') AS weak_or_unknown_links, count(*) FILTER (WHERE tad = 1) AS tadlis_links,
       count(*) FILTER (WHERE chron LIKE 'conflict%') AS conflict_links FROM links""")
def warning_counts(spark, d):
    return AN.warning_counts(line_links(spark, d))


def _ref(entity):
    return F.when(entity.isNotNull(), F.concat(F.when(entity % 2 == 0, "A:").otherwise("P:"), entity.cast("string")))


@query("card_links_graph", f"""
WITH {LINES}, {_BILATERAL} SELECT c AS chain_id, q1 AS from_sequence, (CASE WHEN e1 % 2 = 0 THEN 'A:' ELSE 'P:' END) || e1 AS student,
  (CASE WHEN e2 % 2 = 0 THEN 'A:' ELSE 'P:' END) || e2 AS teacher,
  CASE WHEN e1 % 2 = 0 AND e2 % 2 = 0 AND EXISTS (SELECT 1 FROM rel WHERE st = e1 AND te = e2) THEN 'existing_anchor_graph'
       WHEN te = 1 AND se = 1 THEN 'bilateral_source_lists' WHEN te + se = 1 THEN 'one_source_direction' ELSE 'needs_relationship_evidence' END AS relationship_support
FROM adj LEFT JOIN bil ON bil.student = e1 AND bil.teacher = e2 WHERE e1 IS NOT NULL AND e2 IS NOT NULL""")
def card_links_graph(spark, d):
    occ = line_nodes(spark, d).withColumn("card_ref", _ref(F.col("entity"))).withColumn("term", F.col("flag"))
    graph = flagged_pairs(spark, d, 2).filter("student % 2 = 0 AND teacher % 2 = 0").select(_ref(F.col("student")).alias("student"), _ref(F.col("teacher")).alias("teacher"))
    listed = pair_evidence(spark, d).select(_ref(F.col("student")).alias("student"), _ref(F.col("teacher")).alias("teacher"), "direction")
    return AN.card_edges(occ, graph, listed).select("chain_id", "from_sequence", "student", "teacher", "relationship_support")


# -- reports -------------------------------------------------------------------------------------


@query("resolution_progress", """
WITH n AS (SELECT CASE WHEN l_linestatus <> 'F' THEN 'unresolved' WHEN l_suppkey % 2 = 0 THEN 'existing_anchor' ELSE 'provisional_source_card' END AS card_type,
           CASE WHEN l_linestatus = 'F' THEN l_suppkey END AS k FROM lineitem)
SELECT card_type, count(*) AS occurrences, count(DISTINCT k) AS distinct_cards FROM n GROUP BY 1""")
def resolution_progress(spark, d):
    kind = F.when(F.col("entity").isNotNull(), F.when(F.col("entity") % 2 == 0, "existing_anchor").otherwise("provisional_source_card"))
    return AN.resolution_progress(line_nodes(spark, d).withColumn("card_type", kind), "card_type", "entity")


@query("unresolved_queue", """
SELECT s_nationkey AS name, count(*) AS occurrences FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_linestatus <> 'F' GROUP BY 1""")
def unresolved_queue(spark, d):
    return AN.unresolved_queue(named_line_nodes(spark, d))


@query("relation_coverage", f"""
WITH {LINES}, {_BILATERAL}, o AS (SELECT DISTINCT e1 AS student, e2 AS teacher FROM adj WHERE e1 IS NOT NULL AND e2 IS NOT NULL)
SELECT count(*) AS pairs, count(status) AS reported, count(*) FILTER (WHERE status = 'bilateral_reported') AS bilateral FROM o LEFT JOIN bil2 USING (student, teacher)""")
def relation_coverage(spark, d):
    return AU.relation_coverage(C.resolved_pairs(line_nodes(spark, d)), reported_pairs(spark, d))


@query("label_coverage", rf"""
WITH o AS (SELECT {plain("raw")} AS name FROM (SELECT unnest(string_split(text, ',')) AS raw FROM documents)),
l AS (SELECT DISTINCT {plain("raw")} AS name FROM (SELECT unnest(string_split(text, ',')) AS raw FROM benchmark))
SELECT count(*) AS occurrences, count(*) FILTER (WHERE name IN (SELECT name FROM l)) AS covered FROM o""")
def label_coverage(spark, d):
    """Clauses of the documents that are also clauses of the benchmark passages."""
    clauses = F.explode(F.split("text", ",")).alias("raw")
    occ = documents(spark, d).select(clauses).select(T.normalize("raw").alias("name"))
    known = table(spark, d, "benchmark").select(clauses).select(T.normalize("raw").alias("name"))
    return AU.label_coverage(occ, "name", known, "name")


@query("source_coverage", """
WITH e AS (SELECT p_type AS source, p_partkey AS entry_id, string_split(CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_name || ' ' || p_brand || ' ' || p_size END, ' ') AS t FROM part),
k AS (SELECT source, entry_id, l, len(t) AS size, array_to_string(t[1:l], ' ') AS key FROM (SELECT source, entry_id, t, unnest(range(2, least(7, len(t)) + 1)) AS l FROM e)),
a AS (SELECT p_partkey AS anchor, string_split(CASE WHEN p_size % 4 = 0 THEN p_name ELSE p_name || ' ' || p_brand END, ' ') AS t FROM part),
p AS (SELECT anchor, l, len(t) AS psize, array_to_string(t[1:l], ' ') AS key FROM (SELECT anchor, t, unnest(range(2, least(6, len(t)) + 1)) AS l FROM a)),
b AS (SELECT anchor, source, p.l, count(DISTINCT entry_id) AS n FROM p JOIN k USING (key) WHERE p.l >= 3 OR psize = p.l OR size = p.l
      GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY anchor, source ORDER BY p.l DESC) = 1)
SELECT source, count(DISTINCT anchor) AS cards FROM b WHERE n = 1 GROUP BY 1""")
def source_coverage(spark, d):
    return EV.coverage(EV.match_secondary(*_secondary(spark, d)), "source", "anchor")


@query("extraction_report", rf"""
WITH t AS (SELECT doc_id, source, regexp_replace(text, '^ +', '') AS t FROM documents),
k AS (SELECT doc_id, source, CASE WHEN regexp_matches(t, '^(Is|Des)') THEN 'title' WHEN regexp_matches(substr(t, 1, 300), '(with|avec|mit|con)') THEN 'hadith'
  WHEN regexp_matches(t, '^(The|La)\s+') AND length(t) > 80 THEN 'report' WHEN regexp_matches(substr(t, 1, 500), '(that|pour)') AND length(t) > 80 THEN 'report' ELSE 'other' END AS kind FROM t),
found AS (SELECT doc_id FROM ({ORACLES["boundary_extract"]}))
SELECT source AS book, count(*) AS records, count(*) FILTER (WHERE kind = 'hadith') AS hadith, count(*) FILTER (WHERE kind = 'report') AS report,
       count(*) FILTER (WHERE kind = 'other') AS other, count(*) FILTER (WHERE kind IN ('hadith', 'report') AND doc_id IN (SELECT doc_id FROM found)) AS chains
FROM k WHERE kind <> 'title' GROUP BY 1""")
def extraction_report(spark, d):
    records = E.typed_records(documents(spark, d).select(F.col("source").alias("book"), "text"), "text", PROSE)
    chains = E.extract_chains(records.filter(F.col("record_type").isin("hadith", "report")), "text", PROSE)
    return AU.extraction_report(records, chains, "book", "record_type", ["hadith", "report", "other"])


@query("boundary_report", f"""
SELECT boundary_method, count(*) AS chains, sum(needs_extension_review)::BIGINT AS extension_review, sum(needs_review)::BIGINT AS flagged
FROM ({ORACLES["boundary_extract"]}) GROUP BY 1""")
def boundary_report(spark, d):
    return AU.boundary_report(E.extract_chains(documents(spark, d).select("doc_id", "text"), "text", PROSE))


@query("grade_report", f"""
WITH g AS ({ORACLES["grade_rules"]})
SELECT grade, count(*) AS cards, sum(has_first)::BIGINT AS has_first, sum(has_second)::BIGINT AS has_second FROM g GROUP BY 1""")
def grade_report(spark, d):
    return AU.flag_report(grade_rules(spark, d), "grade", ["has_first", "has_second"])


@query("evidence_documents", f"""
WITH {LINES}, {_LINKS} SELECT DISTINCT student, teacher, '{{' || CASE WHEN rep IS NOT NULL THEN '"reported_status":"' || rep || '",' ELSE '' END || '"observed_count":' || observed
  || ',"student_grade":"' || sg || '","teacher_grade":"' || tg || '","student_tabaqa":' || a.tab || ',"teacher_tabaqa":' || b.tab || ',"student_birth_year":' || a.b || ',"teacher_birth_year":' || b.b
  || ',"student_death_year":' || a.d || ',"teacher_death_year":' || b.d || '}}' AS evidence_json
FROM links JOIN cd a ON a.e = student JOIN cd b ON b.e = teacher""")
def evidence_documents(spark, d):
    return line_links(spark, d).select("student", "teacher", AN.evidence_json().alias("evidence_json")).distinct()


@query("status_report", f"""
WITH {LINES}, {_LINKS}
SELECT 'links' AS layer, status, count(*) AS n FROM links GROUP BY 2
UNION ALL SELECT 'relations', status, count(*) FROM bil2 GROUP BY 2""")
def status_report(spark, d):
    return AU.status_counts(line_links(spark, d), "continuity_status", "links").unionByName(AU.status_counts(reported_pairs(spark, d), "status", "relations"))


@query("layer_distincts", r"""
WITH s AS (SELECT unnest(string_split(text, ',')) AS raw FROM documents),
n AS (SELECT trim(regexp_replace(raw, '\s+', ' ', 'g'), ' ،؛;:.()-') AS name FROM s)
SELECT count(*) AS mentions, count(DISTINCT name) AS distinct_names FROM n WHERE name <> ''""")
def layer_distincts(spark, d):
    names = documents(spark, d).select(F.explode(F.split("text", ",")).alias("raw")).select(T.normalize("raw").alias("name")).filter("name <> ''")
    return names.groupBy("name").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("mentions"), F.count(F.lit(1)).alias("distinct_names"))


@query("run_audit", """
SELECT 'v1' AS version, (SELECT count(*) FROM documents) AS files_count, (SELECT count(*) FROM pages) AS pages_count, (SELECT count(*) FROM labels WHERE toxic = 5) AS empty_count""")
def run_audit_row(spark, d):
    return run_audit("v1", files=table(spark, d, "documents"), pages=table(spark, d, "pages"), empty=table(spark, d, "labels").filter("toxic = 5"))


@query("integrity_audit", f"""
WITH {LINES}, {_LINKS},
g AS (SELECT l_orderkey AS c, count(DISTINCT l_linenumber) - 1 AS tl FROM lineitem GROUP BY 1), k AS (SELECT c, count(*) AS rl FROM links GROUP BY 1)
SELECT 'pk_orders' AS "check", (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'unique_position', (SELECT count(*) FROM pos WHERE n > 1)
UNION ALL SELECT 'fk_orders_customer', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'fk_lineitem_labels', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT doc_id FROM labels))
UNION ALL SELECT 'not_null_text', (SELECT count(*) FROM documents WHERE text IS NULL)
UNION ALL SELECT 'lang_list', (SELECT count(*) FROM documents WHERE lang NOT IN ('en', 'fr'))
UNION ALL SELECT 'links_sum', (SELECT count(*) FROM g LEFT JOIN k ON g.c = k.c WHERE tl < coalesce(rl, 0))""")
def integrity_audit(spark, d):
    orders, docs = table(spark, d, "orders"), table(spark, d, "documents")
    lines = table(spark, d, "lineitem")
    parts = [
        AU.duplicate_keys(orders, ["o_orderkey"], "pk_orders"),
        AU.duplicate_keys(lines, ["l_orderkey", "l_linenumber"], "unique_position"),
        AU.orphans(orders, table(spark, d, "customer"), "o_custkey", "c_custkey", "fk_orders_customer"),
        AU.orphans(lines.select("l_orderkey"), table(spark, d, "labels"), "l_orderkey", "doc_id", "fk_lineitem_labels"),
        AU.violations(docs, not_null_text=F.col("text").isNotNull(), lang_list=F.col("lang").isin("en", "fr")),
        AU.conservation(AN.branch_summary(line_nodes(spark, d), line_links(spark, d)), "total_links",
                        ["supported_links", "warning_links", "unresolved_links"], "links_sum"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- reader mart -----------------------------------------------------------------------------------


@query("mart_nodes", f"""
WITH {LINES}, {_LAYERS} SELECT id AS occurrence_id, c AS chain_id, q AS sequence_index,
  CASE WHEN entity IS NOT NULL THEN (CASE WHEN entity % 2 = 0 THEN 'A:' ELSE 'P:' END) || entity END AS card_ref, coalesce(layer, 'unresolved') AS resolution_status
FROM atoms LEFT JOIN won ON occurrence_id = id""")
def mart_nodes(spark, d):
    """Every occurrence, those of group positions too."""
    won = RS.precedence_union(layers(spark, d))
    cards = won.select("occurrence_id", F.when(F.col("entity") % 2 == 0, "existing_anchor").otherwise("provisional_source_card").alias("card_type"),
                       F.col("entity").cast("string").alias("card_id"), F.col("layer").alias("status"))
    return M.mart_nodes(line_atoms(spark, d).select("occurrence_id", "chain_id", "sequence_index"), cards)


@query("mart_cards", f"""
SELECT (CASE WHEN s_suppkey % 2 = 0 THEN 'A:' ELSE 'P:' END) || s_suppkey AS card_ref, CASE WHEN s_suppkey % 2 = 0 THEN 'existing_anchor' ELSE 'provisional_source_card' END AS card_type,
       s_name AS display_name, {_GRADE_SQL} AS grade, (s_suppkey % 12 + 1)::BIGINT AS tabaqa, CASE WHEN s_suppkey % 2 = 0 THEN 100 + s_suppkey % 7 END AS birth_year, 104 + s_suppkey % 5 AS death_year FROM supplier""")
def mart_cards(spark, d):
    rows = supplier_cards(spark, d).join(table(spark, d, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("display_name")), "entity")
    rows = rows.select(F.col("entity").cast("string").alias("card_id"), (F.col("entity") % 2).alias("odd"), "display_name", "grade", "tabaqa", "birth_year", "death_year")
    both = M.mart_cards(rows.filter("odd = 0").drop("odd"), rows.filter("odd = 1").drop("odd", "birth_year"))
    return both.drop("card_id")


@query("mart_chains", """
SELECT o_orderkey AS chain_id, c_custkey AS source_file_id, c_name AS book, n AS record_lines
FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def mart_chains(spark, d):
    chains = table(spark, d, "orders").select(F.col("o_orderkey").alias("chain_id"), F.col("o_orderkey").alias("record_id"), F.col("o_custkey").alias("source_file_id"))
    files = table(spark, d, "customer").select(F.col("c_custkey").alias("source_file_id"), F.col("c_name").alias("book"))
    records = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("record_id")).agg(F.count(F.lit(1)).alias("record_lines"))
    return M.mart_chains(chains, files, records).drop("record_id")


@query("mart_statements", r"""
WITH s AS (SELECT conv_id, turn, conv_id::VARCHAR || '-' || turn AS id, text FROM conversations)
SELECT 'S2:' || id AS statement_ref, 'A:' || conv_id AS card_ref, sha256(text) AS text_sha FROM s WHERE turn % 2 = 0
UNION ALL SELECT 'S4:' || id, 'A:' || conv_id, sha256(text) FROM s WHERE turn % 2 = 1
UNION ALL SELECT 'S4:' || id, 'A:' || conv_id, sha256(text) FROM s WHERE turn % 2 = 0""")
def mart_statements(spark, d):
    rows = table(spark, d, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("statement_id"), F.col("conv_id").cast("string").alias("anchor"), F.sha2("text", 256).alias("text_sha"), "turn")
    return M.mart_statements(rows.filter("turn % 2 = 0").drop("turn"), rows.unionByName(rows.filter("turn % 2 = 1")).drop("turn"))


_REPAIRS = r"""
s AS (SELECT doc_id, unnest(string_split(text, '.')) AS raw, generate_subscripts(string_split(text, '.'), 1) AS k FROM documents),
n AS (SELECT doc_id, k, trim(regexp_replace(raw, '\s+', ' ', 'g'), ' ،؛;:.-') AS n FROM s),
p AS (SELECT *, CASE WHEN regexp_matches(n, '\s+(?:of|the)\s+that([^\p{L}\p{M}\p{N}_]|$)') THEN trim(regexp_extract(n, '^(.*?)\s+(?:of|the)\s+that(?:[^\p{L}\p{M}\p{N}_]|$)', 1), ' ،؛:.-') END AS pre FROM n),
c AS (SELECT *, CASE WHEN starts_with(n, 'that') THEN 'pure_prophet' WHEN pre IS NOT NULL AND pre <> '' THEN 'narrator_plus_prophet' WHEN pre IS NOT NULL THEN 'pure_prophet'
      WHEN contains(n, 'that') THEN 'narrator_descriptor_only' ELSE 'other' END AS kind FROM p),
rp AS (SELECT doc_id || '-' || k AS occurrence_id, kind AS repair_kind, CASE kind WHEN 'pure_prophet' THEN '' WHEN 'narrator_plus_prophet' THEN pre ELSE n END AS hidden FROM c),
hn AS (SELECT hidden, min(occurrence_id) AS card FROM rp WHERE hidden <> '' GROUP BY 1 HAVING count(*) = 1)"""


@query("mart_repairs", rf"""
WITH {_REPAIRS} SELECT rp.occurrence_id, repair_kind, CASE WHEN repair_kind = 'narrator_plus_prophet' AND card IS NOT NULL THEN 'P:' || card END AS hidden_card_ref
FROM rp LEFT JOIN hn ON hn.hidden = rp.hidden""")
def mart_repairs(spark, d):
    """Hidden names resolve to the card of the only text that carries them."""
    rep = prose_repairs(spark, d).select(F.concat_ws("-", "doc_id", "sentence_no").alias("occurrence_id"), "repair_kind", "hidden_name")
    index = rep.filter("hidden_name <> ''").select(F.col("hidden_name").alias("key"), F.col("occurrence_id").alias("entity"))
    open_names = rep.filter("repair_kind = 'narrator_plus_prophet'").select("occurrence_id", F.col("hidden_name").alias("name"))
    hidden = RS.resolve_unique_names(open_names, index).select(
        "occurrence_id", F.lit("provisional_source_card").alias("card_type"), F.col("entity").alias("card_id"), F.lit("unique name").alias("evidence"))
    return M.mart_repairs(rep.drop("hidden_name"), hidden).drop("evidence")


@query("hidden_terminals", f"""
WITH {LINES}, ht AS (SELECT * FROM hood WHERE rf = 'R' AND prev IS NOT NULL),
sc AS (SELECT c, q, s_suppkey AS cand, EXISTS (SELECT 1 FROM rel_a WHERE te = s_suppkey AND st = prev) AS ps FROM ht JOIN supplier ON s_nationkey = nm)
SELECT c AS chain_id, q AS sequence_index, min(cand) AS entity, 5 AS score FROM sc WHERE ps GROUP BY 1, 2 HAVING count(*) = 1""")
def hidden_terminals(spark, d):
    """Terminal nodes (R lines) with a hidden name: the card rule with the previous node alone."""
    prev, nxt = card_edges(spark, d)
    met = C.guarded_neighbours(named_line_nodes(spark, d), ["occurrence_id", "name", "entity", "flag"]).filter("flag = 2 AND prev_entity IS NOT NULL")
    opened = met.select(*C.POSITION, "occurrence_id", "name", F.col("prev_entity").alias("prev"), F.lit(None).cast("long").alias("next"))
    found = RS.resolve_source_cards(opened, RS.source_card_candidates(opened, RS.plain_index(supplier_index(spark, d)), prev, nxt))
    return found.select("chain_id", "sequence_index", "entity", "score")


@query("insert_absent", """
SELECT doc_id, quality, toxic FROM labels UNION ALL SELECT doc_id, 9, 9 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def insert_absent_rows(spark, d):
    new = table(spark, d, "documents").select("doc_id", F.lit(9).alias("quality"), F.lit(9).alias("toxic"))
    return insert_absent(table(spark, d, "labels"), new.unionByName(new), ["doc_id"], [F.col("quality")])
