"""Queries over the texts: inventory, normalisation, keys, extraction."""

from __future__ import annotations

from dataclasses import replace

from html.entities import name2codepoint

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silsila import lexicon as lx
from silsila.functions import keys as K
from silsila.functions import rules as R
from silsila.functions import text as T
from silsila.operators import blocking as B
from silsila.operators import evidence as EV
from silsila.operators import extract as E
from silsila.operators import kinship as KIN
from silsila.plans.bindings import PROSE, documents, spread, table
from silsila.plans.registry import query
from silsila.plans.session import shared_path
from silsila.sources import manifest as MF
from silsila.sources import pages as PG
from silsila.sources import tables as TB
from silsila.sources.search import phrase_pages
from silsila.sources.seeds import seed_entities

SQL_PLAIN = r"trim(regexp_replace({c}, '\s+', ' ', 'g'), ' ،؛;:.()-')"
SQL_HEAD = r"trim(regexp_replace(translate({c}, '[]«»()ـ', '       '), '\s+', ' ', 'g'), ' ،؛;:.-')"


def plain(c: str) -> str:
    return SQL_PLAIN.format(c=c)


@query("manifest_inventory", "SELECT doc_id AS path, strlen(text)::BIGINT AS size_bytes, sha256(text) AS sha256 FROM documents")
def manifest_inventory(spark: SparkSession, d: str) -> DataFrame:
    return MF.inventory(table(spark, d, "documents"), "doc_id", "text").drop("content")


def _manifest(d_name: str) -> str:
    return f"""SELECT doc_id, concat_ws('/', source, lang, doc_id::VARCHAR) || ', "' || lang || '"' AS {d_name}, strlen(text)::BIGINT AS size_bytes,
                      sha256(text) AS sha256, '' AS duplicate_of FROM documents"""


@query("manifest_export", f"""
WITH m AS ({_manifest("name")})
SELECT k.kind, m.* FROM m, (VALUES ('csv'), ('json')) k(kind)""")
def manifest_export(spark, d):
    """The manifest written as CSV and JSON and read again, names with commas and quotes among them."""
    rows = MF.inventory(table(spark, d, "documents"), "doc_id", "text").drop("content").withColumnRenamed("path", "doc_id")
    named = rows.join(table(spark, d, "documents").select("doc_id", F.concat(
        F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")), F.lit(', "'), "lang", F.lit('"')).alias("name")), "doc_id")
    path = shared_path(spark, "manifest")
    MF.write_manifest(named.select("doc_id", "name", "size_bytes", "sha256", F.lit("").alias("duplicate_of")), path)
    schema = "doc_id bigint, name string, size_bytes bigint, sha256 string, duplicate_of string"
    back = [MF.read_manifest(spark, path, schema, kind).select(F.lit(kind).alias("kind"), "*") for kind in ("csv", "json")]
    return back[0].unionByName(back[1])


@query("table_refresh", """
SELECT lang, source, doc_id, n_chars, length(text)::INT AS length FROM documents WHERE lang IS NOT NULL""")
def table_refresh(spark, d):
    """A table rebuilt twice by language: the second build replaces the first one whole."""
    docs = table(spark, d, "documents").filter("lang IS NOT NULL")
    rows = docs.select("doc_id", "source", "n_chars", F.length("text").alias("length"), "lang")
    path = shared_path(spark, "refreshed")
    TB.refresh(rows.withColumn("length", F.lit(0)).withColumn("lang", F.concat("lang", F.lit("-old"))), path, ["lang"])
    TB.refresh(rows, path, ["lang"])
    return spark.read.schema("doc_id bigint, source string, n_chars bigint, length int, lang string").parquet(path)


@query("content_dedup_canonical", """
WITH f AS (SELECT doc_id, sha256(text) AS sha, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS pref, source || '/' || doc_id AS name FROM documents)
SELECT doc_id, name, first_value(name) OVER w AS canonical_name, count(*) OVER (PARTITION BY sha) AS copies,
       CASE WHEN row_number() OVER w = 1 THEN '' ELSE first_value(name) OVER w END AS duplicate_of
FROM f WINDOW w AS (PARTITION BY sha ORDER BY pref DESC, doc_id)""")
def content_dedup_canonical(spark, d):
    files = table(spark, d, "documents").select(
        "doc_id", F.sha2("text", 256).alias("sha256"), (F.col("lang") == "en").cast("int").alias("pref"),
        F.concat_ws("/", "source", "doc_id").alias("name"))
    out = MF.dedup_content(files, "sha256", "name", "doc_id", "pref")
    return out.select("doc_id", "name", "canonical_name", "copies", "duplicate_of")


@query("name_collisions", """
WITH u AS (SELECT doc_id, source || '-' || lang AS name FROM documents
           QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id) AS k FROM u)
SELECT doc_id, name, CASE WHEN k > 1 THEN name || ' (' || k || ')' ELSE name END AS unique_name FROM r""")
def name_collisions(spark, d):
    files = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.concat_ws("-", "source", "lang").alias("name"))
    first = files.groupBy("sha256").agg(F.min("doc_id").alias("doc_id"))
    unique = files.join(first, ["sha256", "doc_id"], "left_semi").drop("sha256")
    return MF.suffix_collisions(unique, "name", "doc_id")


_URL = r"^https?://(?:www\.|m\.|blog\.)?([^/?#]+)/([a-z]+)/([^/?#.]+)(\.[a-z]+)?"


@query("url_classify", rf"""
WITH u AS (SELECT page_id, regexp_extract(url, '{_URL}', 1) AS book, regexp_extract(url, '{_URL}', 3) AS stem,
                  regexp_extract(url, '{_URL}', 4) AS ext FROM pages),
v AS (SELECT *, regexp_extract(stem, '^j?0*(\d+)$', 1) AS vol FROM u)
SELECT page_id, book, CASE WHEN vol <> '' THEN 'volume' WHEN stem = book THEN 'standalone' ELSE 'named' END AS kind,
       TRY_CAST(vol AS INTEGER) AS volume,
       CASE WHEN vol <> '' THEN book || ' - vol ' || lpad(vol, greatest(2, length(vol))::INT, '0') || ext
            WHEN stem = book THEN book || ext ELSE book || ' - ' || stem || ext END AS canonical_name
FROM v""")
def url_classify(spark, d):
    u = table(spark, d, "pages").select(
        "page_id", F.regexp_extract("url", _URL, 1).alias("book"), F.regexp_extract("url", _URL, 3).alias("stem"), F.regexp_extract("url", _URL, 4).alias("ext"))
    named = MF.classify_name("book", "stem", "ext", volume_word="vol", intro_words=("intro",), intro_label="intro",
                             supplement_mark="s", supplement_word="supplement")
    rows = u.select("page_id", "book", named.alias("f"))
    return rows.select("page_id", "book", "f.kind", "f.volume", "f.canonical_name")


_STEM = ("CASE WHEN p_size % 5 = 0 THEN CAST(p_size AS VARCHAR) WHEN p_size % 5 = 1 THEN 'intro' "
         "WHEN p_size % 5 = 2 THEN 's' || CAST(p_size AS VARCHAR) WHEN p_size % 5 = 3 THEN p_brand ELSE p_name END")


@query("file_name_grammar", f"""
WITH f AS (SELECT p_partkey, p_brand, p_size, {_STEM} AS stem FROM part)
SELECT p_partkey,
       CASE p_size % 5 WHEN 0 THEN 'volume' WHEN 1 THEN 'intro' WHEN 2 THEN 'supplement' WHEN 3 THEN 'standalone' ELSE 'named' END AS kind,
       CASE p_size % 5 WHEN 0 THEN p_brand || ' - vol ' || lpad(stem, 2, '0') WHEN 1 THEN p_brand || ' - intro'
            WHEN 2 THEN p_brand || ' - supplement ' || p_size WHEN 3 THEN p_brand ELSE p_brand || ' - ' || stem END AS canonical_name,
       CASE WHEN p_size % 5 = 4 THEN p_brand || ' - ' || stem ELSE p_brand END AS parsed_book,
       CASE p_size % 5 WHEN 0 THEN 'volume' WHEN 1 THEN 'introduction' WHEN 2 THEN 'supplement' ELSE 'standalone' END AS parsed_kind,
       CASE WHEN p_size % 5 = 0 THEN p_size END AS parsed_volume
FROM f""")
def file_name_grammar(spark, d):
    parts = table(spark, d, "part").withColumn("stem", F.expr(_STEM.replace("VARCHAR", "STRING")))
    named = MF.classify_name("p_brand", "stem", F.lit(""), volume_word="vol", intro_words=("intro",), intro_label="intro",
                             supplement_mark="s", supplement_word="supplement")
    rows = parts.select("p_partkey", named.alias("f")).select("p_partkey", "f.kind", "f.canonical_name")
    back = MF.parse_name("canonical_name", volume_word="vol", intro_label="intro", supplement_word="supplement")
    return rows.withColumn("b", back).select(
        "p_partkey", "kind", "canonical_name", F.col("b.book").alias("parsed_book"), F.col("b.kind").alias("parsed_kind"),
        F.col("b.volume").alias("parsed_volume"))


#: Web pages: every paragraph opens a record; ads and footers are layers of their own.
WEB_PAGES = PG.PageLayout(
    page=None, noise=(r"(?s)<!--.*?-->", PG.element("script"), PG.element("style"), PG.element("nav"), PG.element("title")),
    layers=(("ad", PG.element("div", "ad")), ("footer", PG.element("footer"))), markers=(), marker_tags=r"(?i)<p\b[^>]*>")

_NOISE = [r"(?s)<!--.*?-->", r"(?is)<script\b(?:\s[^>]*)?>.*?</script\s*>", r"(?is)<style\b(?:\s[^>]*)?>.*?</style\s*>"]
_BLOCKS = [r"(?is)<nav\b(?:\s[^>]*)?>.*?</nav\s*>", r"(?is)<title\b(?:\s[^>]*)?>.*?</title\s*>",
           r'(?is)<div\b[^>]*class="ad"[^>]*>.*?</div\s*>', r"(?is)<footer\b(?:\s[^>]*)?>.*?</footer\s*>"]


def _sql_strip(c: str, patterns) -> str:
    for p in patterns:
        c = f"regexp_replace({c}, '{p}', ' ', 'g')"
    return c


def _sql_plain(c: str) -> str:
    c = f"regexp_replace({c}, '(?s)<[^>]*>', ' ', 'g')"
    for name, point in sorted(name2codepoint.items(), key=lambda x: (x[0] == "amp", x)):      # the ampersand itself last
        c = f"replace({c}, '&{name};', chr({32 if name == 'nbsp' else point}))"
    c = f"replace({c}, '&#39;', chr(39))"
    return rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


@query("page_segments", f"""
WITH m AS (SELECT page_id, {_sql_plain("regexp_replace(" + _sql_strip("html", _NOISE + _BLOCKS) + r", '(?i)<p\b[^>]*>', chr(1), 'g')")} AS t FROM pages),
s AS (SELECT page_id, unnest(string_split(t, chr(1))) AS text, generate_subscripts(string_split(t, chr(1)), 1) - 1 AS segment_no FROM m)
SELECT page_id, segment_no::INT AS segment_no, segment_no::VARCHAR AS marker, trim(text) AS text FROM s WHERE segment_no > 0""")
def page_segments(spark, d):
    pages = PG.split_pages(spread(table(spark, d, "pages"), "page_id"), "html", WEB_PAGES)
    return PG.page_records(pages, ["page_id"], layout=WEB_PAGES)


@query("page_blocks_layer", f"""
WITH b AS (SELECT page_id, {_sql_strip("html", _NOISE)} AS h FROM pages),
l AS (SELECT page_id, 'ad' AS layer, 0 AS k, unnest(regexp_extract_all(h, '(?is)<div\\b[^>]*class="ad"[^>]*>(.*?)</div\\s*>', 1)) AS raw FROM b
      UNION ALL SELECT page_id, 'footer', 1, unnest(regexp_extract_all(h, '(?is)<footer\\b(?:\\s[^>]*)?>(.*?)</footer\\s*>', 1)) FROM b),
p AS (SELECT page_id, layer, k, {_sql_plain("raw")} AS text FROM l)
SELECT page_id, layer, text, sha256(text) AS text_sha256 FROM p WHERE text <> ''""")
def page_blocks_layer(spark, d):
    pages = PG.split_pages(spread(table(spark, d, "pages"), "page_id"), "html", WEB_PAGES)
    return PG.side_layers(pages, ["page_id"], layout=WEB_PAGES).drop("layer_no")


_AROUND = ('<div class="ad"> a ', ' <div class="ad">b</div> rest end</div> after')


@query("page_nested_blocks", f"""
WITH b AS (SELECT page_id, {_sql_strip("html", _NOISE)} AS h FROM pages),
l AS (SELECT page_id, 'ad' AS layer, concat(' a ', h, ' b rest end') AS raw FROM b
      UNION ALL SELECT page_id, 'ad', 'b' FROM b
      UNION ALL SELECT page_id, 'ad', unnest(regexp_extract_all(h, '(?is)<div\\b[^>]*class="ad"[^>]*>(.*?)</div\\s*>', 1)) FROM b
      UNION ALL SELECT page_id, 'footer', unnest(regexp_extract_all(h, '(?is)<footer\\b(?:\\s[^>]*)?>(.*?)</footer\\s*>', 1)) FROM b),
p AS (SELECT page_id, layer, {_sql_plain("raw")} AS text FROM l)
SELECT page_id, layer, text, sha256(text) AS text_sha256 FROM p WHERE text <> ''""")
def page_nested_blocks(spark, d):
    """Every page inside a layer element, with one more layer element after it: layers nest two deep."""
    pages = spread(table(spark, d, "pages"), "page_id").withColumn("html", F.concat(F.lit(_AROUND[0]), "html", F.lit(_AROUND[1])))
    return PG.side_layers(PG.split_pages(pages, "html", WEB_PAGES), ["page_id"], layout=WEB_PAGES).drop("layer_no")


@query("line_sessions", r"""
WITH l AS (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
m AS (SELECT *, CASE WHEN regexp_matches(line, '^[A-E]') THEN doc_id * 1000000 + i END AS mark FROM l),
o AS (SELECT *, max(mark) OVER (PARTITION BY source ORDER BY doc_id, i) AS entry FROM m)
SELECT source, entry // 1000000 AS entry_order, (entry % 1000000)::INT AS entry_segment, count(*) AS parts,
       sum(length(trim(line)))::BIGINT AS chars, count(DISTINCT doc_id) AS pages
FROM o WHERE entry IS NOT NULL AND trim(line) <> '' GROUP BY 1, 2, 3""")
def line_sessions(spark, d):
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(
        F.when(x.rlike("^[A-E]"), F.substring(x, 1, 1)).alias("number"), F.trim(x).alias("text")))
    segs = documents(spark, d).select("source", F.col("doc_id").alias("ord"), lines.alias("segs"))
    parts = PG.carry_parts(segs, "source", "ord", "segs")
    per_page = parts.groupBy("source", "entry_order", "entry_segment", "part_order").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("c"))
    return per_page.groupBy("source", "entry_order", "entry_segment").agg(
        F.sum("n").alias("parts"), F.sum("c").alias("chars"), F.count(F.lit(1)).alias("pages"))


@query("record_classify", r"""
WITH t AS (SELECT doc_id, regexp_replace(regexp_replace(text, '^ +', ''), '^\(\d+\)\s*', '') AS t FROM documents),
k AS (SELECT doc_id, CASE
  WHEN regexp_matches(t, '^(Is|Des)') THEN 'title'
  WHEN regexp_matches(substr(t, 1, 300), '(with|avec|mit|con)') THEN 'hadith'
  WHEN regexp_matches(t, '^(The|La)\s+') AND length(t) > 80 THEN 'report'
  WHEN regexp_matches(substr(t, 1, 500), '(that|pour)') AND length(t) > 80 THEN 'report' ELSE 'other' END AS record_type FROM t)
SELECT doc_id, record_type, (record_type = 'other')::INT AS needs_review FROM k WHERE record_type <> 'title'""")
def record_classify(spark, d):
    return E.typed_records(documents(spark, d).select("doc_id", "text"), "text", PROSE).select("doc_id", "record_type", "needs_review")


_TERMS = [(r"(for|was)\s+(that|pour)", False), (r"are\s*:\s*are\s+(that|pour)", False),
          (r"are\s+(that|pour)(\s+the)?", True), (r"on\s+(that|pour)(\s+the)?(\s+(by|are))?", True)]


def _term_sql(p: str, keep: bool) -> str:
    start = rf"regexp_extract(sub, '(?s)^((?:.*?[^\p{{L}}\p{{N}}_])?)({p})', 1)"
    hit = rf"regexp_matches(sub, '(?s)^((?:.*?[^\p{{L}}\p{{N}}_])?)({p})')"
    end = f"length({start})" + (rf" + length(regexp_extract(sub, '(?s)^((?:.*?[^\p{{L}}\p{{N}}_])?)({p})', 2))" if keep else "")
    return f"CASE WHEN {hit} AND length({start}) > 15 THEN {end} END"


@query("boundary_extract", rf"""
WITH t AS (SELECT doc_id, regexp_replace(trim(text), '^\(\d+\)\s*', '') AS t FROM documents),
o AS (SELECT doc_id, t, CASE WHEN regexp_matches(substr(t, 1, 350), '(with|avec|mit|con)')
             THEN length(regexp_extract(substr(t, 1, 350), '(?s)^(.*?)(with|avec|mit|con)', 1)) + 1
             WHEN regexp_matches(t, '^(The|La)\s+') THEN 1 END AS start FROM t),
s AS (SELECT doc_id, substr(t, start) AS sub FROM o WHERE start IS NOT NULL),
e AS (SELECT doc_id, sub, least({", ".join(_term_sql(p, k) for p, k in _TERMS)}) AS terminal FROM s),
cut AS (SELECT doc_id, sub, string_split_regex(sub, '[|!]') AS pieces FROM s),
bp AS (SELECT doc_id, sub, unnest(list_transform(range(1, len(pieces)), lambda i: list_sum(list_transform(pieces[1:i], lambda x: length(x)))::BIGINT + i - 1)) AS p
       FROM cut WHERE len(pieces) > 1),
st AS (SELECT doc_id, length(regexp_extract(sub, '(?s)^.*?(?:of|de).*?(?:of|de)')) AS two FROM s WHERE regexp_matches(sub, '(?s)(of|de).*?(of|de)')),
rp AS (SELECT doc_id, min(p) + 1 AS reporter FROM bp JOIN st USING (doc_id)
       WHERE p > 30 AND p >= two AND regexp_matches(substr(sub, greatest(p - 220, 0) + 1, p - greatest(p - 220, 0)), '(and|et)')
         AND NOT regexp_matches(substr(sub, p + 2, 200), '^[\s.,;:\-]*(in|is)') GROUP BY doc_id),
j AS (SELECT e.doc_id, sub, terminal, reporter,
      CASE WHEN terminal IS NOT NULL AND (reporter IS NULL OR terminal <= reporter) THEN 'prophet_boundary'
           WHEN reporter IS NOT NULL THEN 'reporter_boundary' ELSE 'open_ended' END AS boundary_method
      FROM e LEFT JOIN rp ON e.doc_id = rp.doc_id),
c AS (SELECT *, coalesce(least(terminal, reporter), 1400) AS fin FROM j),
r AS (SELECT doc_id, boundary_method, trim(substr(sub, 1, fin)) AS chain,
      CASE boundary_method WHEN 'reporter_boundary' THEN 0.78 WHEN 'open_ended' THEN 0.40 ELSE 0.90 END::DOUBLE AS confidence,
      CASE WHEN boundary_method = 'open_ended' THEN 1 WHEN boundary_method = 'reporter_boundary'
           AND regexp_matches(substr(sub, fin + 1, 1200), '(on|are).{{0,50}}(that|pour)') THEN 1 ELSE 0 END AS ext FROM c)
SELECT doc_id, boundary_method, confidence, (boundary_method = 'prophet_boundary')::INT AS terminal_hint, ext AS needs_extension_review,
       (confidence < 0.8 OR ext = 1)::INT AS needs_review, length(chain) AS chain_chars, sha256(chain) AS chain_sha256
FROM r WHERE boundary_method <> 'open_ended' OR length(chain) >= 25""")
def boundary_extract(spark, d):
    chains = E.extract_chains(documents(spark, d).select("doc_id", "text"), "text", PROSE)
    return chains.select("doc_id", "boundary_method", "confidence", "terminal_hint", "needs_extension_review", "needs_review",
                         F.length("chain_raw").alias("chain_chars"), F.sha2("chain_raw", 256).alias("chain_sha256"))


_CONN = r"(^|[^\p{L}\p{N}_])(the|der|die|de|la|of)(\s)"


@query("mentions", rf"""
WITH m AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '(\s)', '\1\1', 'g'), '{_CONN}', '\1' || chr(1) || '\2' || chr(2), 'g'), chr(1)) AS p FROM documents),
u AS (SELECT doc_id, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM m),
b AS (SELECT *, sum(length(x) - length(replace(x, chr(10), ''))) OVER (PARTITION BY doc_id ORDER BY i) // 2 AS upto FROM u),
z AS (SELECT doc_id, i, lag(upto) OVER (PARTITION BY doc_id ORDER BY i) AS branch, split_part(x, chr(2), 1) AS term,
      trim(regexp_replace(trim(regexp_replace(split_part(x, chr(2), 2), '\s+', ' ', 'g'), ' ،؛;:.()-'), '(?s)[.!,].*$', ''), ' ،؛;:.()-') AS name FROM b),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS seq FROM z WHERE i > 1 AND name <> ''),
k AS (SELECT *, CASE WHEN name IN ('it', 'ou', 'ne') THEN 'relational_or_unknown'
      WHEN contains(name, 'that') OR contains(name, 'pour') THEN 'prophet_terminal' ELSE 'named_candidate' END AS kind FROM n)
SELECT doc_id, seq::INT AS sequence_index, branch::INT AS branch_hint, term AS transmission_term, name AS normalized_name, kind AS mention_type,
       (kind <> 'named_candidate' OR length(name) < 3 OR length(name) > 120)::INT AS needs_review FROM k""")
def mentions(spark, d):
    found = E.extract_mentions(documents(spark, d), "doc_id", "text", PROSE, route=r"\n")
    return found.select("doc_id", "sequence_index", "branch_hint", "transmission_term", "normalized_name", "mention_type", "needs_review")


@query("atomic_split", r"""
WITH s AS (SELECT doc_id, unnest(string_split(text, '.')) AS raw, generate_subscripts(string_split(text, '.'), 1) AS sentence_no FROM documents),
t AS (SELECT doc_id, sentence_no, trim(trim(raw), ' ،؛;:.()-') AS s FROM s),
c AS (SELECT doc_id, sentence_no, list_filter(list_transform(string_split(s, ','), lambda x: trim(x)), lambda x: x <> '') AS cs, s FROM t),
a AS (SELECT doc_id, sentence_no, s, flatten(list_transform(cs, lambda x: list_transform(string_split_regex(x, '\s+(?:and|et)\s+'), lambda y: trim(trim(y), ' ،؛;:.()-')))) AS ps FROM c),
f AS (SELECT doc_id, sentence_no, s, list_filter(ps, lambda x: x <> '') AS ps FROM a),
e AS (SELECT doc_id, sentence_no, CASE WHEN len(ps) > 0 THEN ps WHEN s <> '' THEN [s] ELSE [] END AS ps FROM f),
u AS (SELECT doc_id, sentence_no, len(ps) > 1 AS g, unnest(ps) AS p, generate_subscripts(ps, 1) AS atomic_index FROM e),
n AS (SELECT *, trim(regexp_replace(p, '\s+', ' ', 'g'), ' ،؛;:.()-') AS name FROM u)
SELECT doc_id, sentence_no::INT AS sentence_no, atomic_index::INT AS atomic_index, g::INT AS is_group, name AS normalized_name,
       (CASE WHEN name IN ('it', 'ou') THEN 1 ELSE 0 END = 1 OR length(name) < 3 OR length(name) > 90 OR contains(p, '(') OR contains(p, ':'))::INT AS needs_review
FROM n WHERE name <> ''""")
def atomic_split(spark, d):
    sentences = documents(spark, d).select("doc_id", F.posexplode(F.split("text", r"\.")).alias("i", "raw"))
    sentences = sentences.select("doc_id", (F.col("i") + 1).alias("sentence_no"), "raw", F.lit("named_candidate").alias("kind"))
    atoms = E.atomic_occurrences(sentences, ["doc_id", "sentence_no"], "raw", "kind", PROSE, joiner=r"\s+(?:and|et)\s+")
    return atoms.select("doc_id", "sentence_no", "atomic_index", "is_group", "normalized_name", "needs_review")


@query("list_segments", rf"""
WITH s AS (SELECT doc_id, unnest(string_split(text, ',')) AS raw FROM documents),
n AS (SELECT doc_id, {plain(r"regexp_replace(raw, '\([^)]{0,30}\)', ' ', 'g')")} AS segment FROM s)
SELECT segment, count(*) AS uses, count(DISTINCT doc_id) AS docs FROM n WHERE length(segment) >= 3 GROUP BY 1""")
def list_segments(spark, d):
    segs = documents(spark, d).select("doc_id", F.explode(E.list_segments("text", T.Profile(parentheses_up_to=30), ",", PROSE)).alias("segment"))
    per_doc = segs.groupBy("segment", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("segment").agg(F.sum("n").alias("uses"), F.count(F.lit(1)).alias("docs"))


def _norm_sql(profile: T.Profile) -> str:
    c = "text"
    if profile.parentheses_up_to:
        c = rf"regexp_replace({c}, '\([^)]{{0,{profile.parentheses_up_to}}}\)', ' ', 'g')"
    if profile.blank:
        c = f"translate({c}, '[]«»()', '      ')"
    return rf"trim(regexp_replace({c}, '\s+', ' ', 'g'), '{profile.trim}')"


@query("normalize_profiles", "SELECT doc_id, " + ", ".join(
    f"sha256({_norm_sql(p)}) AS {name}" for name, p in T.PROFILES.items()) + " FROM documents")
def normalize_profiles(spark, d):
    return documents(spark, d).select("doc_id", *[F.sha2(T.normalize("text", p), 256).alias(n) for n, p in T.PROFILES.items()])


#: Words of the invented prose that become Arabic tokens, with vowel marks, hamza forms, invisible signs and brackets.
ARABIC_TOKENS = ((" the ", " ابن "), (" of ", " أَبِي "), (" and ", " مُحَمَّدُ بْنُ إبراهيم "), (" is ", " (نزيل\u200f البصرة) "), (" for ", " يحيى ـ «زهير» "))


def _arabic_sql(c: str) -> str:
    for old, new in ARABIC_TOKENS:
        c = f"replace({c}, '{old}', '{new}')"
    return c


def arabic(c):
    """Text with some of its words replaced by Arabic tokens."""
    for old, new in ARABIC_TOKENS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def _norm_arabic_sql(profile: T.Profile) -> str:
    """A profile in SQL with all its steps; lineage words are whole tokens of the trimmed text."""
    c = f"regexp_replace(text, '[{lx.MARKS}]', '', 'g')"
    c = f"translate({c}, '{lx.ALEF_FORMS}ى', '{'ا' * len(lx.ALEF_FORMS)}ي')"
    if profile.parentheses_up_to:
        c = rf"regexp_replace({c}, '\([^)]{{0,{profile.parentheses_up_to}}}\)', ' ', 'g')"
    if profile.blank:
        c = f"translate({c}, '{profile.blank}', '{' ' * len(profile.blank)}')"
    if profile.drop_invisible:
        c = f"translate({c}, '{lx.TATWEEL}{lx.ZERO_WIDTH}', '')"
    c = rf"trim(regexp_replace({c}, '\s+', ' ', 'g'), '{profile.trim}')"
    if profile.lineage:
        swaps = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in profile.lineage)
        c = f"array_to_string(list_transform(string_split({c}, ' '), lambda w: CASE w {swaps} ELSE w END), ' ')"
    return c


@query("normalize_arabic", "WITH d AS (SELECT doc_id, " + _arabic_sql("text") + " AS text FROM documents) SELECT doc_id, " + ", ".join(
    f"sha256({_norm_arabic_sql(p)}) AS {name}" for name, p in T.PROFILES.items()) + " FROM d")
def normalize_arabic(spark, d):
    """All profiles on texts in which marks, letter forms, lineage tokens, brackets and invisible signs do occur."""
    docs = documents(spark, d).select("doc_id", arabic(F.col("text")).alias("text"))
    return docs.select("doc_id", *[F.sha2(T.normalize("text", p), 256).alias(n) for n, p in T.PROFILES.items()])


@query("secondary_entries", r"""
WITH p AS (SELECT p_partkey AS k, p_size % 4 AS g, p_name AS n, p_type AS t FROM part),
e AS (SELECT 'bracketed' AS source, k, k AS no, n AS heading, n || ' ' || t AS body FROM p WHERE g = 0 AND k % 2 = 0
  UNION ALL SELECT 'numbered', k, k, n, n || ' ' || t FROM p WHERE g = 1 AND k % 3 > 0
  UNION ALL SELECT 'plain', k, NULL, 'مالك بْن ' || n, 'مالك بْن ' || n || ' ' || t FROM p WHERE g = 2 AND k % 3 = 0
  UNION ALL SELECT 'numeric', k, k, 'أبو ' || n, 'أبو ' || n || ': ' || t FROM p WHERE g = 3 AND k % 4 = 1
  UNION ALL SELECT 'numeric', k, k, 'مالك ابن ' || n, 'مالك ابن ' || n || '، ' || t FROM p WHERE g = 3 AND k % 4 = 0)
SELECT 'SE_' || substr(sha256(concat_ws(chr(31), source, k::VARCHAR, coalesce(no::VARCHAR, ''), heading)), 1, 20) AS entry_id, source, k AS page_order, no::INT AS entry_no, heading,
       replace(replace(replace(heading, 'أ', 'ا'), 'ْ', ''), ' ابن ', ' بن ') AS heading_norm, body FROM e""")
def secondary_entries(spark, d):
    """C-06: entries of three title grammars and of a numbered source; titles and first clauses that open no entry are left out."""
    part = table(spark, d, "part")
    k, n = F.col("p_partkey"), F.col("p_name")
    plain_title = F.when(k % 3 == 0, F.concat(F.lit("مالك بْن "), n)).when(k % 3 == 1, F.concat(F.lit("باب مالك بن "), n)).otherwise(n)
    titles = {
        "bracketed": F.when(k % 2 == 0, F.concat(F.lit("["), k, F.lit("]  "), n)).otherwise(n),
        "numbered": F.when(k % 3 == 0, n).when(k % 3 == 1, F.concat(k, F.lit(" ز - "), n)).otherwise(F.concat(k, F.lit(" "), n)),
        "plain": F.concat(plain_title, F.lit("؛ ")),
    }
    text = F.when(k % 4 == 0, F.concat(F.lit("مالك ابن "), n, F.lit("، "), "p_type")).when(k % 4 == 1, F.concat(F.lit("أبو "), n, F.lit(": "), "p_type")).when(
        k % 4 == 2, F.concat(F.lit("فصل بن "), n)).otherwise(F.concat(n, F.lit(". "), "p_type"))
    out = None
    for i, (source, title) in enumerate([*titles.items(), ("numeric", k.cast("string"))]):
        bodies = part.filter(F.col("p_size") % 4 == i).select(
            F.lit(source).alias("source"), k.alias("entry_order"), title.alias("number"), (text if source == "numeric" else F.col("p_type")).alias("body"))
        rows = PG.secondary_entries(bodies, "source", None if source == "numeric" else source)
        out = rows if out is None else out.unionByName(rows)
    return out


@query("stable_ids", """
SELECT o_orderkey, 'OR_' || substr(sha256(concat_ws(chr(31), o_orderkey::VARCHAR, o_custkey::VARCHAR, o_orderstatus)), 1, 20) AS stable_id FROM orders""")
def stable_ids(spark, d):
    return table(spark, d, "orders").select("o_orderkey", T.stable_id("OR_", "o_orderkey", "o_custkey", "o_orderstatus").alias("stable_id"))


@query("specific_keys", """
WITH p AS (SELECT p_partkey, p_name || ' of ' || p_brand || ' of ' || p_type AS ident, p_brand, p_type,
                  split_part(p_name, ' ', 1) AS w1, p_name FROM part),
k AS (SELECT p_partkey, CASE WHEN w1 IN ('red', 'old') THEN p_name ELSE w1 END AS person, * EXCLUDE (p_partkey) FROM p),
u AS (SELECT p_partkey, ident AS key FROM k UNION SELECT p_partkey, person || ' of ' || p_brand FROM k
      UNION SELECT p_partkey, person || ' of ' || p_brand || ' of ' || split_part(p_type, ' ', 1) FROM k
      UNION SELECT p_partkey, p_name || ' of' FROM k WHERE w1 = 'small')
SELECT u.p_partkey, u.key, k.p_brand || ' of ' || k.p_type AS lineage_tail FROM u JOIN k USING (p_partkey) WHERE length(key) >= 4""")
def specific_keys(spark, d):
    ident = F.concat_ws(" of ", "p_name", "p_brand", "p_type")
    rows = table(spark, d, "part").select("p_partkey", ident.alias("ident"))
    return rows.select("p_partkey", K.lineage_tail("ident", "of").alias("lineage_tail"),
                       F.explode(K.specific_keys("ident", "of", ("red", "old"), ("small",))).alias("key"))


@query("prefix_index", rf"""
WITH t AS (SELECT doc_id, list_filter(string_split({plain("text")}, ' '), lambda x: x <> '') AS t FROM documents),
k AS (SELECT DISTINCT doc_id, array_to_string(t[1:l], ' ') AS key FROM (SELECT doc_id, t, unnest(range(1, least(6, len(t)) + 1)) AS l FROM t))
SELECT key, count(*) AS block_size FROM k GROUP BY 1""")
def prefix_index(spark, d):
    docs = documents(spark, d).select("doc_id", T.normalize("text").alias("n"))
    return B.block_sizes(B.prefix_index(docs, "doc_id", "n", 1, 6))


@query("phrase_clean", r"""
WITH t AS (SELECT doc_id, trim(text, ' ،؛;:.()-') AS t FROM documents),
c AS (SELECT doc_id, trim(regexp_replace(t, '(?s)[.!,].*$', ''), ' ،؛;:.()-') AS phrase,
      regexp_extract(t, '(?s)^(.*?)(?:(?:^|[^\p{L}\p{M}\p{N}_])(?:the|and|et)(?:[^\p{L}\p{M}\p{N}_]|$)|$)', 1) AS head FROM t)
SELECT doc_id, phrase, sha256(trim(regexp_replace(head, '(?s)[.;].*$', ''), ' ،؛;:.()-')) AS head_sha256 FROM c""")
def phrase_clean(spark, d):
    return documents(spark, d).select(
        "doc_id", T.clean_phrase("text", PROSE).alias("phrase"),
        F.sha2(T.trim_chars(T.cut_at_words("text", ("the", "and", "et"), stops=".;"), " ،؛;:.()-"), 256).alias("head_sha256"))


@query("labelled_sections", r"""
WITH t AS (SELECT doc_id, text, regexp_extract(text, '(?s)^(.*?)(?: (?:of|de)\s|$)', 1) AS h,
      CASE WHEN regexp_matches(text, '(?i) with ') THEN regexp_replace(text, '(?is)^.*? with ', '') ELSE '' END AS after FROM documents)
SELECT doc_id, trim(substr(h, 1, 900)) AS heading, sha256(trim(regexp_extract(after, '(?is)^(.*?)(?: and | the |$)', 1))) AS section_sha256 FROM t""")
def labelled_sections(spark, d):
    return documents(spark, d).select(
        "doc_id", T.before("text", r" (?:of|de)\s", 900).alias("heading"),
        F.sha2(T.section("text", " with ", [" and ", " the "]), 256).alias("section_sha256"))


@query("phrase_page_evidence", rf"""
WITH n AS (SELECT item_id, list_filter(string_split({plain("text")}, ' '), lambda x: x <> '') AS t, {plain("text")} AS nm FROM benchmark),
k AS (SELECT item_id, nm, CASE WHEN len(t) >= 3 THEN array_to_string(t[1:5], ' ') END AS key FROM n),
d AS (SELECT doc_id, source, text, ' ' || {plain("text")} || ' ' AS body FROM documents),
h AS (SELECT key, source, doc_id, row_number() OVER (PARTITION BY key, source ORDER BY doc_id) AS rank
      FROM (SELECT DISTINCT key FROM k WHERE key IS NOT NULL) JOIN d ON contains(body, ' ' || key || ' ')),
f AS (SELECT item_id, key, source, doc_id, rank, text, greatest(instr(text, split_part(nm, ' ', 1)) - 1, 0) AS pos
      FROM h JOIN k USING (key) JOIN documents USING (doc_id, source) WHERE rank <= 2)
SELECT item_id AS owner_id, source, doc_id AS page_id, rank::INT AS rank, key,
       substr(text, greatest(pos - 350, 0) + 1, pos + 1200 - greatest(pos - 350, 0)) AS snippet FROM f""")
def phrase_page_evidence(spark, d):
    names = table(spark, d, "benchmark").select(F.col("item_id").alias("owner_id"), T.normalize("text").alias("name_text"))
    names = names.withColumn("key", K.source_key("name_text", ()))
    pages = documents(spark, d).select(F.col("doc_id").alias("page_id"), "source", "text", T.normalize("text").alias("text_norm"))
    return phrase_pages(names, pages)


@query("statements", r"""
WITH t AS (SELECT conv_id, turn, regexp_extract_all(text, '(?:^|[.])\s*The\s+([^,]{2,120})[,]\s*([^.;؛]{1,500})', 1) AS a,
           regexp_extract_all(text, '(?:^|[.])\s*The\s+([^,]{2,120})[,]\s*([^.;؛]{1,500})', 2) AS s FROM conversations),
u AS (SELECT conv_id, turn, trim(unnest(a)) AS attribution, trim(unnest(s)) AS statement FROM t),
c AS (SELECT DISTINCT *, trim(list_extract(string_split_regex(attribution, '\s+of\s+'), -1)) AS critic FROM u)
SELECT conv_id, turn, critic, attribution, statement, CASE WHEN contains(statement, 'and') THEN 'and_words' ELSE 'other' END AS judgment FROM c
WHERE (contains(statement, 'and') OR contains(statement, 'for')) AND NOT contains(attribution, 'that') AND length(critic) BETWEEN 2 AND 80""")
def statements(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.explode(EV.statements(
        "text", ("and", "for"), ("that",), said="The", opens=None, via="of", sentence_end=".", colon=",", folded=False)).alias("s"))
    rows = rows.select("conv_id", "turn", "s.critic", "s.attribution", "s.statement").distinct()
    return rows.withColumn("judgment", R.first_rule("statement", (("and_words", ("and",)),), "other", folded=False))


@query("alias_gen", """
WITH p AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, p_brand AS x, p_name || ' of ' || p_brand AS n FROM part),
u AS (SELECT p_partkey, n AS alias, 'identity' AS alias_type FROM p UNION SELECT p_partkey, a, 'first_name' FROM p
 UNION SELECT p_partkey, a || ' ' || b, 'embedded_kunya' FROM p WHERE a IN ('red', 'blue')
 UNION SELECT p_partkey, a || ' ' || b || ' of', 'embedded_kunya_lineage' FROM p WHERE a IN ('red', 'blue')
 UNION SELECT p_partkey, n, 'embedded_kunya_lineage' FROM p WHERE a IN ('red', 'blue')
 UNION SELECT p_partkey, 'of ' || x, 'embedded_ibn_alias' FROM p
 UNION SELECT p_partkey, a || ' ' || b, 'name_prefix' FROM p UNION SELECT p_partkey, a || ' ' || b || ' of', 'name_prefix' FROM p
 UNION SELECT p_partkey, n, 'name_prefix' FROM p)
SELECT * FROM u WHERE length(alias) >= 2""")
def alias_gen(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.concat_ws(" of ", "p_name", "p_brand").alias("n"))
    rows = rows.select("p_partkey", F.explode(K.card_aliases("n", "of", ("red", "blue"))).alias("a"))
    return rows.select("p_partkey", "a.alias", "a.alias_type")


@query("seed_import_alias", rf"""
WITH s AS (SELECT s_suppkey AS entity_id, s_name AS short_name, '' AS long_name FROM supplier
           UNION ALL SELECT c_custkey, '', c_name FROM customer)
SELECT entity_id, short_name, long_name, {plain("short_name")} AS short_norm, {plain("long_name")} AS long_norm,
       CASE WHEN short_name <> '' THEN 1 ELSE 0 END AS death_year FROM s""")
def seed_import_alias(spark, d):
    one = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("shortName"), F.lit("1").alias("deathYear"))
    two = table(spark, d, "customer").select(F.col("c_custkey").alias("narrator_id"), F.col("c_name").alias("long_name_ar"), F.lit(0).alias("death_hijri"))
    cols = ["entity_id", "short_name", "long_name", "short_norm", "long_norm", "death_year"]
    return seed_entities(one).select(*cols).unionByName(seed_entities(two).select(*cols))


@query("number_words", r"""
WITH s AS (SELECT doc_id, unnest(string_split(text, ',')) AS raw, generate_subscripts(string_split(text, ','), 1) AS k FROM documents),
t AS (SELECT doc_id, k, list_filter(string_split_regex(trim(trim(regexp_replace(raw, '\s+', ' ', 'g')), ' ،؛.'), '\s+'), lambda x: x <> '') AS t FROM s),
v AS (SELECT doc_id, k, len(t) AS n, list_transform(t, lambda x: CASE x WHEN 'the' THEN 1 WHEN 'of' THEN 20 WHEN 'de' THEN 20 WHEN 'and' THEN 300 END) AS v FROM t),
f AS (SELECT doc_id, k, n, list_filter(v, lambda x: x IS NOT NULL) AS v FROM v)
SELECT doc_id, k::INT AS segment_no, list_sum(v)::INT AS total FROM f WHERE len(v) > 0 AND len(v) >= greatest(1, n - 1)""")
def number_words(spark, d):
    segs = documents(spark, d).select("doc_id", F.posexplode(F.split("text", ",")).alias("i", "raw"))
    total = R.number_words("raw", {"the": 1, "of": 20, "de": 20, "and": 300}, conjunction="", drop=())
    return segs.select("doc_id", (F.col("i") + 1).alias("segment_no"), total.alias("total")).filter(F.col("total").isNotNull())


# -- single rules over sentences -----------------------------------------------------------------

_SENTENCES = "s AS (SELECT doc_id, unnest(string_split(text, '.')) AS raw, generate_subscripts(string_split(text, '.'), 1) AS k FROM documents)"


def sentences(spark: SparkSession, d: str) -> DataFrame:
    rows = documents(spark, d).select("doc_id", F.posexplode(F.split("text", r"\.")).alias("i", "raw"))
    return rows.select("doc_id", (F.col("i") + 1).alias("sentence_no"), "raw")


@query("continuations", rf"""
WITH {_SENTENCES} SELECT doc_id, k::INT AS sentence_no, regexp_matches(trim(raw, ' .,،؛;:-'), '^(in|is)')::INT AS continues FROM s WHERE raw <> ''""")
def continuations(spark, d):
    return sentences(spark, d).filter("raw <> ''").select("doc_id", "sentence_no", E.is_continuation("raw", PROSE).cast("int").alias("continues"))


@query("class_ordinals", rf"""
WITH {_SENTENCES}, n AS (SELECT doc_id, k, regexp_extract(trim(regexp_replace(raw, '\s+', ' ', 'g')), '(?:in|of)\s+(the|that|is)', 1) AS w FROM s)
SELECT doc_id, k::INT AS sentence_no, CASE w WHEN 'the' THEN 1 WHEN 'that' THEN 2 ELSE 3 END AS ordinal FROM n WHERE w <> ''""")
def class_ordinals(spark, d):
    found = R.class_ordinal("raw", {"the": 1, "that": 2, "is": 3}, r"(?:in|of)\s+")
    return sentences(spark, d).select("doc_id", "sentence_no", found.alias("ordinal")).filter("ordinal IS NOT NULL")


@query("name_eligibility", rf"""
WITH {_SENTENCES}, t AS (SELECT doc_id, k, list_filter(string_split({plain("raw")}, ' '), lambda x: x <> '') AS t FROM s)
SELECT doc_id, k::INT AS sentence_no, t[1] || ' ' || t[2] AS head,
       CASE WHEN len(list_filter(t, lambda x: x NOT IN ('a', 'un'))) >= 3 THEN array_to_string(list_filter(t, lambda x: x NOT IN ('a', 'un'))[1:5], ' ') END AS source_key
FROM t WHERE len(t) >= 3 AND t[1] NOT IN ('The', 'La') AND t[2] IN ('of', 'de', 'the')""")
def name_eligibility(spark, d):
    rows = sentences(spark, d).withColumn("n", T.normalize("raw"))
    keep = K.lineage_eligible("n", "of", ("The", "La")) | K.lineage_eligible("n", "de", ("The", "La")) | K.lineage_eligible("n", "the", ("The", "La"))
    return rows.filter(keep).select("doc_id", "sentence_no", F.substring_index("n", " ", 2).alias("head"), K.source_key("n", ("a", "un")).alias("source_key"))


@query("kin_tokens", rf"""
WITH {_SENTENCES}, n AS (SELECT doc_id, k, {plain("raw")} AS n FROM s),
t AS (SELECT doc_id, k, regexp_extract(n, '^(The|Of|La) (.+)$', 1) AS token, regexp_extract(n, '^(The|Of|La) (.+)$', 2) AS rest FROM n),
c AS (SELECT *, regexp_extract(trim(rest, ' ،؛;:.()-'), '(?s)^(.*?)(?:(?:^|[^\p{{L}}\p{{M}}\p{{N}}_])(?:and|et)(?:[^\p{{L}}\p{{M}}\p{{N}}_]|$)|$)', 1) AS head FROM t)
SELECT doc_id, k::INT AS sentence_no, token, trim(regexp_replace(head, '(?s)[.؛;:\[].*$', ''), ' ،؛;:.()-') AS label FROM c WHERE token <> ''""")
def kin_tokens(spark, d):
    token, label = KIN.kin_tokens("n", F.lit("named_candidate"), ("The", "Of", "La"), cuts=("and", "et"))
    rows = sentences(spark, d).withColumn("n", T.normalize("raw"))
    return rows.select("doc_id", "sentence_no", token.alias("token"), label.alias("label")).filter("token IS NOT NULL")


@query("embedded_mentions", r"""
WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?:^|[^\p{L}\p{N}_])for\s+(.{2,120}?)\s+(the|and)(?:,|$)', 1)) AS raw,
           unnest(regexp_extract_all(text, '(?:^|[^\p{L}\p{N}_])for\s+(.{2,120}?)\s+(the|and)(?:,|$)', 2)) AS verb FROM documents),
n AS (SELECT doc_id, 'embedded_' || verb AS transmission_term, trim(regexp_replace(trim(regexp_replace(raw, '(?s)[.!,].*$', ''), ' ،؛;:.()-'), '\s+', ' ', 'g'), ' ،؛;:.()-') AS normalized_name FROM m)
SELECT doc_id, transmission_term, normalized_name, count(*) AS mentions FROM n WHERE normalized_name <> '' GROUP BY 1, 2, 3""")
def embedded_mentions(spark, d):
    g = replace(PROSE, embedded_leads=("for",), embedded_verbs=("the", "and"))
    found = E.extract_mentions(documents(spark, d), "doc_id", "text", g, route=None).filter(F.col("transmission_term").startswith("embedded_"))
    return found.groupBy("doc_id", "transmission_term", "normalized_name").agg(F.count(F.lit(1)).alias("mentions"))


@query("own_kunyas", """
WITH p AS (SELECT p_partkey, string_split(p_name, ' ') AS t, p_name, p_brand FROM part),
a AS (SELECT p_partkey, array_to_string(t[1:2], ' ') AS key FROM p WHERE t[1] IN ('red', 'blue') UNION SELECT p_partkey, 'red ' || t[2] FROM p UNION SELECT p_partkey, 'red ' || t[2] || ' ' || t[1] FROM p)
SELECT DISTINCT p_partkey, key FROM (SELECT p_partkey, key FROM a WHERE starts_with(key, 'red '))""")
def own_kunyas(spark, d):
    """The first kunya of the name and every kunya introduced after a comma."""
    intro = F.concat(F.lit("of brand, red "), F.substring_index("p_name", " ", -1), F.lit(" "), F.substring_index("p_name", " ", 1))
    rows = table(spark, d, "part").select("p_partkey", F.explode(K.own_kunya("p_name", intro, "a-z", "red", "called", ",")).alias("key"))
    return rows.distinct()


@query("heading_filter", rf"""
WITH {_SENTENCES}, n AS (SELECT doc_id, k, {SQL_HEAD.format(c="raw")} AS h FROM s)
SELECT doc_id, k::INT AS sentence_no, h AS heading FROM n WHERE length(h) BETWEEN 5 AND 60 AND NOT regexp_matches(h, '^(The|La)')
  AND (contains(' ' || h || ' ', ' of ') OR starts_with(h, 'In ') OR starts_with(h, 'On '))""")
def heading_filter(spark, d):
    rows = T.staged(sentences(spark, d), heading=T.normalize("raw", T.HEADINGS))
    return rows.filter(PG.heading_allowed("heading", 5, 60, ("The", "La"), "of", ("In ", "On "), ready=True)).select("doc_id", "sentence_no", "heading")


@query("note_strip", rf"""
WITH {_SENTENCES}, a AS (SELECT doc_id, k, regexp_replace(trim(raw, ' '), '(?s)\s+(and|et)\s+.*$', '') AS a FROM s),
b AS (SELECT doc_id, k, trim(regexp_replace(a, '\s+(the|is|of)\s*$', ''), ' ،؛;:.()-') AS name FROM a)
SELECT doc_id, k::INT AS sentence_no, name, {SQL_PLAIN.format(c=r"regexp_replace(name, '\([^)]{0,40}\)', ' ', 'g')")} AS kunya_norm FROM b WHERE name <> ''""")
def note_strip(spark, d):
    g = replace(PROSE, note_rules=((r"(?s)\s+(?:and|et)\s+.*$", ""), (r"\s+(?:the|is|of)\s*$", "")))
    rows = T.staged(sentences(spark, d), name=T.strip_notes("raw", g)).filter("name <> ''")
    return rows.select("doc_id", "sentence_no", "name", T.kunya_normalize("name").alias("kunya_norm"))


#: Pages whose h1 opens an entry; what precedes the h1 belongs to the entry still open.
TITLE_PAGES = PG.PageLayout(page=None, noise=WEB_PAGES.noise, layers=WEB_PAGES.layers, markers=(PG.element("h1"),), marker_text=r"(?s)^\s*(.+?)\s*$")


@query("titled_entries", f"""
WITH m AS (SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host,
   {_sql_plain("regexp_replace(" + _sql_strip("html", _NOISE + _BLOCKS) + r", '(?is)<h1\b(?:\s[^>]*)?>(.*?)</h1\s*>', chr(1) || '\1' || chr(2), 'g')")} AS t FROM pages),
p AS (SELECT page_id, host, trim(split_part(t, chr(1), 1)) AS lead, trim(split_part(split_part(t, chr(1), 2), chr(2), 1)) AS title, trim(split_part(t, chr(2), 2)) AS body FROM m),
w AS (SELECT *, lead(lead) OVER (PARTITION BY host ORDER BY page_id) AS tail FROM p)
SELECT host, page_id AS entry_order, title, sha256(CASE WHEN coalesce(tail, '') <> '' THEN concat_ws(' ', nullif(body, ''), tail) ELSE body END) AS body_sha256 FROM w WHERE title <> ''""")
def titled_entries(spark, d):
    pages = PG.split_pages(spread(table(spark, d, "pages"), "page_id").withColumn("host", F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1))), "html", TITLE_PAGES)
    bodies = PG.entry_bodies(PG.entry_parts(pages, "host", "page_id", layout=TITLE_PAGES), "host")
    return bodies.select("host", "entry_order", F.col("number").alias("title"), F.sha2("body", 256).alias("body_sha256"))
