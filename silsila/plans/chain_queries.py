"""Queries over chains: positions, neighbours, edges, relations, resolution rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silsila import lexicon as lx
from silsila.functions import keys as K
from silsila.functions import text as T
from silsila.operators import audit as AU
from silsila.operators import blocking as B
from silsila.operators import chains as C
from silsila.operators import kinship as KIN
from silsila.operators import relations as RL
from silsila.operators import resolve as RS
from silsila.plans.bindings import ATOM, LINES, documents, flagged_pairs, line_atoms, line_nodes, named_line_nodes, supplier_index, supplier_years, table
from silsila.plans.registry import query
from silsila.plans.session import checkpointed
from silsila.sources.tables import upgrade_status, upsert

# -- positions and neighbours -------------------------------------------------------------


@query("positions", """
SELECT l_orderkey AS chain_id, l_linenumber AS sequence_index, count(*) AS atoms,
       CASE WHEN count(*) = 1 THEN min(l_suppkey) END AS supplier FROM lineitem GROUP BY 1, 2""")
def positions(spark: SparkSession, d: str) -> DataFrame:
    return C.positions(line_nodes(spark, d), ["supplier"]).drop("branch_hint")


@query("neighbours", f"""
WITH {LINES} SELECT x.c AS chain_id, x.q AS sequence_index, x.s AS supplier, p.s AS prev_supplier, f.s AS next_supplier
FROM single x LEFT JOIN single p ON p.c = x.c AND p.q = x.q - 1 LEFT JOIN single f ON f.c = x.c AND f.q = x.q + 1""")
def neighbours(spark, d):
    met = C.guarded_neighbours(line_nodes(spark, d), ["supplier"])
    return met.select("chain_id", "sequence_index", "supplier", "prev_supplier", "next_supplier")


@query("turn_neighbours", """
WITH t AS (SELECT conv_id, turn, role FROM conversations QUALIFY count(*) OVER (PARTITION BY conv_id, turn) = 1)
SELECT x.conv_id, x.turn, x.role, p.role AS prev_role, f.role AS next_role
FROM t x LEFT JOIN t p ON p.conv_id = x.conv_id AND p.turn = x.turn - 1 LEFT JOIN t f ON f.conv_id = x.conv_id AND f.turn = x.turn + 1""")
def turn_neighbours(spark, d):
    turns = table(spark, d, "conversations").select(
        F.col("conv_id").alias("chain_id"), F.lit(0).alias("branch_hint"), F.col("turn").alias("sequence_index"), "role")
    met = C.guarded_neighbours(turns, ["role"])
    return met.select(F.col("chain_id").alias("conv_id"), F.col("sequence_index").alias("turn"), "role", "prev_role", "next_role")


@query("chain_links", f"""
WITH {LINES},
g AS (SELECT c, count(*) - 1 AS total_links, sum(n)::BIGINT AS total_occurrences FROM pos GROUP BY 1),
r AS (SELECT l_orderkey AS c, sum((l_linestatus = 'F')::INT)::BIGINT AS resolved_occurrences FROM lineitem GROUP BY 1),
a AS (SELECT c, count(*) AS adjacent_links FROM adj GROUP BY 1)
SELECT g.c AS chain_id, total_occurrences, resolved_occurrences, total_links, coalesce(adjacent_links, 0) AS adjacent_links,
       total_links - coalesce(adjacent_links, 0) AS broken_links
FROM g JOIN r USING (c) LEFT JOIN a USING (c)""")
def chain_links(spark, d):
    occ = line_nodes(spark, d)
    pairs = C.adjacent_pairs(occ, ["occurrence_id"]).groupBy("chain_id").agg(F.count(F.lit(1)).alias("a"))
    rows = C.link_counts(occ).join(pairs, "chain_id", "left")
    a = F.coalesce("a", F.lit(0))
    return rows.select("chain_id", "total_occurrences", "resolved_occurrences", "total_links", a.alias("adjacent_links"),
                       (F.col("total_links") - a).alias("broken_links"))


def line_names(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as names, line status as occurrence type, return flag as term."""
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("chain_id"), F.lit(0).alias("branch_hint"), F.col("l_linenumber").alias("sequence_index"),
        F.col("l_suppkey").alias("normalized_name"), F.when(F.col("l_linestatus") == "F", "named_candidate").otherwise("relational_or_unknown").alias("occurrence_type"),
        F.col("l_returnflag").alias("transmission_term"))


_EDGES = """
n AS (SELECT l_orderkey AS c, l_linenumber AS q, l_suppkey AS nm, l_returnflag AS term,
             CASE l_linestatus WHEN 'F' THEN 'named_candidate' ELSE 'relational_or_unknown' END AS ty FROM lineitem),
p AS (SELECT a.c, a.q, a.nm AS from_name, b.nm AS to_name, a.ty AS from_type, b.ty AS to_type, b.term AS term
      FROM n a JOIN n b ON a.c = b.c AND b.q = a.q + 1 WHERE NOT (a.nm = b.nm AND a.ty = 'named_candidate'))"""


@query("observed_edges", f"""
WITH {_EDGES}
SELECT from_name, to_name, from_type, to_type, term, count(*) AS evidence_count, count(DISTINCT c) AS distinct_chain_count,
       count(DISTINCT o_custkey) AS distinct_source_count, (from_type <> 'named_candidate' OR to_type <> 'named_candidate')::INT AS needs_review
FROM p JOIN orders ON o_orderkey = c GROUP BY 1, 2, 3, 4, 5""")
def observed_edges(spark, d):
    chains = table(spark, d, "orders").select(F.col("o_orderkey").alias("chain_id"), F.col("o_custkey").alias("source_file_id"))
    return C.observed_edges(C.position_edges(line_names(spark, d)), chains)


@query("edge_evidence", f"""
WITH {_EDGES}, u AS (SELECT *, count(*) OVER (PARTITION BY c, q, from_name, to_name, from_type, to_type, term) AS e FROM p)
SELECT 'E_' || substr(sha256(concat_ws(chr(31), from_name::VARCHAR, to_name::VARCHAR, from_type, to_type, u.term)), 1, 20) AS edge_id,
       u.c AS chain_id, 0 AS branch_hint, u.q AS from_sequence, any_value(e) AS evidence_count, any_value(o_custkey) AS source_file_id,
       any_value(o_orderpriority) AS record_id, any_value(fc) AS from_count, any_value(tc) AS to_count
FROM u JOIN (SELECT c, q, nm, ty, count(*) AS fc FROM n GROUP BY ALL) f ON f.c = u.c AND f.q = u.q AND f.nm = from_name AND f.ty = from_type
JOIN (SELECT c, q, nm, ty, term, count(*) AS tc FROM n GROUP BY ALL) t ON t.c = u.c AND t.q = u.q + 1 AND t.nm = to_name AND t.ty = to_type AND t.term = u.term
JOIN orders ON o_orderkey = u.c GROUP BY u.c, u.q, from_name, to_name, from_type, to_type, u.term""")
def edge_evidence(spark, d):
    """Orders give each chain its source (customer) and record (priority)."""
    chains = table(spark, d, "orders").select(F.col("o_orderkey").alias("chain_id"), F.col("o_custkey").alias("source_file_id"), F.col("o_orderpriority").alias("record_id"))
    return C.edge_facts(C.position_edges(line_names(spark, d)), chains)


@query("support_thresholds", f"""
WITH {_EDGES}, e AS (SELECT from_type, to_type, count(DISTINCT c) AS k FROM p GROUP BY from_name, to_name, from_type, to_type, term)
SELECT count(*) AS edges, count(*) FILTER (WHERE k >= 2 AND from_type = 'named_candidate' AND to_type = 'named_candidate') AS in_2_chains,
       count(*) FILTER (WHERE k >= 5 AND from_type = 'named_candidate' AND to_type = 'named_candidate') AS in_5_chains FROM e""")
def support_thresholds(spark, d):
    chains = table(spark, d, "orders").select(F.col("o_orderkey").alias("chain_id"), F.col("o_custkey").alias("source_file_id"))
    return AU.support_thresholds(C.observed_edges(C.position_edges(line_names(spark, d)), chains))


@query("resolved_pairs", f"""
WITH {LINES} SELECT e1 AS student, e2 AS teacher, count(*) AS evidence_count, count(DISTINCT c) AS distinct_chain_count
FROM adj WHERE e1 IS NOT NULL AND e2 IS NOT NULL GROUP BY 1, 2""")
def resolved_pairs(spark, d):
    return C.resolved_pairs(line_nodes(spark, d))


# -- relations ------------------------------------------------------------------------------


def pair_evidence(spark: SparkSession, d: str) -> DataFrame:
    """R lines speak for the teacher list, A lines for the student list."""
    pairs = C.adjacent_pairs(line_nodes(spark, d), ["supplier", "flag"]).filter("from_flag > 0 AND from_supplier <> to_supplier")
    return pairs.select(F.col("from_supplier").alias("student"), F.col("to_supplier").alias("teacher"),
                        F.when(F.col("from_flag") == 2, "teacher_list").otherwise("student_list").alias("direction"))


_BILATERAL = """
bil AS (SELECT s1 AS student, s2 AS teacher, max((rf1 = 'R')::INT) AS te, max((rf1 = 'A')::INT) AS se
        FROM adj WHERE rf1 IN ('R', 'A') AND s1 <> s2 GROUP BY 1, 2),
bil2 AS (SELECT student, teacher, te AS teacher_list_evidence, se AS student_list_evidence,
         CASE WHEN te = 1 AND se = 1 THEN 'bilateral_reported' WHEN te = 1 THEN 'teacher_list_only' ELSE 'student_list_only' END AS status FROM bil)"""


@query("bilateral_relations", f"WITH {LINES}, {_BILATERAL} SELECT * FROM bil2")
def bilateral_relations(spark, d):
    return RL.reconcile(pair_evidence(spark, d))


_SEG = r"trim(regexp_replace({c}, '\s+', ' ', 'g'), ' ،؛;:.()-')"


@query("reported_lists", rf"""
WITH a AS (SELECT item_id, list_filter(string_split({_SEG.format(c="text")}, ' '), lambda x: x <> '') AS t FROM benchmark),
k AS (SELECT DISTINCT item_id, l, array_to_string(t[1:l], ' ') AS key FROM (SELECT item_id, t, unnest(range(2, least(6, len(t)) + 1)) AS l FROM a)),
uk AS (SELECT key, min(l) AS l, min(item_id) AS ent FROM k GROUP BY key HAVING count(DISTINCT item_id) = 1),
c AS (SELECT doc_id, 'teacher_list' AS direction, unnest(string_split(text, chr(10))) AS raw FROM documents
      UNION ALL SELECT doc_id, 'student_list', unnest(string_split_regex(text, '[.]')) FROM documents),
s AS (SELECT DISTINCT doc_id, direction, {_SEG.format(c="raw")} AS segment FROM c),
m AS (SELECT doc_id, direction, segment, ent, l FROM s JOIN uk ON starts_with(segment || ' ', key || ' ') WHERE length(segment) >= 3
      QUALIFY row_number() OVER (PARTITION BY doc_id, direction, segment ORDER BY l DESC) = 1)
SELECT CASE direction WHEN 'teacher_list' THEN doc_id ELSE ent END AS student, CASE direction WHEN 'teacher_list' THEN ent ELSE doc_id END AS teacher,
       direction, segment FROM m WHERE ent <> doc_id""")
def reported_lists(spark, d):
    docs = documents(spark, d).select("doc_id", "text")
    anchors = table(spark, d, "benchmark").select("item_id", T.normalize("text").alias("n"))

    def segments(marks):
        return F.filter(F.transform(F.split("text", marks), lambda s: T.normalize(s)), lambda s: F.length(s) >= 3)

    found = RL.reported_evidence(docs, "doc_id", segments("\n"), segments("[.]"), anchors, "item_id", "n")
    return found.select("student", "teacher", "direction", "segment")


# -- blocking joins ---------------------------------------------------------------------------


@query("unique_prefix_join", rf"""
WITH t AS (SELECT doc_id, list_filter(string_split({_SEG.format(c="substr(trim(split_part(text, '.', 1), ' ،؛;:.()-'), 1, 400)")}, ' '), lambda x: x <> '') AS t,
      {_SEG.format(c="split_part(split_part(text, '.', 1), ',', 1)")} AS name FROM documents),
k AS (SELECT DISTINCT doc_id, array_to_string(t[1:l], ' ') AS key FROM (SELECT doc_id, t, unnest(range(3, len(t) + 1)) AS l FROM t)),
u AS (SELECT key, min(doc_id) AS ent FROM k GROUP BY key HAVING count(DISTINCT doc_id) = 1)
SELECT doc_id, ent AS entity, name, 1.0::DOUBLE AS score FROM t JOIN u ON key = name WHERE len(string_split(name, ' ')) >= 3""")
def unique_prefix_join(spark, d):
    """Canonical names of the first sentences as entries, first clauses as the names to resolve."""
    docs = documents(spark, d)
    entries = docs.select("doc_id", T.normalize(T.canonical_name("text", sigla="^$", ends="[.]")).alias("n"))
    index = B.prefix_index(entries, "doc_id", "n", 3, None)
    occ = docs.select("doc_id", T.normalize(F.substring_index(F.substring_index("text", ".", 1), ",", 1)).alias("name"))
    named = occ.filter(F.size(K.tokens("name")) >= 3)
    return RS.resolve_unique_names(named, index.select("key", "entity")).select("doc_id", "entity", "name", "score")


_LPM = """
e AS (SELECT p_partkey AS ent, string_split(CASE WHEN p_size % 5 = 0 THEN p_name ELSE p_name || ' ' || p_brand || ' ' || p_type END, ' ') AS t FROM part),
k AS (SELECT DISTINCT ent, l, len(t) AS size, array_to_string(t[1:l], ' ') AS key FROM (SELECT ent, t, unnest(range(2, least(7, len(t)) + 1)) AS l FROM e)),
p AS (SELECT p_partkey AS probe, string_split(p_name || ' ' || CASE WHEN p_size % 2 = 0 THEN 'Brand#1 ' || p_type ELSE p_brand || ' NONE' END, ' ') AS t FROM part),
pk AS (SELECT probe, l, len(t) AS psize, array_to_string(t[1:l], ' ') AS key FROM (SELECT probe, t, unnest(range(2, least(6, len(t)) + 1)) AS l FROM p)),
h AS (SELECT probe, pk.l, psize, size, ent FROM pk JOIN k USING (key))"""


def part_names(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(entities, probes): names of two or four tokens, and names to look up."""
    part = table(spark, d, "part")
    full = F.when(F.col("p_size") % 5 == 0, F.col("p_name")).otherwise(F.concat_ws(" ", "p_name", "p_brand", "p_type"))
    asked = F.concat_ws(" ", "p_name", F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Brand#1 "), "p_type")).otherwise(F.concat("p_brand", F.lit(" NONE"))))
    return part.select(F.col("p_partkey").alias("entity"), full.alias("n")), part.select(F.col("p_partkey").alias("probe"), asked.alias("n"))


@query("longest_prefix_join", f"""
WITH {_LPM}, b AS (SELECT probe, l, count(DISTINCT ent) AS n, min(ent) AS ent FROM h GROUP BY 1, 2
      QUALIFY row_number() OVER (PARTITION BY probe ORDER BY l DESC) = 1)
SELECT probe, ent AS entity, l::INT AS matched_len FROM b WHERE n = 1""")
def longest_prefix_join(spark, d):
    entities, probes = part_names(spark, d)
    return B.longest_prefix_match(probes, "probe", "n", B.prefix_index(entities, "entity", "n", 2, 7), 2, 6)


@query("compatible_prefix_join", f"""
WITH {_LPM}, b AS (SELECT probe, l, count(DISTINCT ent) AS n, min(ent) AS ent FROM h
      WHERE l >= 3 OR psize = l OR size = l GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY probe ORDER BY l DESC) = 1)
SELECT probe, ent AS entity, l::INT AS matched_len FROM b WHERE n = 1""")
def compatible_prefix_join(spark, d):
    entities, probes = part_names(spark, d)
    sizes = entities.select("entity", F.size(K.tokens("n")).alias("size"))
    index = B.prefix_index(entities, "entity", "n", 2, 7).join(sizes, "entity")
    return B.longest_prefix_match(probes, "probe", "n", index, 2, 6, exact_short=True)


@query("name_match_or", """
WITH e AS (SELECT p_partkey AS entity, p_brand AS s, p_name AS l FROM part),
n AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT DISTINCT p_brand FROM part),
h AS (SELECT name, entity, CASE WHEN s = name THEN 'exact_short' ELSE 'exact_long' END AS match_method FROM n JOIN e ON s = name OR l = name)
SELECT name, entity, match_method, CASE WHEN count(*) OVER (PARTITION BY name) = 1 THEN 'unique_exact' ELSE 'ambiguous_exact' END AS match_status FROM h""")
def name_match_or(spark, d):
    part = table(spark, d, "part")
    names = part.select(F.col("p_name").alias("normalized_name")).unionByName(part.select(F.col("p_brand").alias("normalized_name")))
    return B.match_either(names, part, entity="p_partkey", short="p_brand", long="p_name")


@query("legacy_counts", """
SELECT p_name AS name, p_partkey AS entry, count(*) OVER (PARTITION BY p_name) AS candidate_count FROM part""")
def legacy_counts(spark, d):
    part = table(spark, d, "part")
    return B.label_candidates(part, part, "p_name", "p_name", "p_partkey")


@query("unique_number_link", """
WITH r AS (SELECT floor(c_acctbal / 5)::BIGINT AS number, count(*) AS n, min(c_custkey) AS c_custkey FROM customer GROUP BY 1)
SELECT s_suppkey, number, c_custkey FROM supplier JOIN r ON floor(s_acctbal / 5)::BIGINT = number WHERE n = 1""")
def unique_number_link(spark, d):
    left = table(spark, d, "supplier").select("s_suppkey", F.floor(F.col("s_acctbal") / 5).cast("long").alias("number"))
    right = table(spark, d, "customer").select("c_custkey", F.floor(F.col("c_acctbal") / 5).cast("long").alias("number"))
    return B.unique_number_link(left, right, "s_suppkey", "c_custkey", "number")


@query("unresolved_anti", """
SELECT d.doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def unresolved_anti(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return docs.join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


# -- resolution rules --------------------------------------------------------------------------


def open_lines(spark: SparkSession, d: str) -> DataFrame:
    """Unresolved positions. The rules read them several times, so they are written once."""
    return checkpointed(RS.open_positions(named_line_nodes(spark, d)))


def supplier_relations(spark: SparkSession, d: str) -> DataFrame:
    return flagged_pairs(spark, d, 2)


def _graph(spark, d, run):
    judge = RS.judge_graph(RS.plain_index(supplier_index(spark, d)), supplier_relations(spark, d))
    found = run(RS.open_positions(named_line_nodes(spark, d)), judge)
    return found.select("chain_id", "sequence_index", "entity", "score", "pass_no")


def _graph_pass(n: int) -> str:
    """One unrolled pass: state tN has the entities known after pass N."""
    return f"""
h{n} AS (SELECT x.c, x.q, x.nm, p.ent AS prev, f.ent AS nxt FROM t{n - 1} x JOIN t{n - 1} p ON p.c = x.c AND p.q = x.q - 1
         JOIN t{n - 1} f ON f.c = x.c AND f.q = x.q + 1 WHERE x.ent IS NULL AND p.ent IS NOT NULL AND f.ent IS NOT NULL),
r{n} AS (SELECT c, q, min(s_suppkey) AS ent FROM h{n} JOIN rel a ON a.st = prev JOIN supplier ON s_suppkey = a.te AND s_nationkey = nm
         JOIN rel b ON b.st = s_suppkey AND b.te = nxt GROUP BY 1, 2 HAVING count(*) = 1),
t{n} AS (SELECT x.c, x.q, x.nm, coalesce(x.ent, r{n}.ent) AS ent FROM t{n - 1} x LEFT JOIN r{n} ON r{n}.c = x.c AND r{n}.q = x.q)"""


def _graph_sql(passes: int) -> str:
    unrolled = ",".join(_graph_pass(n) for n in range(1, passes + 1))
    union = " UNION ALL ".join(f"SELECT c AS chain_id, q AS sequence_index, ent AS entity, 7 AS score, {n} AS pass_no FROM r{n}" for n in range(1, passes + 1))
    return f"WITH {LINES}, t0 AS (SELECT c, q, nm, ent FROM single),{unrolled} {union}"


@query("graph_resolve_pass", _graph_sql(1))
def graph_resolve_pass(spark, d):
    return _graph(spark, d, RS.one_pass)


@query("graph_resolve_fixpoint", _graph_sql(7))
def graph_resolve_fixpoint(spark, d):
    return _graph(spark, d, RS.neighbour_passes)


_QUEUE = """
yr AS (SELECT l_suppkey AS e, min(year(l_shipdate)) AS b, max(year(l_shipdate)) AS d FROM lineitem GROUP BY 1),
cand AS (SELECT h.c, h.q, s_suppkey AS candidate, 1.0 AS ns, CASE WHEN r1.te IS NOT NULL THEN 3.0 ELSE 0 END AS ps,
         CASE WHEN r2.st IS NOT NULL THEN 3.0 ELSE 0 END AS xs,
         (CASE WHEN y.b > py.d THEN -4.0 ELSE 0 END) + (CASE WHEN ny.b > y.d THEN -4.0 ELSE 0 END) AS pen
  FROM hidden h JOIN supplier ON s_nationkey = h.nm LEFT JOIN rel r1 ON r1.st = h.prev AND r1.te = s_suppkey
  LEFT JOIN rel r2 ON r2.st = s_suppkey AND r2.te = h.nxt
  LEFT JOIN yr y ON y.e = s_suppkey LEFT JOIN yr py ON py.e = h.prev LEFT JOIN yr ny ON ny.e = h.nxt),
tot AS (SELECT *, ns + ps + xs + pen AS total FROM cand)"""


@query("candidate_queue", f"""
WITH {LINES}, {_QUEUE}
SELECT DISTINCT h.nm AS name, h.prev, h.nxt AS next, candidate, ns::DOUBLE AS name_score, ps::DOUBLE AS prev_score, xs::DOUBLE AS next_score,
       pen::DOUBLE AS penalty, total::DOUBLE AS total_score FROM tot JOIN hidden h ON h.c = tot.c AND h.q = tot.q WHERE ps + xs > 0""")
def candidate_queue(spark, d):
    return RS.queue_candidates(open_lines(spark, d), supplier_index(spark, d), supplier_relations(spark, d), supplier_years(spark, d))


@query("candidate_blocks", f"""
WITH {LINES} SELECT DISTINCT nm AS name, s_suppkey AS candidate, 'candidate' AS status FROM hidden JOIN supplier ON s_nationkey = nm""")
def candidate_blocks(spark, d):
    return RS.candidate_blocks(open_lines(spark, d), supplier_index(spark, d))


@query("candidate_coverage", f"""
WITH {LINES}, {_QUEUE},
full_rows AS (SELECT DISTINCT h.nm AS name, h.prev, h.nxt, candidate, ps + xs > 0 AS told FROM tot JOIN hidden h ON h.c = tot.c AND h.q = tot.q),
ctx AS (SELECT name, count(*) AS contexts FROM (SELECT DISTINCT name, prev, nxt FROM full_rows) GROUP BY 1)
SELECT name, contexts, count(DISTINCT candidate) AS block_size, count(*) FILTER (told) AS supported, count(*) AS enumerated,
       count(*) FILTER (NOT told) AS by_block FROM full_rows JOIN ctx USING (name) GROUP BY 1, 2""")
def candidate_coverage(spark, d):
    """Supported rows and blocks together stand for the full enumeration."""
    opened, index = open_lines(spark, d), supplier_index(spark, d)
    rows = RS.queue_candidates(opened, index, supplier_relations(spark, d), supplier_years(spark, d))
    return RS.candidate_coverage(opened, RS.candidate_blocks(opened, index), rows)


_SPAN = """
yr AS (SELECT s_suppkey AS e, 100 + s_suppkey % 7 AS b, 104 + s_suppkey % 5 AS d FROM supplier)"""


def supplier_spans(spark: SparkSession, d: str) -> DataFrame:
    """Short overlapping life spans, so that chronology penalties really occur."""
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("entity"), (100 + F.col("s_suppkey") % 7).alias("birth_year"), (104 + F.col("s_suppkey") % 5).alias("death_year"))


@query("queue_recommendation", f"""
WITH {LINES}, {_SPAN}, {_QUEUE[_QUEUE.index("cand AS"):]},
rk AS (SELECT *, row_number() OVER w AS rn, lead(total) OVER w AS run, count(*) OVER (PARTITION BY c, q) AS n FROM tot
       WINDOW w AS (PARTITION BY c, q ORDER BY total DESC, candidate))
SELECT c AS chain_id, q AS sequence_index, n AS candidate_count, candidate AS top_entity, total::DOUBLE AS top_score, run::DOUBLE AS runner_up_score,
       (n = 1 OR (run IS NOT NULL AND total > run))::INT AS top_is_unique,
       CASE WHEN n = 1 AND total >= 5 THEN 'unique_candidate_high' WHEN total >= 6 AND (run IS NULL OR total >= run + 2) THEN 'unique_top_strong'
            WHEN total >= 4 AND (run IS NULL OR total > run) THEN 'unique_top_review' ELSE 'ambiguous' END AS recommendation
FROM rk WHERE rn = 1""")
def queue_recommendation(spark, d):
    opened, index, years = open_lines(spark, d), supplier_index(spark, d), supplier_spans(spark, d)
    rows = checkpointed(RS.queue_candidates(opened, index, supplier_relations(spark, d), years))
    out = RS.queue_summary(opened, rows, index, years)
    return out.select("chain_id", "sequence_index", "candidate_count", "top_entity", "top_score", "runner_up_score", "top_is_unique", "recommendation")


def supplier_word():
    """The name of a supplier as one word; the key is part of it, because names may repeat."""
    return F.concat_ws("#", F.regexp_replace("s_name", r"\s+", "_"), "s_suppkey")


def supplier_lists(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(students, teachers): list texts per supplier card from the A lines, one row per entry."""
    names = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    names = names.select(F.col("s_suppkey").alias("node"), F.concat_ws(" ", supplier_word(), "n_name").alias("text"))
    pairs = checkpointed(flagged_pairs(spark, d, 1))   # feeds two to four lookups
    students = pairs.select(F.col("teacher").alias("card"), F.col("student").alias("node")).join(names, "node")
    teachers = pairs.select(F.col("student").alias("card"), F.col("teacher").alias("node")).join(names, "node")
    return students.select("card", "text"), teachers.select("card", "text")


@query("list_context", f"""
WITH {LINES},
sz AS (SELECT s_nationkey AS nm, count(*) AS candidate_count FROM supplier GROUP BY 1 HAVING count(*) > 1),
li AS (SELECT DISTINCT a.te AS card, a.st AS node, s.s_nationkey AS nat, 'st' AS side FROM rel_a a JOIN supplier s ON s.s_suppkey = a.st
       UNION SELECT DISTINCT a.st, a.te, s.s_nationkey, 'te' FROM rel_a a JOIN supplier s ON s.s_suppkey = a.te),
ctx AS (SELECT h.*, ps.s_nationkey AS pnat, ns.s_nationkey AS nnat FROM hidden h LEFT JOIN supplier ps ON ps.s_suppkey = h.prev
        LEFT JOIN supplier ns ON ns.s_suppkey = h.nxt),
sc AS (SELECT c, q, nm, s_suppkey AS cand,
  CASE WHEN EXISTS (SELECT 1 FROM li WHERE side = 'st' AND card = s_suppkey AND node = prev) THEN 3
       WHEN EXISTS (SELECT 1 FROM li WHERE side = 'st' AND card = s_suppkey AND nat = pnat) THEN 2 ELSE 0 END
 + CASE WHEN EXISTS (SELECT 1 FROM li WHERE side = 'te' AND card = s_suppkey AND node = nxt) THEN 3
       WHEN EXISTS (SELECT 1 FROM li WHERE side = 'te' AND card = s_suppkey AND nat = nnat) THEN 2 ELSE 0 END AS score
  FROM ctx JOIN supplier ON s_nationkey = nm),
rk AS (SELECT *, row_number() OVER w AS rn, coalesce(lead(score) OVER w, 0) AS runner_up FROM sc WHERE score > 0 WINDOW w AS (PARTITION BY c, q ORDER BY score DESC, cand))
SELECT c AS chain_id, q AS sequence_index, cand AS entity, score, runner_up, candidate_count FROM rk JOIN sz USING (nm)
WHERE rn = 1 AND score >= 5 AND score > runner_up""")
def list_context(spark, d):
    students, teachers = supplier_lists(spark, d)
    sup = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    names = sup.select(F.col("s_suppkey").alias("id"), supplier_word().alias("raw"), F.col("n_name").alias("canon"))
    # raw and canonical keys are looked up together; the first letter of the node tells them apart
    keys = names.select(F.explode(F.array(*[
        F.struct(F.concat(F.lit(letter), c).alias("node"), F.col(c).alias("key")) for letter, c in (("r", "raw"), ("c", "canon"))])).alias("k")).select("k.*")

    def edges(lists, prefix):
        found = RL.listed_nodes(lists, "card", "text", keys, 2)
        is_raw = F.col("node").startswith("r")
        return found.select(
            F.when(is_raw, prefix + "_raw").otherwise(prefix + "_canon").alias("node_kind"), F.expr("substring(node, 2)").alias("node"),
            F.col("card").alias("candidate"), F.when(is_raw, 3).otherwise(2).alias("weight"))

    opened = open_lines(spark, d)
    for side in ("prev", "next"):
        opened = opened.join(names.select(F.col("id").alias(side), F.col("raw").alias(side + "_raw"), F.col("canon").alias(side + "_canon")), side, "left")
    found = RS.resolve_list_context(opened, RS.plain_index(supplier_index(spark, d)), edges(students, "prev"), edges(teachers, "next"),
                                    ("prev_raw", "prev_canon"), ("next_raw", "next_canon"), ("prev_canon", "next_canon"))
    return found.select("chain_id", "sequence_index", "entity", "score", "runner_up", "candidate_count")


def card_edges(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Support edges from the source lists: node keys found in the students / teachers text."""
    students, teachers = supplier_lists(spark, d)
    keys = table(spark, d, "supplier").select(F.col("s_suppkey").alias("node"), supplier_word().alias("key"))

    def edges(lists, kind):
        return RL.listed_nodes(lists, "card", "text", keys, 2).select(
            F.lit(kind).alias("node_kind"), "node", F.col("card").alias("candidate"), F.lit(1).alias("weight"))

    return edges(students, "prev"), edges(teachers, "next")


_CARD = """
sc AS (SELECT c, q, s_suppkey AS cand, (EXISTS (SELECT 1 FROM rel_a WHERE te = s_suppkey AND st = prev))::INT AS ps,
              (EXISTS (SELECT 1 FROM rel_a WHERE st = s_suppkey AND te = nxt))::INT AS xs FROM hidden JOIN supplier ON s_nationkey = nm),
s2 AS (SELECT *, 2 + 3 * ps + 3 * xs AS score FROM sc),
rk AS (SELECT *, row_number() OVER w AS rn, lead(score) OVER w AS run FROM s2 WINDOW w AS (PARTITION BY c, q ORDER BY score DESC, cand))"""


@query("source_card_candidates", f"""
WITH {LINES}, {_CARD} SELECT DISTINCT nm AS name, prev, nxt AS next, cand AS candidate, ps AS prev_in_students, xs AS next_in_teachers, score,
       CASE WHEN ps + xs = 2 THEN 'two_sided' ELSE 'one_sided' END AS status FROM s2 JOIN hidden USING (c, q) WHERE ps + xs > 0""")
def source_card_candidates(spark, d):
    prev, nxt = card_edges(spark, d)
    return RS.source_card_candidates(open_lines(spark, d), RS.plain_index(supplier_index(spark, d)), prev, nxt)


@query("source_card_resolve", f"""
WITH {LINES}, {_CARD} SELECT c AS chain_id, q AS sequence_index, cand AS entity, score, ps AS prev_in_students, xs AS next_in_teachers
FROM rk WHERE rn = 1 AND ps + xs > 0 AND (run IS NULL OR score > run)""")
def source_card_resolve(spark, d):
    prev, nxt = card_edges(spark, d)
    opened = open_lines(spark, d)
    found = RS.resolve_source_cards(opened, RS.source_card_candidates(opened, RS.plain_index(supplier_index(spark, d)), prev, nxt))
    return found.select("chain_id", "sequence_index", "entity", "score", "prev_in_students", "next_in_teachers")


def supplier_texts(spark: SparkSession, d: str) -> DataFrame:
    """Identity texts whose tokens make names of all scores: nation digits, region, supplier."""
    sup = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    text = F.when(F.col("s_suppkey") % 3 == 0, F.col("n_name")).when(F.col("s_suppkey") % 3 == 1, F.concat_ws(" ", "n_name", "s_name")).otherwise(
        F.concat_ws(" ", "s_name", "n_name"))
    return sup.select(F.col("s_suppkey").alias("entity"), text.alias("identity_norm"), F.col("n_name").alias("name"))


_SPEC_SCORE = "CASE s_suppkey % 3 WHEN 0 THEN 10 WHEN 1 THEN 9 ELSE 7 END"


def _spec_pass(n: int) -> str:
    return f"""
h{n} AS (SELECT x.c, x.q, x.nm, p.ent AS prev, f.ent AS nxt FROM u{n - 1} x LEFT JOIN u{n - 1} p ON p.c = x.c AND p.q = x.q - 1
         LEFT JOIN u{n - 1} f ON f.c = x.c AND f.q = x.q + 1 WHERE x.ent IS NULL),
k{n} AS (SELECT c, q, s_suppkey AS cand, {_SPEC_SCORE} AS ns, (a.st IS NOT NULL)::INT AS ps, (b.st IS NOT NULL)::INT AS xs
         FROM h{n} JOIN supplier ON s_nationkey = nm LEFT JOIN rel_a a ON a.st = prev AND a.te = s_suppkey LEFT JOIN rel_a b ON b.st = s_suppkey AND b.te = nxt),
m{n} AS (SELECT *, ns + 5 * ps + 5 * xs AS total, ps + xs AS sides FROM k{n}),
b{n} AS (SELECT *, row_number() OVER w AS rn, coalesce(lead(total) OVER w, -99) AS run, count(*) OVER (PARTITION BY c, q) AS n FROM m{n}
         WINDOW w AS (PARTITION BY c, q ORDER BY total DESC, sides DESC, ns DESC, cand DESC)),
r{n} AS (SELECT c, q, cand AS ent, total, CASE WHEN sides >= 2 AND total >= 17 AND total >= run + 2 THEN 'two_sided_specific_context'
           WHEN sides >= 1 AND ns >= 8 AND total >= 13 AND total >= run + 3 THEN 'strong_name_specific_context'
           WHEN n = 1 AND ns >= 9 AND sides >= 1 THEN 'unique_card_specific_context' END AS method FROM b{n} WHERE rn = 1),
u{n} AS (SELECT x.c, x.q, x.nm, coalesce(x.ent, r{n}.ent) AS ent FROM u{n - 1} x LEFT JOIN r{n} ON r{n}.c = x.c AND r{n}.q = x.q AND method IS NOT NULL)"""


@query("specific_context", f"WITH {LINES}, u0 AS (SELECT c, q, nm, ent FROM single),{','.join(_spec_pass(n) for n in range(1, 7))} " + " UNION ALL ".join(
    f"SELECT c AS chain_id, q AS sequence_index, ent AS entity, method, total AS score, {n} AS pass_no FROM r{n} WHERE method IS NOT NULL" for n in range(1, 7)))
def specific_context(spark, d):
    cards = supplier_texts(spark, d)
    names = cards.select("entity", "name")
    index = B.name_index(cards, names, lineage="of", kunya="abu", max_tokens=2).withColumnRenamed("entity", "candidate")
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("name"), F.col("n_name"))
    opened = RS.open_positions(named_line_nodes(spark, d)).join(nation, "name").drop("name").withColumnRenamed("n_name", "name")
    prev, nxt = card_edges(spark, d)
    found = RS.neighbour_passes(opened, RS.judge_specific(index, prev, nxt))
    return found.select("chain_id", "sequence_index", "entity", "method", "score", "pass_no")


_ALIAS = """
al AS (SELECT s_nationkey * 10 + s_suppkey % 10 AS alias, count(*) AS n, min(s_suppkey) AS ent FROM supplier GROUP BY 1),
hs AS (SELECT h.*, h.nm * 10 + h.s % 10 AS alias FROM hidden h),
su AS (SELECT c, q, al.ent, (a.st IS NOT NULL)::INT AS p, (b.st IS NOT NULL)::INT AS x FROM hs JOIN al ON al.alias = hs.alias AND n = 1
       LEFT JOIN rel a ON a.st = prev AND a.te = al.ent LEFT JOIN rel b ON b.st = al.ent AND b.te = nxt)"""


_NAMED = """
x AS (SELECT s_suppkey AS entity, s_name || ' of ' || n_name AS t1, n_name || ' ' || r_name || ' of ' || s_name AS t2, s_name, n_name, r_name
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
wanted AS (SELECT n_name AS name FROM x UNION SELECT 'of ' || n_name FROM x UNION SELECT s_name FROM x UNION SELECT r_name FROM x
           UNION SELECT n_name || ' ' || r_name FROM x UNION SELECT r_name || ' of' FROM x UNION SELECT 'of ' || s_name FROM x UNION SELECT t1 FROM x),
txt AS (SELECT entity, string_split(t, ' ') AS t, list_distinct([split_part(t1, ' ', 1), split_part(t2, ' ', 1)]) AS heads
        FROM (SELECT entity, t1, t2, unnest([t1, t2]) AS t FROM x)),
spots AS (SELECT entity, t, heads, len(t) AS n, unnest(range(len(t))) AS pos FROM txt),
runs AS (SELECT entity, heads, n, pos, l, array_to_string(t[pos + 1:pos + l], ' ') AS name FROM (SELECT *, unnest(range(1, n - pos + 1)) AS l FROM spots)),
hit AS (SELECT name, entity, n, l, min(pos) AS pos FROM runs JOIN wanted USING (name)
        WHERE list_contains(heads, split_part(name, ' ', 1)) OR (l = 1 AND length(name) >= 3) OR (split_part(name, ' ', 1) = 'of' AND length(split_part(name, ' ', 2)) >= 3)
        GROUP BY 1, 2, 3, 4),
sc AS (SELECT name, entity, CASE WHEN pos = 0 AND l = n THEN 10 WHEN pos = 0 THEN 9 WHEN split_part(name, ' ', 1) = 'of' AND pos = 1 THEN 8
              WHEN pos <= 1 THEN 7 WHEN pos <= 3 THEN 5 ELSE 2 END AS s FROM hit
       UNION ALL SELECT r_name, entity, 9 FROM x WHERE entity % 5 = 0)"""


@query("name_index_two_texts", f"WITH {_NAMED} SELECT name, entity, max(s)::INT AS name_score FROM sc GROUP BY 1, 2")
def name_index_two_texts(spark, d):
    """Cards with an identity and a second heading; every fifth supplier also has its region as an alias."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sup = checkpointed(table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", "n_name", "r_name"))
    first = F.concat_ws(" ", "s_name", F.lit("of"), "n_name")
    cards = sup.select(F.col("s_suppkey").alias("entity"), first.alias("identity_norm"), F.concat_ws(" ", "n_name", "r_name", F.lit("of"), "s_name").alias("sec"))
    names = sup.select(F.explode(F.array("n_name", F.concat_ws(" ", F.lit("of"), "n_name"), "s_name", "r_name", F.concat_ws(" ", "n_name", "r_name"),
                                         F.concat_ws(" ", "r_name", F.lit("of")), F.concat_ws(" ", F.lit("of"), "s_name"), first)).alias("name"))
    aliases = sup.filter("s_suppkey % 5 = 0").select(F.col("r_name").alias("name"), F.col("s_suppkey").alias("entity"))
    return B.name_index(cards, names, texts=("identity_norm", "sec"), lineage="of", kunya="abu", aliases=aliases)


@query("alias_resolve", f"""
WITH {LINES}, {_ALIAS} SELECT c AS chain_id, q AS sequence_index, ent AS entity, p AS prev_relation, x AS next_relation, p + x AS support,
       CASE WHEN p + x = 2 THEN 'strong_alias_two_sided' ELSE 'strong_alias_one_sided' END AS status, CASE WHEN p + x = 2 THEN 6 ELSE 5 END AS score
FROM su WHERE p + x >= 1""")
def alias_resolve(spark, d):
    """The alias of a supplier: nation and last digit, shared by some suppliers."""
    alias = (F.col("s_nationkey") * 10 + F.col("s_suppkey") % 10).alias("name")
    sup = table(spark, d, "supplier").select(F.col("s_suppkey").alias("supplier"), alias)
    occ = line_nodes(spark, d).join(sup, "supplier")
    unique = B.unique_keys(sup.select("name", F.col("supplier").alias("entity")), "name")
    found = RS.resolve_with_support(RS.open_positions(occ), unique, supplier_relations(spark, d), "strong_alias_two_sided", "strong_alias_one_sided")
    return found.select("chain_id", "sequence_index", "entity", "prev_relation", "next_relation", "support", "status", "score")


@query("trusted_alias_resolve", f"""
WITH {LINES}, al AS (SELECT s_nationkey * 10 + s_suppkey % 10 AS alias, count(*) AS n, min(s_suppkey) AS ent FROM supplier GROUP BY 1),
tr AS (SELECT c, q, nm * 10 + s % 10 AS alias, CASE WHEN ls = 'F' AND rf IN ('A', 'R') THEN s END AS ent FROM single),
su AS (SELECT x.c, x.q, al.ent, (a.st IS NOT NULL)::INT AS p, (b.st IS NOT NULL)::INT AS x FROM tr x JOIN al ON al.alias = x.alias AND n = 1
       LEFT JOIN tr pv ON pv.c = x.c AND pv.q = x.q - 1 LEFT JOIN tr nx ON nx.c = x.c AND nx.q = x.q + 1
       LEFT JOIN rel a ON a.st = pv.ent AND a.te = al.ent LEFT JOIN rel b ON b.st = al.ent AND b.te = nx.ent WHERE x.ent IS NULL)
SELECT c AS chain_id, q AS sequence_index, ent AS entity, p + x AS support, CASE WHEN p + x = 2 THEN 6 ELSE 5 END AS score FROM su WHERE p + x >= 1""")
def trusted_alias_resolve(spark, d):
    """The alias rule where only resolutions of listed statuses count; N lines have a status that is not on the list."""
    occ = line_nodes(spark, d)
    status = F.when(F.col("flag") == 1, "provisional_anchor").when(F.col("flag") == 2, "strong_context").otherwise("review")
    resolved = C.guarded_neighbours(occ, ["occurrence_id", "entity", "flag"], sides=()).filter("entity IS NOT NULL").withColumn("layer", status)
    held = RS.trusted(resolved, lx.TRUSTED_STATUSES).select("occurrence_id", "entity")
    alias = table(spark, d, "supplier").select(F.col("s_suppkey").alias("supplier"), (F.col("s_nationkey") * 10 + F.col("s_suppkey") % 10).alias("name"))
    opened = RS.open_positions(occ.drop("entity").join(held, "occurrence_id", "left").join(alias, "supplier"))
    unique = B.unique_keys(alias.select("name", F.col("supplier").alias("entity")), "name")
    found = RS.resolve_with_support(opened, unique, supplier_relations(spark, d), "two", "one")
    return found.select("chain_id", "sequence_index", "entity", "support", "score")


@query("prefix_resolve", f"""
WITH {LINES}, px AS (SELECT s_suppkey, 'S ' || n_name || ' ' || left(s_suppkey::VARCHAR, 1) || ' ' || s_suppkey AS nm FROM supplier JOIN nation ON s_nationkey = n_nationkey),
un AS (SELECT array_to_string(string_split(nm, ' ')[1:3], ' ') AS k, min(s_suppkey) AS ent FROM px GROUP BY 1 HAVING count(*) = 1),
hs AS (SELECT h.*, array_to_string(string_split(px.nm, ' ')[1:3], ' ') AS k FROM hidden h JOIN px ON px.s_suppkey = h.s),
su AS (SELECT c, q, un.ent, (a.st IS NOT NULL)::INT AS p, (b.st IS NOT NULL)::INT AS x FROM hs JOIN un USING (k)
       LEFT JOIN rel a ON a.st = prev AND a.te = un.ent LEFT JOIN rel b ON b.st = un.ent AND b.te = nxt)
SELECT c AS chain_id, q AS sequence_index, ent AS entity, p + x AS support, CASE WHEN p + x = 2 THEN 6 ELSE 5 END AS score FROM su WHERE p + x >= 1""")
def prefix_resolve(spark, d):
    """Names are three-token prefixes of four-token canonical names."""
    sup = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    full = F.concat_ws(" ", F.lit("S"), "n_name", F.substring(F.col("s_suppkey").cast("string"), 1, 1), "s_suppkey")
    cards = sup.select(F.col("s_suppkey").alias("supplier"), full.alias("full"))
    unique = B.unique_keys(B.prefix_index(cards, "supplier", "full", 3, 7)).select(F.col("key").alias("name"), "entity")
    occ = line_nodes(spark, d).join(cards.select("supplier", F.substring_index("full", " ", 3).alias("name")), "supplier")
    found = RS.resolve_with_support(RS.open_positions(occ), unique, supplier_relations(spark, d), "strong_prefix_two_sided", "strong_prefix_one_sided")
    return found.select("chain_id", "sequence_index", "entity", "support", "score")


def signature_rows(spark: SparkSession, d: str) -> DataFrame:
    """Regions as entities, nations as names: signatures then really repeat."""
    sup = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    sup = sup.select(F.col("s_suppkey").alias("supplier"), F.col("n_nationkey").alias("name"), F.col("n_regionkey").alias("region"))
    occ = line_nodes(spark, d).join(sup, "supplier").withColumn("entity", F.when(F.col("resolved") == 1, F.col("region")))
    met = C.guarded_neighbours(occ, ["occurrence_id", "name", "entity"])
    return met.withColumnRenamed("prev_entity", "prev").withColumnRenamed("next_entity", "next")


@query("signature_propagate", """
WITH pos AS (SELECT l_orderkey AS c, l_linenumber AS q, min(l_suppkey) AS s, min(l_linestatus) AS ls FROM lineitem GROUP BY 1, 2 HAVING count(*) = 1),
sg AS (SELECT c, q, n_nationkey AS nm, CASE WHEN ls = 'F' THEN n_regionkey END AS ent FROM pos JOIN supplier ON s_suppkey = s JOIN nation ON n_nationkey = s_nationkey),
hd AS (SELECT x.*, p.ent AS prev, f.ent AS nxt FROM sg x JOIN sg p ON p.c = x.c AND p.q = x.q - 1 JOIN sg f ON f.c = x.c AND f.q = x.q + 1
       WHERE p.ent IS NOT NULL AND f.ent IS NOT NULL),
k AS (SELECT prev, nm, nxt, min(ent) AS e, count(*) AS support FROM hd WHERE ent IS NOT NULL GROUP BY 1, 2, 3 HAVING min(ent) = max(ent) AND count(*) >= 2)
SELECT c AS chain_id, q AS sequence_index, e AS entity, support FROM hd JOIN k USING (prev, nm, nxt) WHERE ent IS NULL""")
def signature_propagate(spark, d):
    return RS.propagate_signatures(signature_rows(spark, d)).select("chain_id", "sequence_index", "entity", "support")


def layers(spark: SparkSession, d: str) -> list[tuple[str, DataFrame]]:
    """Map of resolved lines (those of group positions too), then the alias rule, then the card rule. The neighbours are
    found once for both rules and for the relations they ask."""
    known = line_atoms(spark, d).filter("entity IS NOT NULL").select("occurrence_id", "entity", F.lit(1).alias("score"))
    met = checkpointed(C.guarded_neighbours(line_nodes(spark, d), ["occurrence_id", "supplier", "entity"]))
    open_ = met.filter("entity IS NULL").select(*C.POSITION, "occurrence_id", "supplier", F.col("prev_entity").alias("prev"), F.col("next_entity").alias("next"))
    sup = table(spark, d, "supplier")
    prev, nxt = card_edges(spark, d)
    opened = open_.join(sup.select(F.col("s_suppkey").alias("supplier"), F.col("s_nationkey").alias("name")), "supplier")
    cards = RS.resolve_source_cards(opened, RS.source_card_candidates(opened, RS.plain_index(supplier_index(spark, d)), prev, nxt))
    alias = sup.select(F.col("s_suppkey").alias("supplier"), (F.col("s_nationkey") * 10 + F.col("s_suppkey") % 10).alias("name"))
    unique = B.unique_keys(alias.select("name", F.col("supplier").alias("entity")), "name")
    named = RS.resolve_with_support(open_.join(alias, "supplier"), unique, supplier_relations(spark, d), "two", "one")
    return [("known", known), ("alias", named), ("source_card", cards)]


_LAYERS = f"""
{_ALIAS}, {_CARD},
ly AS (SELECT id AS occurrence_id, ent AS entity, 1 AS score, 'known' AS layer, 0 AS r FROM atoms WHERE ent IS NOT NULL
   UNION ALL SELECT c * 8 + q, ent, CASE WHEN p + x = 2 THEN 6 ELSE 5 END, 'alias', 1 FROM su WHERE p + x >= 1
   UNION ALL SELECT c * 8 + q, cand, score, 'source_card', 2 FROM rk WHERE rn = 1 AND ps + xs > 0 AND (run IS NULL OR score > run)),
won AS (SELECT occurrence_id, entity, score, layer FROM ly QUALIFY row_number() OVER (PARTITION BY occurrence_id ORDER BY r) = 1)"""


@query("precedence_union", f"WITH {LINES}, {_LAYERS} SELECT * FROM won")
def precedence_union(spark, d):
    return RS.precedence_union(layers(spark, d))


@query("upsert_status", """
WITH t AS (SELECT doc_id AS k, quality, CASE WHEN toxic = 1 THEN 'candidate_only' WHEN quality = 1 THEN 'strong' END AS status FROM labels),
n AS (SELECT doc_id AS k, CASE WHEN lang = 'en' THEN 8 ELSE 9 END AS quality, 'strong' AS status FROM documents),
up AS (SELECT * FROM t WHERE k NOT IN (SELECT k FROM n WHERE k NOT IN (SELECT k FROM t WHERE status IS DISTINCT FROM 'candidate_only'))
       UNION ALL SELECT * FROM n WHERE k NOT IN (SELECT k FROM t WHERE status IS DISTINCT FROM 'candidate_only')),
l AS (SELECT doc_id AS k, 7 AS quality, 'last' AS status FROM documents WHERE lang = 'fr')
SELECT * FROM up WHERE k NOT IN (SELECT k FROM l) UNION ALL SELECT * FROM l""")
def upsert_status(spark, d):
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("k"), "quality", F.when(F.col("toxic") == 1, "candidate_only").when(F.col("quality") == 1, "strong").alias("status"))
    docs = table(spark, d, "documents")
    news = docs.select(F.col("doc_id").alias("k"), F.lit(9).alias("quality"), F.lit("strong").alias("status"))
    # a second new row for some keys: the one with the smaller quality is taken
    news = news.unionByName(docs.filter("lang = 'en'").select(F.col("doc_id").alias("k"), F.lit(8).alias("quality"), F.lit("strong").alias("status")))
    last = docs.filter("lang = 'fr'").select(F.col("doc_id").alias("k"), F.lit(7).alias("quality"), F.lit("last").alias("status"))
    return upsert(upgrade_status(labels, news, ["k"], [F.col("quality")]), last, ["k"], [F.col("quality")])


# -- kinship ------------------------------------------------------------------------------------


def kin_entries(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers, nations and regions as persons: each names its "father" and "grandfather"."""
    r = table(spark, d, "region")
    n = table(spark, d, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select(F.col("s_suppkey").alias("entry"), F.concat_ws(" of ", "s_name", "n_name", "r_name", F.lit("WORLD")).alias("name_norm")).unionByName(
        n.select((F.col("n_nationkey") + 1_000_000_000).alias("entry"), F.concat_ws(" of ", "n_name", "r_name", F.lit("WORLD")).alias("name_norm"))).unionByName(
        r.select((F.col("r_regionkey") + 2_000_000_000).alias("entry"), F.concat_ws(" of ", "r_name", F.lit("WORLD")).alias("name_norm")))


@query("kinship_resolve", f"""
WITH {LINES},
b AS (SELECT c, q, CASE WHEN rf = 'A' THEN 'F' WHEN rf = 'R' THEN 'G' END AS tok, CASE WHEN rf = 'N' THEN s END AS ent FROM single),
k AS (SELECT l_orderkey AS c, l_linenumber AS q, CASE WHEN l_returnflag = 'A' THEN 'F' WHEN l_returnflag = 'R' THEN 'G' END AS tok, n = 1 AS alone
      FROM lineitem JOIN pos ON c = l_orderkey AND q = l_linenumber),
w1 AS (SELECT x.c, x.q, x.tok, x.alone, p.ent AS gov, p.tok AS ptok FROM k x JOIN b p ON p.c = x.c AND p.q = x.q - 1 WHERE x.tok IS NOT NULL AND p.ent IS NOT NULL),
j1 AS (SELECT c, q, tok, alone, gov, CASE WHEN tok = 'F' THEN 1000000000 + s_nationkey END AS ent, CASE WHEN tok = 'F' THEN 7 ELSE 0 END AS score, 1 AS pass_no FROM w1 JOIN supplier ON s_suppkey = gov),
w2 AS (SELECT x.c, x.q, x.tok, x.alone, j1.ent AS gov FROM k x JOIN j1 ON j1.c = x.c AND j1.q = x.q - 1 WHERE x.tok IS NOT NULL AND j1.ent IS NOT NULL AND j1.alone),
j2 AS (SELECT c, q, tok, alone, gov, 2000000000 + n_regionkey AS ent, CASE WHEN tok = 'F' THEN 7 ELSE 8 END AS score, 2 AS pass_no FROM w2 JOIN nation ON n_nationkey = gov - 1000000000),
w3 AS (SELECT x.c, x.q, x.tok, x.alone, j2.ent AS gov FROM k x JOIN j2 ON j2.c = x.c AND j2.q = x.q - 1 WHERE x.tok IS NOT NULL AND j2.alone),
j3 AS (SELECT c, q, tok, alone, gov, NULL::BIGINT AS ent, 0 AS score, 3 AS pass_no FROM w3),
a AS (SELECT * FROM j1 UNION ALL SELECT * FROM j2 UNION ALL SELECT * FROM j3)
SELECT c AS chain_id, q AS sequence_index, gov AS governing, ent AS entity, score, CASE WHEN ent IS NULL THEN 'unresolved' ELSE 'resolved' END AS status, pass_no FROM a""")
def kinship_resolve(spark, d):
    """A lines are father pointers, R lines grandfather pointers, N lines are named suppliers."""
    occ = line_nodes(spark, d).withColumn("token", F.when(F.col("flag") == 1, "F").when(F.col("flag") == 2, "G"))
    occ = occ.withColumn("entity", F.when(F.col("flag") == 0, F.col("supplier"))).withColumn("label", F.lit(""))
    found = KIN.resolve_kinship(occ, kin_entries(spark, d), None, "of", ("F",), ("G",))
    return found.select("chain_id", "sequence_index", F.col("gov").alias("governing"), "entity", "score", "status", "pass_no")


@query("kin_candidates", f"""
WITH {LINES},
k AS (SELECT l_orderkey AS c, l_linenumber AS q FROM lineitem WHERE l_returnflag = 'A'),
w AS (SELECT k.c, k.q, p.s AS gov FROM k JOIN single p ON p.c = k.c AND p.q = k.q - 1 AND p.rf = 'N'),
b AS (SELECT n_nationkey, count(c_custkey) AS n, min(c_custkey) AS one,
             array_to_string(list_transform(list_sort(list(c_custkey))[1:5], lambda x: x || ':7'), ',') AS top
      FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1)
SELECT c AS chain_id, q AS sequence_index, gov AS governing, CASE WHEN n = 1 THEN one END AS entity, CASE WHEN n > 0 THEN 7 ELSE 0 END AS score,
       CASE WHEN n IS DISTINCT FROM 1 THEN coalesce(n, 0) END AS candidate_count, CASE WHEN n IS DISTINCT FROM 1 THEN coalesce(top, '') END AS top
FROM w JOIN supplier ON s_suppkey = gov LEFT JOIN b ON n_nationkey = s_nationkey""")
def kin_candidates(spark, d):
    """Customers bear the name of their nation, so the father of a supplier is one of many: the five best candidates stay."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    line = n.select("n_nationkey", F.concat_ws(" of ", "n_name", "r_name", F.lit("WORLD")).alias("line"))
    sup = table(spark, d, "supplier").join(line, F.col("s_nationkey") == F.col("n_nationkey"))
    cust = table(spark, d, "customer").join(line, F.col("c_nationkey") == F.col("n_nationkey"))
    entries = sup.select((F.col("s_suppkey") + ATOM).alias("entry"), F.concat_ws(" of ", "s_name", "line").alias("name_norm")).unionByName(
        cust.select(F.col("c_custkey").alias("entry"), F.col("line").alias("name_norm")))
    occ = line_nodes(spark, d).withColumn("token", F.when(F.col("flag") == 1, "F")).withColumn("label", F.lit(""))
    occ = occ.withColumn("entity", F.when(F.col("flag") == 0, F.col("supplier") + ATOM))
    found = KIN.resolve_kinship(occ, entries, None, "of", ("F",), ("G",)).filter("pass_no = 1")
    top = F.array_join(F.transform("top", lambda x: F.concat_ws(":", x["candidate"], x["score"])), ",")
    return found.select("chain_id", "sequence_index", (F.col("gov") - ATOM).alias("governing"), "entity", "score", "candidate_count", top.alias("top"))


@query("explicit_relatives", """
WITH lab AS (SELECT DISTINCT n_name || ' of ' || r_name AS label FROM nation JOIN region ON n_regionkey = r_regionkey
             UNION SELECT 'abu ' || p_name || ' ' || p_type FROM part),
en AS (SELECT n_nationkey + 1000000000 AS entry, n_name || ' of ' || r_name AS k FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT label, entry, 9 AS score FROM lab JOIN en ON k = label
UNION ALL SELECT DISTINCT 'abu ' || a.p_name || ' ' || a.p_type, b.p_partkey, 9 FROM (SELECT DISTINCT p_name, p_type FROM part) a JOIN part b
  ON split_part(b.p_name, ' ', 1) = split_part(a.p_name, ' ', 1) AND contains(b.p_brand || ' ' || b.p_name || ' ' || b.p_type, split_part(a.p_name, ' ', 2))
  AND contains(b.p_brand || ' ' || b.p_name || ' ' || b.p_type, a.p_type)""")
def explicit_relatives(spark, d):
    """Explicit relatives: lineage labels find nations, kunya labels find parts by their first word."""
    labels = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat_ws(" of ", "n_name", "r_name").alias("label"))
    part = table(spark, d, "part")
    labels = labels.unionByName(part.select(F.concat_ws(" ", F.lit("abu"), "p_name", "p_type").alias("label")))
    called = part.select(F.col("p_partkey").alias("entry"), F.lit("").alias("name_norm"), F.concat_ws(" ", "p_brand", "p_name", "p_type").alias("intro"),
                                               F.concat(F.lit("abu "), F.substring_index("p_name", " ", 1)).alias("key"))
    people = kin_entries(spark, d).withColumn("intro", F.lit(""))
    entries = people.unionByName(called.drop("key"))
    return KIN.label_matches(labels, entries, called.select("key", "entry"), kunya=("abi", "abu"))


@query("strict_father", f"""
WITH {LINES},
cd AS (SELECT s_suppkey AS card, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey || ' of ' || (s_suppkey + 1) || ' of ' || s_nationkey ELSE s_suppkey || ' of ' || s_nationkey END AS idn FROM supplier),
op AS (SELECT x.c, x.q, p.s AS prev, f.s AS nxt FROM single x JOIN single p ON p.c = x.c AND p.q = x.q - 1 JOIN single f ON f.c = x.c AND f.q = x.q + 1
       WHERE x.rf = 'A')
SELECT op.c AS chain_id, op.q AS sequence_index, prev, nxt AS next, f.card AS entity FROM op JOIN cd g ON g.card = prev AND g.card % 2 = 0
JOIN cd f ON f.card = g.card + 1 JOIN supplier gs ON gs.s_suppkey = g.card JOIN supplier fs ON fs.s_suppkey = f.card AND fs.s_nationkey = gs.s_nationkey
WHERE EXISTS (SELECT 1 FROM rel_a WHERE st = f.card AND te = nxt)""")
def strict_father(spark, d):
    """Even suppliers name the next supplier as father and their nation as grandfather."""
    k = F.col("s_suppkey")
    ident = F.when(k % 2 == 0, F.concat_ws(" of ", k, k + 1, "s_nationkey")).otherwise(F.concat_ws(" of ", k, "s_nationkey"))
    cards = table(spark, d, "supplier").select(k.alias("card"), ident.alias("identity_norm"))
    met = C.guarded_neighbours(line_nodes(spark, d), ["occurrence_id", "supplier", "flag"]).filter("flag = 1")
    opened = met.select(*C.POSITION, "occurrence_id", F.lit("F").alias("token"), F.col("prev_supplier").alias("prev"), F.col("next_supplier").alias("next"))
    _, nxt = card_edges(spark, d)
    found = KIN.resolve_strict_father(opened, cards, nxt, ("F",), "of", compound=("none",))
    return found.select("chain_id", "sequence_index", "prev", "next", "entity")
