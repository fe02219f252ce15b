"""How the test tables feed the operators: lineitem as chains, documents as texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silsila.lexicon import ChainGrammar
from silsila.operators.chains import adjacent_pairs

#: Word lists for the invented prose of the documents table.
PROSE = ChainGrammar(
    title_prefixes=("Is", "Des"), openers=("with", "avec", "mit", "con"), bare_openers=("with", "avec", "mit", "con"),
    conjunctions=(), report_openers=("The", "La"), continuations=("in", "is"), terminal_subjects=("that", "pour"),
    terminal_links=("for", "was"), heard=("on",), said=("are",), said_after_heard=("by",), blessing="the",
    boundary_chars="|!", near_verbs=("and", "et"), transmission_stems=("of", "de"),
    connectors=("of", "the", "de", "la", "der", "die"), embedded_leads=(), embedded_verbs=(),
    relational=("it", "ou", "ne"), relational_atoms=("it", "ou"), name_starts=(), list_marks=",",
    phrase_rules=((r"(?s)[.!,].*$", ""),), note_rules=(),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal a test table out where the session asks for it (``local_session`` does): it is one file of one row group, so
    on one machine a scan would keep a single core busy. Other sessions scan the files as they are."""
    parts = df.sparkSession.conf.get("spark.silsila.spread", None)
    return df.repartition(int(parts), key) if parts else df


def line_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as chains: line number = sequence, supplier = true entity, ``F`` = resolved,
    nation = the ambiguous name. All columns are numbers, so aggregations stay hash based."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("chain_id"), F.lit(0).alias("branch_hint"), F.col("l_linenumber").alias("sequence_index"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("occurrence_id"), F.col("l_suppkey").alias("supplier"),
        (F.col("l_linestatus") == "F").cast("int").alias("resolved"),
        F.when(F.col("l_returnflag") == "R", 2).when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("flag"))
    return lines.withColumn("entity", F.when(F.col("resolved") == 1, F.col("supplier"))).withColumn("is_named", F.lit(1))


#: Ids of further occurrences of a group position lie this far apart.
ATOM = 10**12


def line_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_nodes`` with an id for every occurrence: the occurrences of a group position are numbered by (supplier, status).
    A single one keeps its id. Equal occurrences are interchangeable."""
    place = Window.partitionBy("chain_id", "sequence_index").orderBy("supplier", "resolved")
    return line_nodes(spark, sf_dir).withColumn("occurrence_id", F.col("occurrence_id") + (F.row_number().over(place) - 1) * F.lit(ATOM))


def named_line_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("supplier"), F.col("s_nationkey").alias("name"))
    return line_nodes(spark, sf_dir).join(names, "supplier")


def supplier_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocking index: nation as the ambiguous name, supplier as the entity."""
    return table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("key"), F.col("s_suppkey").alias("entity"))


def flagged_pairs(spark: SparkSession, sf_dir: str, flag: int) -> DataFrame:
    """(student, teacher) supplier pairs on adjacent singletons whose first line has the flag."""
    pairs = adjacent_pairs(line_nodes(spark, sf_dir), ["supplier", "flag"]).filter(F.col("from_flag") == flag)
    return pairs.select(F.col("from_supplier").alias("student"), F.col("to_supplier").alias("teacher")).distinct()


def supplier_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last shipping year of each supplier stand in for birth and death years."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("y"))
    return lines.groupBy(F.col("l_suppkey").alias("entity")).agg(
        F.min("y").alias("birth_year"), F.max("y").alias("death_year"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")

#: Oracle prelude: positions, singletons, adjacent singleton pairs, flagged relations.
LINES = """
pos AS (SELECT l_orderkey AS c, l_linenumber AS q, count(*) AS n, min(l_suppkey) AS s,
               min(l_linestatus) AS ls, min(l_returnflag) AS rf FROM lineitem GROUP BY 1, 2),
single AS (SELECT pos.*, s_nationkey AS nm, CASE WHEN ls = 'F' THEN s END AS ent
           FROM pos JOIN supplier ON s_suppkey = s WHERE n = 1),
adj AS (SELECT a.c, a.q AS q1, b.q AS q2, a.s AS s1, b.s AS s2, a.ls AS ls1, b.ls AS ls2, a.rf AS rf1, b.rf AS rf2,
               a.ent AS e1, b.ent AS e2
        FROM single a JOIN single b ON a.c = b.c AND b.q = a.q + 1),
rel AS (SELECT DISTINCT s1 AS st, s2 AS te FROM adj WHERE rf1 = 'R'),
rel_a AS (SELECT DISTINCT s1 AS st, s2 AS te FROM adj WHERE rf1 = 'A'),
hood AS (SELECT x.c, x.q, x.s, x.nm, x.ent, x.rf, p.ent AS prev, f.ent AS nxt, p.rf AS prev_rf, p.s AS prev_s, f.s AS next_s
         FROM single x LEFT JOIN single p ON p.c = x.c AND p.q = x.q - 1
                       LEFT JOIN single f ON f.c = x.c AND f.q = x.q + 1),
hidden AS (SELECT * FROM hood WHERE ent IS NULL),
atoms AS (SELECT l_orderkey * 8 + l_linenumber + (row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey, l_linestatus = 'F') - 1) * 1000000000000 AS id,
          l_orderkey AS c, l_linenumber AS q, CASE WHEN l_linestatus = 'F' THEN l_suppkey END AS ent FROM lineitem)
"""
