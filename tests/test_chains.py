from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from silsila.operators import chains as C
from silsila.operators.scans import scan_before
from tests.conftest import rows

SCHEMA = "chain_id long, branch_hint int, sequence_index int, occurrence_id long, entity long, normalized_name string, occurrence_type string, transmission_term string"


def occurrences(spark, n=600, hot=0.35, seed=1):
    """Random atoms with groups and gaps; one chain holds a third of all rows."""
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        chain = 0 if rnd.random() < hot else rnd.randint(1, 40)
        length = 400 if chain == 0 else 7
        data.append((chain, rnd.randint(0, 1), rnd.randint(1, length), i, rnd.choice([None, 1, 2, 3]), f"n{rnd.randint(0, 4)}",
                     rnd.choice(["named_candidate", "relational_or_unknown"]), rnd.choice("ab")))
    return data, spark.createDataFrame(data, SCHEMA)


def grouped(data):
    pos = defaultdict(list)
    for r in data:
        pos[r[:3]].append(r)
    return pos


def test_neighbours_match_brute_force(spark):
    data, df = occurrences(spark)
    pos = grouped(data)

    def single(key):
        return pos[key][0] if len(pos.get(key, ())) == 1 else None

    want = []
    for (c, b, q), atoms in list(pos.items()):
        if len(atoms) == 1:
            p, x = single((c, b, q - 1)), single((c, b, q + 1))
            want.append((atoms[0][3], p[3] if p else None, x[3] if x else None, p is not None, x is not None))
    got = C.guarded_neighbours(df, ["occurrence_id"])
    assert rows(got, "occurrence_id", "prev_occurrence_id", "next_occurrence_id", "has_prev", "has_next") == sorted(want, key=repr)


def test_group_and_gap_give_no_neighbour(spark):
    data = [(1, 0, q, i, None, "n", "named_candidate", "a") for i, q in enumerate((1, 2, 2, 3))]
    data += [(2, 0, q, 10 + i, None, "n", "named_candidate", "a") for i, q in enumerate((1, 3))]
    got = C.guarded_neighbours(spark.createDataFrame(data, SCHEMA), ["occurrence_id"])
    assert got.filter("has_prev OR has_next").count() == 0


def test_observed_edges_match_brute_force(spark):
    data, df = occurrences(spark)
    pos = grouped(data)
    edges = defaultdict(lambda: [0, set(), set()])
    for (c, b, q), atoms in list(pos.items()):
        for x in atoms:
            for y in pos.get((c, b, q + 1), ()):
                if x[5] == y[5] and x[6] == "named_candidate":
                    continue
                e = edges[(x[5], y[5], x[6], y[6], y[7])]
                e[0] += 1
                e[1].add(c)
                e[2].add(c % 5)
    chains = df.select("chain_id").distinct().withColumn("source_file_id", F.col("chain_id") % 5)
    got = C.observed_edges(C.position_edges(df), chains)
    want = sorted(((*k, v[0], len(v[1]), len(v[2]), int(k[2] != "named_candidate" or k[3] != "named_candidate")) for k, v in edges.items()), key=repr)
    assert rows(got) == want


def test_facts_expand_to_the_pairs(spark):
    data, df = occurrences(spark)
    df = df.withColumn("occurrence_id", F.monotonically_increasing_id())
    occ = [r.asDict() for r in df.collect()]
    want = []
    for x in occ:
        for y in occ:
            if (x["chain_id"], x["branch_hint"], x["sequence_index"] + 1) != (y["chain_id"], y["branch_hint"], y["sequence_index"]):
                continue
            if x["normalized_name"] == y["normalized_name"] and x["occurrence_type"] == "named_candidate":
                continue
            want.append((x["occurrence_id"], y["occurrence_id"]))
    fixed = spark.createDataFrame([tuple(o.values()) for o in occ], df.schema)
    evidence = C.position_edges(fixed)
    pairs = C.edge_pairs(evidence, fixed)
    assert sorted(map(tuple, pairs.select("from_occurrence", "to_occurrence").collect())) == sorted(want)
    chains = fixed.select("chain_id").distinct().withColumn("source_file_id", F.col("chain_id") % 5).withColumn("record_id", F.col("chain_id") * 7)
    facts = C.edge_facts(evidence, chains)
    assert facts.agg(F.sum("evidence_count")).first()[0] == len(want)
    assert facts.filter("source_file_id <> chain_id % 5 or record_id <> chain_id * 7").count() == 0


def test_hot_position_joins_as_one_row(spark):
    """Thousands of equal atoms in one position never form pairs."""
    n = 4000
    df = spark.range(2 * n).select(
        F.lit(1).cast("long").alias("chain_id"), F.lit(0).alias("branch_hint"), (F.col("id") % 2).cast("int").alias("sequence_index"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("normalized_name"), F.lit("named_candidate").alias("occurrence_type"), F.lit("t").alias("transmission_term"))
    facts = C.position_edges(df).collect()
    assert len(facts) == 1 and facts[0]["evidence_count"] == n * n


def test_link_counts(spark):
    data, df = occurrences(spark)
    got = C.link_counts(df.withColumn("resolved", F.col("entity").isNotNull().cast("int")))
    want = defaultdict(lambda: [0, 0, set()])
    for r in data:
        w = want[r[:2]]
        w[0] += 1
        w[1] += r[4] is not None
        w[2].add(r[2])
    assert rows(got) == sorted(((*k, v[0], v[1], len(v[2]) - 1) for k, v in want.items()), key=repr)


@pytest.mark.parametrize("levels", [0, 1, 2])
def test_scans(spark, levels):
    rnd = random.Random(3)
    data = [(rnd.choice("aab"), i, rnd.choice([None, None, i])) for i in rnd.sample(range(500), 200)]
    df = spark.createDataFrame(data, "p string, o long, v long")
    last = scan_before(df, ["p"], "o", "v", "x", "last", block=5, levels=levels)
    total = scan_before(df.withColumn("w", F.lit(1)), ["p"], "o", "w", "x", "sum", block=5, levels=levels)
    want_last, want_sum = [], []
    for p, o, _ in data:
        before = sorted((r for r in data if r[0] == p and r[1] < o), key=lambda r: r[1])
        known = [r[2] for r in before if r[2] is not None]
        want_last.append((p, o, known[-1] if known else None))
        want_sum.append((p, o, len(before) or (None if levels == 0 else 0)))
    assert rows(last, "p", "o", "x") == sorted(want_last, key=repr)
    assert rows(total, "p", "o", "x") == sorted(want_sum, key=repr)
