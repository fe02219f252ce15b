from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from silsila.llm import exact_dedup, langid, pii, simhash
from silsila.llm.common import stage_table
from silsila.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect


def test_registered():
    import __spark_entry__ as entry
    names = [n for n in entry.queries() if n[:2] == "op" and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in entry.queries() and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_oracles(spark, sf, name):
    ok, note = compare(QUERIES[name](spark, sf), connect(sf), ORACLES[name])
    assert ok, note


def test_stages_against_the_operators(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    by = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage_table(stage(spark, docs, sf), name)
        by[name] = (before, docs)
    for name, (before, after) in list(by.items())[:-1]:
        assert after.columns == before.columns
    ids = {name: ({r.doc_id for r in a.select("doc_id").collect()}, {r.doc_id for r in b.select("doc_id").collect()})
           for name, (a, b) in by.items()}

    a, b = ids["language_id"]
    texts = {r.doc_id: r.text for r in by["language_id"][0].collect()}
    assert b <= a and all(not langid.has_letter(texts[i] or "") for i in a - b if len((texts[i] or "").split()) > 5)

    groups = Counter()
    for r in by["exact_dedup"][0].collect():
        groups[exact_dedup.normalised(r.text)] = max(r.doc_id, groups[exact_dedup.normalised(r.text)])
    assert ids["exact_dedup"][1] == set(groups.values())

    prints = {r.doc_id: simhash.simhash(r.text) for r in by["simhash"][0].collect()}
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in prints:
        for y in prints:
            if x < y and ((prints[x] ^ prints[y]) % 2**64).bit_count() <= 4:
                p, q = find(x), find(y)
                parent[max(p, q)] = min(p, q)
    assert ids["simhash"][1] == {i for i in prints if find(i) == i}

    assert ids["personal_data"][0] == ids["personal_data"][1]
    field = pii.train(spark)
    before = {r.doc_id: r.text for r in by["personal_data"][0].collect()}
    for r in by["personal_data"][1].collect():
        assert r.text == pii.masked(before[r.doc_id], pii.spans_of([before[r.doc_id]], field)[0][1]) and r.n_chars == len(r.text)
        assert not pii.base_spans(r.text)
    assert ids["best_fit_packing"][1] == ids["personal_data"][1]


def test_run_and_odd_rows(spark, sf, odd, nothing):
    assert corpus_pipeline.run(spark, sf).count() > 0
    for start in (odd, nothing):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stage_table(stage(spark, docs, sf), name)
        assert (docs.count() > 0) == (start is odd)


def test_dedup_stages_drop_rows_for_their_own_text(make):
    """Null ids, one id with two texts, and fully repeated rows: what goes is the copy, nothing that shares its id."""
    base = "the quick brown fox jumps over the lazy dog near the old stone bridge while seven grey geese watch from a low wall " * 6
    near = [base.replace(" ", " " * n, 1) for n in (2, 3, 4)]                 # other texts, the same words
    rows = [(1, "Copy A"), (None, "copy a"), (None, "alone one"), (2, "copy ÄÖ\U0001f600 B"), (3, "COPY ÄÖ\U0001f600 b"), (2, "alone two"),
            (4, "same row"), (4, "same row"), (None, "no id twice"), (None, "no id twice"),
            (5, base), (6, near[0]), (6, "alone six"), (None, near[1]), (5, near[2])]
    exact = stage_table(corpus_pipeline.exact_copies(None, make(rows), ""), "exact")
    want = list(rows)
    for row in [(None, "copy a"), (2, "copy ÄÖ\U0001f600 B"), (4, "same row"), (None, "no id twice")]:
        want.remove(row)
    assert sorted(((r.doc_id, r.text) for r in exact.collect()), key=repr) == sorted(want, key=repr)
    left = [(r.doc_id, r.text) for r in corpus_pipeline.near_copies(None, exact, "").collect()]
    kept = [row for row in want if row[1] not in (base, *near)]
    assert sorted((row for row in left if row[1] not in (base, *near)), key=repr) == sorted(kept, key=repr)
    assert [i for i, text in left if text in (base, *near)] == [5]


def test_one_of_near_copies_with_one_id_stays(make):
    base = "the quick brown fox jumps over the lazy dog near the old stone bridge while seven grey geese watch from a low wall " * 6
    for i in (7, None):
        assert simhash.drop_near_duplicates(make([(i, base), (i, base + " "), (8, "something else")])).count() == 2
