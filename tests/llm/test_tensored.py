from __future__ import annotations

import random

import numpy as np
import pytest

from silsila.llm import tensored
from silsila.llm.graph import components
from tests.llm.conftest import LONG, ODD


def brute_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3)))


def brute(rows):
    """Every two distinct sets compared; classes by union-find."""
    sets = [brute_set(t) for _, t in rows]
    distinct = list(dict.fromkeys(s for s in sets if s))
    root = {s: s for s in distinct}

    def top(s):
        while root[s] is not s:
            s = root[s]
        return s

    where = {}
    for k, s in enumerate(distinct):
        for w in s:
            where.setdefault(w, []).append(k)
    for k, s in enumerate(distinct):
        for o in {o for w in s for o in where[w] if o < k}:
            both = len(s & distinct[o])
            if 100 * both >= 80 * (len(s) + len(distinct[o]) - both):
                root[top(s)] = top(distinct[o])
    names = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            names[top(s)] = min(i, names.get(top(s), i))
    out = []
    for (i, _), s in zip(rows, sets):
        name = names.get(top(s)) if s else i
        out.append((i, len(s), name, i == name))
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def family(rng, words, n, changes):
    return [" ".join(w if rng.random() > changes else f"z{rng.randrange(10**6)}" for w in words) for _ in range(n)]


def test_families_against_brute_force(make):
    rng = random.Random(3)
    texts = []
    for k, changes in enumerate((0.005, 0.02, 0.03, 0.05, 0.1)):
        texts += family(rng, [f"w{k}{rng.randrange(10**6)}" for _ in range(120)], 40, changes)
    shared = " ".join(f"s{i}" for i in range(90))                    # a passage that makes up most of many texts
    texts += [shared + " " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.choice((8, 15, 30, 50)))) for _ in range(60)]
    texts += texts[:30] + [t.upper() for t in texts[10:20]] + ["a b", "A  b", "a", "c d e f g", ""]
    some = list(zip(rng.sample(range(10_000), len(texts)), texts))
    assert rows(tensored.near_duplicates(make(some))) == brute(some)


def test_chains_and_leaders_that_do_not_link(spark, make, monkeypatch):
    """A sliding window: neighbours are linked, the ends of the chain share nothing with the leaders."""
    words = [f"w{i}" for i in range(400)]
    some = [(i, " ".join(words[2 * i:2 * i + 60])) for i in range(150)]
    random.Random(1).shuffle(some)
    monkeypatch.setattr(tensored, "STAR", 3)                         # leaders in several tasks
    monkeypatch.setattr(tensored, "NEWS", 1)                         # one round of leaders, then the rarest shingles
    found = rows(tensored.near_duplicates(make(some)))
    assert found == brute(some) and {r[2] for r in found} == {0}


def test_rarest_shingles_alone_find_every_link(spark, make):
    rng = random.Random(8)
    texts = [t for k in range(6) for t in family(rng, [f"w{k}{rng.randrange(500)}" for _ in range(rng.choice((9, 40, 100)))], 20, 0.02)]
    some = list(dict.fromkeys(texts))
    table = spark.createDataFrame([(i, len(brute_set(t)), t) for i, t in enumerate(some)], "node bigint, n bigint, text string")
    roots = spark.createDataFrame([], "node bigint, root bigint")
    pairs = tensored.rare_first_pairs(tensored.rare_places(table, roots))
    found = {(r.a, r.b) for r in tensored.confirm(pairs, table).collect()}
    sets = [brute_set(t) for t in some]
    want = {(i, j) for j in range(len(some)) for i in range(j) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert found == want and want


def test_odd_rows(odd, nothing):
    assert rows(tensored.near_duplicates(odd)) == brute([(r[0], r[1]) for r in ODD])
    assert tensored.near_duplicates(nothing).count() == 0


def test_null_ids_name_no_component(make):
    some = [(None, "one two three four five"), (7, "ONE two three four five"), (None, "alone in the whole wide table"), (None, None)]
    assert rows(tensored.near_duplicates(make(some))) == sorted(
        [(None, 2, 7, False), (7, 2, 7, True), (None, 3, None, True), (None, 0, None, True)], key=repr)


def test_collections_tell_the_similarity():
    rng = np.random.default_rng(4)
    agree = []
    for _ in range(300):
        both, own = rng.integers(0, 2**63, 400, dtype=np.uint64), rng.integers(0, 2**63, (2, 50), dtype=np.uint64)
        one, two = (tensored.collections(np.unique(np.concatenate([both, o]))) for o in own)
        agree.append(sum(x == y for x, y in zip(one, two)))
    assert abs(np.mean(agree) / tensored.COLLECTIONS - 0.8 ** tensored.WIDTH) < 0.03
    assert min(agree) >= 2


def test_whole_table(spark, sf, texts):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert rows(tensored.near_duplicates(docs)) == brute(list(texts.items()))
