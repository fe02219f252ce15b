from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
import xxhash

from silsila.llm import simhash
from silsila.llm.graph import components


def brute_print(text):
    import re
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", text)
    parts = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    best = {}
    for i, d in enumerate(ids):
        best[find(i)] = min([x for x in (best.get(find(i)), d) if x is not None], default=None)
    return [best[find(i)] for i in range(len(ids))]


def test_golay_facts_over_all_cosets():
    """The code is linear, so a word stands for its coset: every syndrome against every error of one or two bits."""
    tables = simhash.golay_tables()
    leaders = tables[1][:, 0].copy()
    assert len({int(x) for x in leaders}) == 2048 and np.bitwise_count(leaders).max() == 3
    near, many = simhash.near_codewords(leaders, tables)
    sets = [set(near[i, :many[i]].tolist()) for i in range(2048)]
    for e in [1 << b for b in range(23)]:
        other, _ = simhash.near_codewords(leaders ^ e, tables)
        assert all(int(other[i, 0]) in sets[i] for i in range(2048))
    for a, b in itertools.combinations(range(23), 2):
        other, n = simhash.near_codewords(leaders ^ (1 << a | 1 << b), tables)
        assert all(sets[i] & set(other[i, :n[i]].tolist()) for i in range(2048))


@pytest.mark.parametrize("bits", [1, 2, 3, 4])
def test_every_pair_within_four_bits_shares_a_key(bits):
    rng = np.random.default_rng(bits)
    a = rng.integers(-2**63, 2**63 - 1, 3000, dtype=np.int64)
    flips = [sum(1 << int(b) for b in rng.choice(64, bits, replace=False)) for _ in a]
    b = a ^ np.array(flips, dtype=np.uint64).view(np.int64)
    tables = simhash.golay_tables()
    keys = [set(zip(*map(np.ndarray.tolist, simhash.golay_keys(x, tables)))) for x in (a, b)]
    assert {r for _, r in keys[0] & keys[1]} == set(range(len(a)))


@pytest.mark.parametrize("direct", [simhash.DIRECT, 2])
def test_against_brute_force(make, texts, direct):
    random.seed(direct)
    rows = list(texts.items())[:120]
    base = [t for _, t in rows if 30 < len(t.split()) < 400]
    for n in range(150):                                        # near copies: one word changed, so few bits flip
        words = base[n % 6].split()
        words[random.randrange(len(words))] = f"w{n}"
        rows.append((10_000 + n, " ".join(words)))
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(make(rows), direct).collect()}
    prints = [brute_print(t) for _, t in rows]
    assert [got[i][0] for i, _ in rows] == prints
    assert [got[i][1] for i, _ in rows] == brute_components([i for i, _ in rows], prints)
    assert len({c for _, c in got.values()}) < len(rows) - 20


def test_balls_and_bucket_borders(spark):
    random.seed(9)
    prints = {0, -1, 1 << 62}
    for root in (random.getrandbits(63), -random.getrandbits(63)):
        for _ in range(60):
            x = root
            for b in random.sample(range(63), random.randint(0, 5)):
                x ^= 1 << b
            prints.add(x)
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "print bigint").repartition(3)
    want = brute_components(prints, [p % 2**64 for p in prints])
    for direct in (1024, 3):
        got = {r.node: r.root for r in components(simhash.links(df, direct)).collect()}
        assert [got.get(p, p) for p in prints] == want


def test_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted(map(tuple, simhash.near_duplicates(odd).collect()), key=repr)
    prints = [brute_print(t) for _, t in rows]
    want = brute_components([i for i, _ in rows], prints)
    assert got == sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, want)), key=repr)
    assert simhash.near_duplicates(nothing).count() == 0
    left = simhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns and left.count() == len(set(want)) + 1         # the repeated row is one document


def test_long_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}
    assert components(edges.limit(0)).count() == 0
