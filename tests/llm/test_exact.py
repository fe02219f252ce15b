from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from silsila.llm import exact_dedup


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [exact_dedup.TRIE_BYTES, 3000])
def test_against_brute_force(spark, sf, texts, limit):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sorted(map(tuple, exact_dedup.exact_groups(docs, limit=limit).collect()), key=repr)
    assert got == brute(texts.items())


def test_odd_rows(odd, nothing):
    got = sorted(map(tuple, exact_dedup.exact_groups(odd).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert exact_dedup.exact_groups(nothing).count() == 0
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(map(str, [None, 2, 3, 4, 6, 8, 9, 9, 10, 11, 12]))


def test_trie_holds_any_bytes_and_spills():
    random.seed(4)
    keys = [bytes(random.choice(b"ab\x00\xff") for _ in range(random.randint(0, 12))) for _ in range(3000)]
    want = defaultdict(lambda: [None, 0])
    for i, k in enumerate(keys):
        want[k] = [max(i, want[k][0] if want[k][0] is not None else -1), want[k][1] + 1]
    trie, out = exact_dedup.PatriciaTrie(), defaultdict(lambda: [-1, 0])
    for i, k in enumerate(keys):
        trie.insert(k, i)
        if i % 500 == 499:
            before, gone = trie.size, trie.spill()
            assert gone and trie.size < before
            for key, owner, n in gone:
                out[key] = [max(owner, out[key][0]), out[key][1] + n]
    for key, owner, n in trie.items():
        out[key] = [max(owner, out[key][0]), out[key][1] + n]
    assert dict(out) == dict(want)


def test_smallest_owner():
    trie = exact_dedup.PatriciaTrie(largest=False)
    for owner in (5, None, 3, 4):
        trie.insert(b"x", owner)
    trie.insert(b"", 7)
    assert sorted(trie.items()) == [(b"", 7, 1), (b"x", 3, 4)]
