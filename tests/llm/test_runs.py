from __future__ import annotations

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from silsila.llm import runs
from tests.llm.conftest import LONG, ODD


def brute_runs(words):
    """Every maximal stretch per lag; kept where no smaller lag holds in the same stretch."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                piece = words[i:i + length]
                if not any(all(piece[k] == piece[k + r] for k in range(length - r)) for r in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(text, doc_id):
    words = (text or "").encode().split()
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    dropped = {i for s, size, q in found for i in range(s + q, s + size)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(found), *best, None if best[0] is None else best[1] * 1000 // best[2],
            hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70))
def test_random_words(words):
    assert runs.find_runs(np.array(words, dtype=np.int64)) == brute_runs(words)


def test_planted_periods():
    rng = random.Random(1)
    for _ in range(300):
        words = [rng.randrange(rng.choice((2, 40))) for _ in range(rng.randrange(30))]
        for _ in range(rng.randrange(1, 4)):
            unit = [rng.randrange(rng.choice((2, 3, 40))) for _ in range(rng.randrange(1, 25))]
            words += (unit * 6)[:rng.randrange(1, len(unit) * 6 + 1)] + [rng.randrange(3) for _ in range(rng.randrange(6))]
        assert runs.find_runs(np.array(words, dtype=np.int64)) == brute_runs(words)


def test_long_texts_are_searched_in_near_linear_time():
    start = time.perf_counter()
    assert runs.find_runs(np.zeros(1_000_000, dtype=np.int64)) == [(0, 1_000_000, 1)]
    unit = np.arange(50_000)
    assert runs.find_runs(np.tile(unit, 20)) == [(0, 1_000_000, 50_000)]
    old, new = [0], [0, 1]
    while len(new) < 500_000:                   # Fibonacci words hold very many repeats and no run of four periods
        old, new = new, new + old
    assert runs.find_runs(np.array(new)) == []
    assert time.perf_counter() - start < 60


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()),
                  key=repr)


def test_odd_rows(odd, nothing):
    short = [r for r in ODD if r[1] != LONG]
    assert rows(runs.periodic_runs(odd.filter("doc_id is null or doc_id not in (7, 8)"))) == sorted(
        (brute_row(r[1], r[0]) for r in short), key=repr)
    found = {r.doc_id: r for r in runs.periodic_runs(odd).collect()}
    assert (found[7].n_runs, found[7].start, found[7].length, found[7].period) == (1, 0, 120_000, 6)
    assert runs.periodic_runs(nothing).count() == 0


def test_whole_table(spark, sf, texts):
    found = rows(runs.periodic_runs(spark.read.parquet(f"{sf}/documents.parquet")))
    short = {k: t for k, t in texts.items() if len(t.split()) < 3000}
    assert len(found) == len(texts) and len(short) > 150
    assert [r for r in found if r[0] in short] == sorted((brute_row(t, k) for k, t in short.items()), key=repr)
    assert any(r[1] for r in found)


def test_separators_and_bytes(make):
    text = " ".join(["é x", "É"] * 5) + " \u0085y"      # only ASCII white space parts words
    doc = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10)
    assert rows(runs.periodic_runs(make([(doc, text)]))) == [brute_row(text, doc)]
