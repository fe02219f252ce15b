from __future__ import annotations

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from silsila.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return packing.WordEncoder(f.read(), 1)


def test_ids_are_those_of_the_library(library, encoder, texts):
    random.seed(5)
    plain = list("aAbBst's  \n\t\réÉñÜßſŉrevlmd0912.,!#$'''-_Ęœ")
    wild = list("aAb's  \n\t\r\x1c\x85\xa0 ́éİſK中　Σς9½²①.,!#\x00​😀×÷ªºµ") + ["<|endoftext|>", "'ll", "'re"]
    odd = ["", " ", "it's", "''s", "x,'s", "we'll've", "'re're", "1234a", "<|", "a" * 3000, "ab" * 2000]
    odd += ["".join(random.choice(plain) for _ in range(random.randint(0, 40))) for _ in range(5000)]
    odd += ["".join(random.choice(wild) for _ in range(random.randint(0, 25))) for _ in range(3000)]
    for some in (list(texts.values()), odd):
        want = [e.ids + [1] for e in library.encode_batch(some, add_special_tokens=False)]
        assert [x.tolist() for x in encoder.encode(some)] == want


def least_bins(sizes, capacity):
    """Fewest bins by depth-first search."""
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for r in {r for r in rooms if r >= sizes[i]}:
            rest = list(rooms)
            rest.remove(r)
            place(i + 1, rest + [r - sizes[i]])
        place(i + 1, rooms + [capacity - sizes[i]])

    if sizes:
        place(0, [])
    return best[0] if sizes else 0


def test_reduction_never_costs_a_bin():
    random.seed(8)
    for _ in range(400):
        capacity = random.choice([10, 13, 20])
        sizes = [random.randint(1, capacity) for _ in range(random.randint(0, 9))]
        count = {s: sizes.count(s) for s in set(sizes)}
        fixed, left = packing.reduce_by_dominance(count, capacity)
        assert all(sum(bin_) <= capacity for bin_, _ in fixed)
        rest = [s for s, c in left.items() for _ in range(c)]
        used = [s for bin_, n in fixed for s in bin_ for _ in range(n)]
        assert sorted(used + rest) == sorted(sizes)
        assert sum(n for _, n in fixed) + least_bins(rest, capacity) == least_bins(sizes, capacity), sizes


def check_plan(count, capacity):
    runs, sequences = packing.plan_bins(count, capacity)
    bins, seen = {}, {}
    for length, first, end, sequence, offset in runs:
        for r in range(first, end):
            bins.setdefault(sequence + r - first, []).append((offset, length))
            seen.setdefault(length, []).append(r)
    assert {s: sorted(r) for s, r in seen.items()} == {s: list(range(c)) for s, c in count.items() if c}
    assert set(bins) == set(range(sequences))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_plans_are_whole_and_good():
    random.seed(2)
    for _ in range(200):
        capacity = random.choice([10, 50, 100])
        sizes = [random.randint(1, capacity) for _ in range(random.randint(0, 200))]
        n = check_plan({s: sizes.count(s) for s in set(sizes)}, capacity)
        assert n <= 11 / 9 * -(-sum(sizes) // capacity) * 1.5 + 1
    for _ in range(60):
        sizes = [random.randint(1, 20) for _ in range(random.randint(0, 9))]
        assert check_plan({s: sizes.count(s) for s in set(sizes)}, 20) <= least_bins(sizes, 20) + 1


def test_big_counts_stay_short():
    runs, sequences = packing.plan_bins({4096: 10**9, 3000: 10**12, 1096: 10**12 - 7, 5: 10**10}, 4096)
    assert len(runs) < 2000 and sequences >= 10**12


def test_equal_partners_are_fixed_at_once():
    """Very many pieces of a length whose best partner has the same length, or is the smallest one, are planned in no time."""
    for count in ({2000: 10**9}, {1500: 10**9, 1400: 10**9 + 1, 1390: 5}, {2040: 10**9, 1030: 10**9, 1027: 3}, {1366: 10**9 + 2}):
        start = time.time()
        runs, sequences = packing.plan_bins(count, 4096)
        assert time.time() - start < 2 and len(runs) < 100
        assert {s: sum(end - first for length, first, end, _, _ in runs if length == s) for s in count} == count
        assert sequences >= -(-sum(s * c for s, c in count.items()) // 4096)


def test_bulk_fixing_is_fixing_one_by_one():
    """A bin at a time, with the test made anew before each, gives the same bins."""
    def one_by_one(count, capacity):
        left, fixed, again = {s: c for s, c in count.items() if c}, {}, True
        while again:
            again = False
            for s in sorted(left, reverse=True):
                while left.get(s):
                    rest = sorted([t for t in left for _ in range(left[t] - (t == s))])
                    fit = [t for t in rest if t <= capacity - s]
                    pairs = [a + b for i, a in enumerate(fit) for b in fit[i + 1:] if a + b <= capacity - s]
                    two, three = sum(rest[:2]) if len(rest) > 1 else None, sum(rest[:3]) if len(rest) > 2 else None
                    if not fit:
                        best = ()
                    elif fit[-1] == capacity - s or two is None or two > capacity - s or (
                            (three is None or three > capacity - s) and fit[-1] >= max(pairs, default=0)):
                        best = (fit[-1],)
                    else:
                        break
                    fixed[(s, *best)] = fixed.get((s, *best), 0) + 1
                    for t in (s, *best):
                        left[t] -= 1
                        if not left[t]:
                            del left[t]
                    again = True
        return fixed, left

    random.seed(12)
    for _ in range(600):
        capacity = random.choice([10, 13, 20, 41])
        sizes = [random.randint(max(1, capacity // random.choice([2, 3, 5])), capacity) for _ in range(random.randint(0, 25))]
        count = {s: sizes.count(s) for s in set(sizes)}
        fixed, left = packing.reduce_by_dominance(count, capacity)
        total = {}
        for lengths, bins in fixed:
            total[lengths] = total.get(lengths, 0) + bins
        assert (total, left) == one_by_one(count, capacity), (count, capacity)


def check_rows(rows, want):
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return len(by)


def test_documents(make, library, texts):
    rows = [*texts.items(), (-1, "and " * 9000), (-2, None), (-3, ""), (-4, "a b c"), (-4, "a b c")]
    want = []
    for i, t in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want += [(i, p, s, len(ids[s:s + 4096]), zlib.crc32(ids[s:s + 4096].tobytes())) for p, s in enumerate(range(0, len(ids), 4096))]
    got = packing.pack_documents(make(rows), PATH).collect()
    assert check_rows(got, want) <= -(-sum(w[3] for w in want) // 4096) + 1


def test_one_length_for_all(make):
    rows = [(i, "the same text for every document") for i in range(3000)]
    got = packing.pack_documents(make(rows), PATH).collect()
    length = got[0].length
    assert len(got) == 3000 and len({r.sequence_id for r in got}) == -(-3000 // (4096 // length))


def test_odd_rows(odd, nothing):
    got = packing.pack_documents(odd, PATH).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in odd.collect()} and [r.length for r in got if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert len([r for r in got if r.doc_id == 9]) == 2
    assert packing.pack_documents(nothing, PATH).count() == 0
