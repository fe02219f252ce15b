from __future__ import annotations

import random

import numpy as np

from silsila.llm import paragraphs


def sets_of(rows):
    out = {}
    for _, t in rows:
        for _, _, words in paragraphs.units(t or ""):
            out[paragraphs.unit_id(words)] = set(zip(*[words[i:] for i in range(5)]))
    return out


def joined(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return find


def words(n, rng):
    return ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(n)]


def near_rows(seed):
    """Lines of 60 words, each with copies in which words are changed."""
    rng, rows = random.Random(seed), []
    for g in range(40):
        base = words(60, rng)
        for c in range(6):
            one = list(base)
            for _ in range(rng.randint(0, 3)):
                one[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(one)))
    return rows


def test_links_against_brute_force(make):
    rows = near_rows(3)
    sets = sets_of(rows)
    ids = list(sets)
    true = [(a, b) for i, a in enumerate(ids) for b in ids[:i]
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    for exact in (paragraphs.EXACT_BUCKET, 3):
        links = [tuple(r) for r in paragraphs.near_links(make(rows), exact).collect()]
        find, real = joined(links), joined(true)
        assert all(real(a) == real(b) for a, b in links)                        # every link is verified
        if exact > 3:
            assert np.mean([find(a) == find(b) for a, b in true]) > 0.995


def test_large_buckets_lose_no_link(make):
    """Chains of lines: each is similar to the next one, the ends are not, so leaders alone can not hold them together."""
    rng, rows = random.Random(5), []
    for g in range(8):
        one = words(150, rng)
        for c in range(12):
            rows.append((len(rows), " ".join(one)))
            one = one[9:] + words(9, rng)
    sets = sets_of(rows)
    ids = list(sets)
    true = [(a, b) for i, a in enumerate(ids) for b in ids[:i]
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    whole = joined([tuple(r) for r in paragraphs.near_links(make(rows)).collect()])
    for exact in (2, 3, 5):
        links = [tuple(r) for r in paragraphs.near_links(make(rows), exact).collect()]
        find, real = joined(links), joined(true)
        assert all(real(a) == real(b) for a, b in links)
        assert all((find(a) == find(b)) == (whole(a) == whole(b)) for i, a in enumerate(ids) for b in ids[:i])


def test_pending_edges_of_other_buckets_drop_no_leader():
    import pyarrow as pa
    rng = np.random.default_rng(8)
    base, other = (np.unique(rng.integers(0, 2**63, 100, dtype=np.uint64)) for _ in range(2))
    rows = [(1, 1, base), (1, 2, base)] + [(2, 2, base), (2, 3, other), (2, 4, base)]
    batch = pa.RecordBatch.from_pydict({"key": [r[0] for r in rows], "unit": [r[1] for r in rows], "shingles": [r[2].tobytes() for r in rows]})
    links = [p for b in paragraphs._search_buckets([batch], 1) for p in zip(b.column("a").to_pylist(), b.column("b").to_pylist())]
    assert (2, 4) in links


def test_near_copies_of_short_units_and_inner_sentences(make):
    """Sentences of 8 to 30 words inside lines that differ: brute force over all units finds no link that is missed."""
    rng, rows = random.Random(29), []
    for g in range(60):
        base = words(rng.randint(8, 30), rng)
        for c in range(4):
            one = list(base)
            if c == 1:
                one = one + words(1, rng)
            elif c == 2:
                one[-1] = "changed"
            elif c == 3:
                one = one[1:] if len(one) > 8 else one
            rows.append((len(rows), " ".join(words(9, rng)) + ". " + " ".join(one) + ". " + " ".join(words(9, rng))))
    sets = {paragraphs.unit_id(w): set(zip(*[w[i:] for i in range(5)])) for _, t in rows for _, _, w in paragraphs.units(t)}
    ids = list(sets)
    true = {(a, b) for i, a in enumerate(ids) for b in ids[:i]
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9}
    links = [tuple(r) for r in paragraphs.near_links(make(rows)).collect()]
    find, real = joined(links), joined(true)
    assert len(true) > 100 and all(real(a) == real(b) for a, b in links)
    assert all(find(a) == find(b) for a, b in true)


def test_bands_reach_the_tuned_recall():
    rng = np.random.default_rng(0)
    hit = 0
    for _ in range(400):                                                       # pairs with a similarity of 0.8 exactly
        common = rng.integers(0, 2**63, 80, dtype=np.uint64)
        a = np.concatenate([common, rng.integers(0, 2**63, 10, dtype=np.uint64)])
        b = np.concatenate([common, rng.integers(0, 2**63, 10, dtype=np.uint64)])
        keys = paragraphs.band_keys(np.concatenate([a, b]), np.array([90, 90]))
        hit += bool((keys[0] == keys[1]).any())
    assert hit >= 394


def passages(df):
    return sorted((r.doc_id, r.first_word, r.end_word, r.removed, r.keep_doc_ids) for r in df.collect())


def test_planted_passages(make):
    rng = random.Random(7)

    def sentences(n):
        return " ".join(" ".join(words(rng.randint(8, 14), rng)).capitalize() + "." for _ in range(n))

    passage, clean = sentences(6), [(100 + i, sentences(12)) for i in range(20)]
    common = " ".join(words(9, rng)) + "."                                    # a short line in every text is no passage
    rows = [(i, f"{t}\n{common}\n{sentences(3)}") for i, t in clean]
    at = {}
    for i, (host, cut) in enumerate([(sentences(8), 20), (sentences(8), 33), (sentences(8), 0)]):
        w = host.split()
        at[i] = cut
        rows.append((i, " ".join(w[:cut]) + " " + passage + " " + " ".join(w[cut:])))
    got = passages(paragraphs.repeated_passages(make(rows)))
    assert [g[0] for g in got] == [0, 1, 2] and [g[3] for g in got] == [False, True, True]
    n = len(passage.split())
    for doc, first, end, removed, keep in got:
        assert keep == [0] and at[doc] <= first and end <= at[doc] + n and end - first > n - 30


def test_passages_of_any_layout(make):
    """Passages cut in the middle of sentences, without punctuation, and of short lines, inside lines that differ."""
    rng = random.Random(19)

    def host():
        return " ".join(" ".join(words(rng.randint(5, 14), rng)) + "." for _ in range(12))

    plain = words(52, rng)
    sentences = [w + ("." if i % 11 == 5 else "") for i, w in enumerate(words(51, rng))]
    verse = [w + ("\n" if i % 5 == 4 else "") for i, w in enumerate(words(60, rng))]
    short = words(25, rng)
    rows, at = [], {}
    for passage in (plain, sentences, verse, short):
        for _ in range(2):
            h, cut = host().split(), rng.randint(7, 30)
            at[len(rows)] = cut, cut + len(passage)
            rows.append((len(rows), " ".join(h[:cut]) + " " + " ".join(passage) + " " + " ".join(h[cut:])))
    rows += [(100 + i, host()) for i in range(10)]
    got = passages(paragraphs.repeated_passages(make(rows)))
    assert got == [(i, *at[i], i % 2 == 1, [i - i % 2]) for i in range(8)]


def test_every_shared_run_of_20_words_has_a_seed():
    rng = np.random.default_rng(3)
    for _ in range(200):
        run = rng.integers(0, 2**63, 20, dtype=np.uint64)
        found = []
        for _ in range(2):
            size = np.array([rng.integers(0, 30), 0, 20 + rng.integers(0, 40), 5])
            flat = rng.integers(0, 2**63, size.sum(), dtype=np.uint64)
            at = size[0] + rng.integers(0, size[2] - 19)
            flat[at:at + 20] = run
            found.append(set(paragraphs.seeds(flat, np.repeat(np.cumsum(size), size) - np.arange(len(flat)))[1].tolist()))
        assert found[0] & found[1]


def test_full_filter_gives_the_same_passages(make, monkeypatch):
    rows = near_rows(23)
    want = passages(paragraphs.repeated_passages(make(rows)))
    monkeypatch.setattr(paragraphs, "FILTER_BITS", 10)                          # nearly every key passes
    assert passages(paragraphs.repeated_passages(make(rows))) == want


def test_extension_against_one_row_at_a_time():
    """Runs of eight words or more behind gaps of up to eight, words put in, left out or changed on either side."""
    side, gap, least = paragraphs.SIDE, paragraphs.GAP_WORDS, paragraphs.UNIT_WORDS

    def plain(a, b):
        here = 0
        while here < side and a[here] and a[here] == b[here]:
            here += 1
        far = here
        for i in range(side):                                               # runs by their ends, nearest first
            for d in range(-gap, gap + 1):
                n = 0
                while i - n >= 0 and 0 <= i + d < side and i + d - n >= 0 and a[i - n] and a[i - n] == b[i + d - n]:
                    n += 1
                if n >= least and i + 1 - n <= here + gap and i + 1 - n + d <= far + gap:
                    here, far = max(here, i + 1), max(far, i + 1 + d)
        return here, far

    rng, mine, other = random.Random(47), [], []
    for _ in range(400):
        a = [rng.randrange(1, 65536) for _ in range(2 * side)]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(side)
            b[at:at + rng.randint(0, 3)] = [rng.randrange(1, 65536) for _ in range(rng.randint(0, 3))]
        known = rng.randint(0, side)
        mine.append((a[:known] + [0] * side)[:side] if rng.random() < 0.3 else a[:side])
        other.append(b[:side])
    here, far = paragraphs.extension(np.array(mine, dtype="<u2"), np.array(other, dtype="<u2"))
    assert list(zip(here.tolist(), far.tolist())) == [plain(a, b) for a, b in zip(mine, other)]
    assert len(set(here.tolist())) > 20
    one = paragraphs._binary(np.array(mine, dtype="<u2"))
    assert paragraphs._matrix(one).tolist() == mine and paragraphs._matrix(one[:0]).shape == (0, side)


def test_ids_of_spans_are_those_of_their_words():
    """The ids of units do not depend on what stands around them."""
    rng = random.Random(53)
    lines = [" ".join(words(rng.randint(1, 30), rng)) + rng.choice(["", ".", "!"]) for _ in range(200)]
    scanned = paragraphs.scan(["\n".join(lines[:90]), "", "\n".join(lines[90:])], paragraphs._WordHash())
    every = " ".join(lines).split()
    a, b = paragraphs.unit_places(scanned)
    assert paragraphs.span_ids(scanned.flat, a, b).tolist() == [paragraphs.unit_id(every[x:y]) for x, y in zip(a, b)]
    assert sorted(every[x:y] for x, y in zip(a, b)) == sorted(line.split() for line in lines if len(line.split()) >= paragraphs.UNIT_WORDS)


def test_near_copies_of_passages(make):
    """Every passage whose copies reach the threshold is found: five sentences of 12 words in other lines, a word changed."""
    rng, rows, near = random.Random(37), [], 0
    for g in range(40):
        base = [w + ("." if i % 12 == 11 else "") for i, w in enumerate(words(60, rng))]
        other = list(base)
        other[rng.randrange(60)] = "changed"
        a, b = (set(zip(*[w[i:] for i in range(5)])) for w in (base, other))
        near += len(a & b) >= 0.8 * len(a | b)
        rows += [(2 * g + i, " ".join(words(15, rng)) + " " + " ".join(w) + " " + " ".join(words(15, rng))) for i, w in enumerate((base, other))]
    got = {r.doc_id: r.n_words for r in paragraphs.repeated_passages(make(rows)).filter("removed").collect()}
    assert near == 40 and set(got) == set(range(1, 80, 2))
    assert min(got.values()) >= 50


def test_copies_and_edits(make):
    rng = random.Random(11)
    line = words(70, rng)
    edited = list(line)
    edited[35] = "changed"
    rows = [(5, " ".join(line)), (3, " ".join(edited)), (8, " ".join(line).upper()), (9, " ".join(words(70, rng)))]
    assert passages(paragraphs.repeated_passages(make(rows))) == [(3, 0, 70, False, [3]), (5, 0, 70, True, [3]), (8, 0, 70, True, [3])]


def test_texts_of_one_id_are_texts_of_their_own(make):
    """Two texts of one id, or of none, each share a line of 14 words with others: no passage, whatever the ids."""
    rng = random.Random(41)
    one, two = words(14, rng), words(14, rng)

    def text(line):
        return " ".join(words(20, rng)) + ".\n" + " ".join(line) + ".\n" + " ".join(words(20, rng)) + "."

    first, second, others = text(one), text(two), [(50, text(one)), (51, text(two))]
    for a, b in ((1, 2), (1, 1), (None, None)):
        assert passages(paragraphs.repeated_passages(make([(a, first), (b, second), *others]))) == []


def test_owners_without_an_id(make):
    rng = random.Random(43)
    line, other = " ".join(words(60, rng)), " ".join(words(60, rng))
    rows = [(None, line), (4, line), (None, other), (7, other + " " + line), (7, other)]
    got = {(r.doc_id, r.first_word, r.end_word, r.removed): r.keep_doc_ids for r in paragraphs.repeated_passages(make(rows)).collect()}
    assert got[(4, 0, 60, True)] == [None] and got[(7, 0, 120, True)] == [None] and got[(7, 0, 60, True)] == [None]
    assert got[(None, 0, 60, False)] == [None] and len(got) == 4
    twice = paragraphs.repeated_passages(make([(3, line), (3, line), (9, line)]))
    assert passages(twice) == [(3, 0, 60, False, [3]), (9, 0, 60, True, [3])]


def test_leaders_of_a_large_bucket():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 2**63, 100, dtype=np.uint64))
    sets = [np.unique(np.append(base, rng.integers(0, 2**63, 3, dtype=np.uint64))) for _ in range(30)]
    far = [np.unique(rng.integers(0, 2**63, 100, dtype=np.uint64)) for _ in range(5)]
    import pyarrow as pa
    rows = [(1, i, s.tobytes()) for i, s in enumerate(sets + far)] + [(2, 100, base.tobytes()), (2, 101, base.tobytes())]
    batches = [pa.RecordBatch.from_pydict({"key": [r[0] for r in part], "unit": [r[1] for r in part], "shingles": [r[2] for r in part]})
               for part in (rows[:10], rows[10:11], rows[11:])]
    for exact in (1000, 6):
        links = [p for b in paragraphs._search_buckets(batches, exact) for p in zip(b.column("a").to_pylist(), b.column("b").to_pylist())]
        find = joined(links)
        assert len({find(i) for i in range(30)}) == 1 and find(100) == find(101)
        assert len({find(i) for i in range(35)}) == 6


def test_odd_rows(odd, nothing):
    got = passages(paragraphs.repeated_passages(odd))
    n = len("and the long text goes on ".split()) * 20_000
    assert got == [(7, 0, n, False, [7]), (8, 0, n, True, [7])]
    assert paragraphs.repeated_passages(nothing).count() == 0


def test_scan_keeps_no_words_and_splits_like_str():
    """Ordinary words leave nothing in memory behind them; white space, case and line ends are those of Python's strings."""
    rng, known = random.Random(59), paragraphs._WordHash()
    paragraphs.scan([" ".join(f"w{i}" for i in range(50_000))], known)
    assert len(known) == 0
    letters, of_word, of_hash = "ab.!?Z \t\n\x0b\r\x1c\x85\xa0　İßé中\ud800\x00", {}, {}
    for _ in range(200):
        texts = ["".join(rng.choice(letters) if rng.random() < 0.9 else "q" * rng.choice([1, 7, 8, 9, 63, 64, 65, 200])
                         for _ in range(rng.randint(0, 80))) for _ in range(rng.randint(0, 6))]
        got, lines = paragraphs.scan(texts, known), [[line.split() for line in t.lower().split("\n")] for t in texts]
        assert got.lines.tolist() == [len(line) for t in lines for line in t]
        assert got.size.tolist() == [sum(map(len, t)) for t in lines]
        for w, h in zip((w for t in lines for line in t for w in line), got.flat.tolist(), strict=True):
            assert h & 1 == (w[-1] in ".!?") and of_word.setdefault(w, h) == h and of_hash.setdefault(h, w) == w


def test_dealt_numbers_against_counts(make, monkeypatch):
    monkeypatch.setattr(paragraphs, "PIECE_ROWS", 3)
    rng = random.Random(61)
    lines = [" ".join(words(9, rng)) for _ in range(60)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 3)))) for i in range(60)] + [(60, None)]
    many = {}
    for _, t in rows:
        for _, _, w in paragraphs.units(t or ""):
            many[paragraphs.unit_id(w)] = many.get(paragraphs.unit_id(w), 0) + 1
    bits = paragraphs.repeated_keys(make(rows)).value
    for unit, n in many.items():
        assert paragraphs.passes(np.array([unit]), bits)[0] == (n > 1)
    assert {1, 2} < set(many.values())


def test_open_seeds_against_one_seed_at_a_time():
    import pyarrow as pa
    rng, spans, seeds = random.Random(67), [], []
    for i in range(50):
        low = [rng.randrange(300) for _ in range(rng.randint(0, 8))]
        spans.append([{"first": a, "last": a + rng.randint(8, 60), "removed": rng.random() < 0.5} for a in low] if i % 7 else None)
        seeds.append(sorted(rng.sample(range(300), rng.randint(1, 30))))
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array([None, *range(1, 50)], pa.int64()), "digest": pa.array(range(50), pa.int64()),
        "seeds": [np.array([(1000 + a, a) for a in s], dtype=np.int64).tobytes() for s in seeds],
        "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("removed", pa.bool_())])))})
    want = []
    for i, (mine, places) in enumerate(zip(spans, seeds)):
        for a in places:
            over = [s for s in mine or [] if s["first"] <= a and s["last"] >= a + paragraphs.SEED_WORDS]
            if not any(s["removed"] for s in over):
                want.append((1000 + a, i or None, i, a, bool(over)))
    for part in (batch, batch.slice(3, 20), batch.slice(0, 0)):
        got = [tuple(r.values()) for b in paragraphs._open_seeds([part]) for r in b.to_pylist()]
        assert got == [w for w in want if w[2] in part.column("digest").to_pylist()]
