from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from silsila.llm import alignment
from tests.llm.conftest import ODD

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def token_bytes(libraries, text):
    """(ids, bytes) of both sides by plain rules; none where a side does not spell the text."""
    a, b = libraries
    if not text:
        return [], [], [], []
    shown = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
    byte = {chr(c): c for c in shown} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in shown)}
    one, two = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in one]
    raw_b = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in two]
    whole = (" " + text).encode()
    return (one, two, raw_a, raw_b) if b"".join(raw_a) == whole == b"".join(raw_b) else ([], [], [], [])


def brute(libraries, rows):
    """Groups from sets of ends, links as all pairs of a group, counts by dictionary."""
    kept = []
    for doc_id, text in rows:
        one, two, raw_a, raw_b = token_bytes(libraries, text)
        ends_a, ends_b = np.cumsum([len(r) for r in raw_a]).tolist(), np.cumsum([len(r) for r in raw_b]).tolist()
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            u, v = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((one[i:u], two[j:v]))
            i, j = u, v
        kept.append((doc_id, one, two, groups, Counter((x, y) for g, h in groups for x in g for y in h)))
    count = Counter(pair for *_, pairs in kept for pair in pairs)
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for doc_id, one, two, groups, pairs in kept:
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((doc_id, len(one), len(two), len(groups), sum(pairs.values()),
                    sum(n for p, n in pairs.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in pairs.items()),
                    hashlib.sha256(said.encode()).hexdigest() if one else ""))
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


SIGNS = list("aaabbcdeehilnorst  \n\t▁éß中日本\U0001f600\x00<>0x41") + ["<|endoftext|>", "<s>", " ", "́"]


def test_random_texts_against_brute_force(make, libraries):
    rng = random.Random(5)
    some = [(i, "".join(rng.choice(SIGNS) for _ in range(rng.randrange(60)))) for i in range(600)]
    want = brute(libraries, some)
    assert rows(alignment.align_documents(make(some), A, B)) == want
    assert rows(alignment.align_documents(make(some), A, B, share=20)) == want          # nearly all pairs go through the join
    assert any(r[3] and r[4] > r[1] + r[2] - r[3] for r in want)                        # groups with several on both sides occur


def test_lanes_and_wide_groups_change_nothing(monkeypatch, libraries):
    aligner = alignment.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    rng = random.Random(6)
    texts = ["".join(rng.choice(SIGNS[:16]) for _ in range(4000)), "", "plain words here " * 300, "\U0001f600" * 50 + "日本" * 100, "x" * 999]
    want = aligner.align(texts)
    monkeypatch.setattr(alignment, "LANE", 3)
    monkeypatch.setattr(alignment, "LISTED", 5)
    found = aligner.align(texts)
    for name in want:
        assert list(found[name]) == list(want[name]) if name == "groups_sha256" else np.array_equal(
            found[name], want[name]) if isinstance(want[name], np.ndarray) else found[name].equals(want[name])


def test_odd_rows(odd, nothing, libraries):
    short = [r for r in ODD if r[0] not in (7, 8)]
    assert rows(alignment.align_documents(odd.filter("doc_id is null or doc_id not in (7, 8)"), A, B)) == brute(
        libraries, [(r[0], r[1]) for r in short])
    assert alignment.align_documents(nothing, A, B).count() == 0
    found = {r.doc_id: r for r in alignment.align_documents(odd, A, B).collect()}
    assert found[7].n_links == found[8].n_links >= 120_000 and found[1].groups_sha256 == "" and found[1].n_a == 0


def test_whole_table(spark, sf, texts, libraries):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert rows(alignment.align_documents(docs, A, B)) == brute(libraries, list(texts.items()))
