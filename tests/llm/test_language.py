from __future__ import annotations

import math
import zlib

import numpy as np

from silsila.llm import langid
from silsila.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op10_language_id"](spark, sf).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == docs[r.doc_id] for r in got if r.held_out]
    assert np.mean(held) > 0.95


def test_odd_rows(odd, nothing):
    model = langid.train(odd)
    got = {(r.doc_id, r.lang_pred): r.score for r in langid.identify(odd, model).collect()}
    for i in (1, 2, 3, 4):
        assert got[(i, "und")] == 0.0
    assert got[(9, "en")] > 0 and langid.identify(odd, model).count() == odd.count()
    kept = langid.accept(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {None, 5, 6, 7, 8, 9, 10, 11, 12}
    empty = langid.train(nothing)
    assert empty.languages == [] and langid.identify(nothing, empty).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, empty).collect()} == {"und"}


def test_grams_stay_inside_texts():
    one = [np.concatenate([ids[s[0]:e[0]] for ids, s, e in langid.grams([t])] or [np.zeros(0)]) for t in ("ab cd", "", "x", "xyz")]
    parts = list(langid.grams(["ab cd", "", "x", "xyz"]))
    for d, want in enumerate(one):
        assert list(np.concatenate([ids[s[d]:e[d]] for ids, s, e in parts])) == list(want)
    assert [len(x) for x in one] == [5 + 4 + 3, 0, 1, 3 + 2 + 1]


def test_training_is_sparse_and_calibrated():
    rng = np.random.default_rng(0)
    rows, y = [], []
    for i in range(200):
        c = i % 2
        ids = np.array(sorted({int(x) for x in rng.integers(c * 20, c * 20 + 20, 6)} | {40 + int(rng.integers(0, 10))}))
        rows.append((ids, np.full(len(ids), 0.2)))
        y.append(c)
    w, bias = langid.fit_ftrl(rows, np.array(y), 2, 64, l1=0.5)
    assert (w[50:] == 0).all() and np.mean([(x @ w[i] + bias).argmax() == t for (i, x), t in zip(rows, y)]) > 0.95
    logits = rng.standard_normal((4000, 2))
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    targets = (rng.random(4000) < p[:, 1]).astype(int)
    assert abs(langid.fit_temperature(logits * 3, targets) - 3) < 0.4


def naive_grams(text, bits=langid.BITS):
    """Ids of all n-grams of a text, one character at a time."""
    codes, out = [ord(c) for c in " ".join(text.lower().split())], []
    for n in langid.ORDERS:
        for i in range(len(codes) - n + 1):
            h = 0
            for c in codes[i:i + n]:
                h = (h * 0x01000193 & 0xFFFFFFFF) ^ (c * 0x9E3779B1 & 0xFFFFFFFF)
            out.append((h * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - bits))
    return out


def test_probabilities_against_brute_force(make):
    """The trained model, read as w.x + b over naive TF-IDF vectors and a softmax, gives the probabilities of whole texts."""
    rows = [(i, text, lang) for i, (lang, text) in enumerate([("en", "the cat and the dog"), ("fr", "le chat et le chien"), ("de", "der Hund und die Katze")] * 12)]
    docs = make([(i, f"{t} {i}", lang) for i, t, lang in rows])
    model = langid.train(docs)
    texts = ["the cat", "", "Le  CHIEN\n7", "Katze " * 900, "ü中😀 x", "12 34"]
    got = model.probabilities(texts)
    for text, p in zip(texts, got):
        ids = naive_grams(text)
        z = [sum(float(model.table[c][g]) for g in ids) / max(len(ids), 1) + model.bias[c] for c in range(3)]
        e = [math.exp(v - max(z)) for v in z]
        assert np.allclose(p, [v / sum(e) for v in e], atol=1e-6)
    # document frequencies, one document at a time
    known = langid.learnable(docs)
    df, n = langid.document_frequencies(known.select("text"))
    want = np.zeros(1 << langid.BITS, dtype=int)
    learned = [r.text for r in known.collect()]
    for text in learned:
        want[list(set(naive_grams(text)))] += 1
    assert n == len(learned) and (df == want).all()


def test_training_against_one_step_at_a_time():
    """FTRL-proximal with scalars: every coordinate of every class by itself."""
    rng, k, width = np.random.default_rng(3), 3, 12
    rows = [(np.sort(rng.choice(width, 4, replace=False)), rng.random(4)) for _ in range(30)]
    y = rng.integers(0, k, 30)
    alpha, beta, l1, l2, epochs = 0.7, 1.0, 0.01, 0.1, 2
    w, bias = langid.fit_ftrl(rows, y, k, width, epochs, alpha, beta, l1, l2)
    z, n = [[[0.0] * k for _ in range(width + 1)] for _ in range(2)]

    def weight(i, c):
        if abs(z[i][c]) <= l1:
            return 0.0
        return -(z[i][c] - math.copysign(l1, z[i][c])) / ((beta * 1e-3 + math.sqrt(n[i][c])) / alpha + l2)

    held, order = [[0.0] * k for _ in range(width + 1)], np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            x = [*zip(rows[i][0].tolist(), rows[i][1].tolist()), (width, 0.05)]
            for j, _ in x:
                held[j] = [weight(j, c) for c in range(k)]
            s = [sum(v * held[j][c] for j, v in x) for c in range(k)]
            e = [math.exp(v - max(s)) for v in s]
            for j, v in x:
                for c in range(k):
                    g = v * (e[c] / sum(e) - (c == y[i]))
                    sigma = (math.sqrt(n[j][c] + g * g) - math.sqrt(n[j][c])) / alpha
                    z[j][c] += g - sigma * held[j][c]
                    n[j][c] += g * g
    assert np.allclose(w, held[:width]) and np.allclose(bias, np.array(held[width]) * 0.05)


def test_rare_languages_are_learned_at_every_size(make):
    """Four languages of 2 to 20 rows beside two of 1,500: each is in the sample, in the model and told apart."""
    rng = np.random.default_rng(6)
    letters = {"aa": "abcdef", "bb": "ghijkl", "cc": "mnopqr", "dd": "stuvwx", "ee": "αβγδεζ", "ff": "абвгде"}
    many = {"aa": 1500, "bb": 1500, "cc": 20, "dd": 8, "ee": 4, "ff": 2}
    rows, i = [], 0
    for lang, n in many.items():
        while n:
            i += 1
            if zlib.crc32(str(i).encode()) % 4 == 2:
                continue
            rows.append((i, " ".join("".join(rng.choice(list(letters[lang]), 5)) for _ in range(20)), lang))
            n -= 1
    docs = make(rows)
    sample = langid.stratified_sample(langid.learnable(docs.select("doc_id", "text", "lang")), 120)
    assert {r.lang for r in sample.collect()} == set(many) and sample.count() <= 240
    model = langid.train(docs, sample=120)
    assert model.languages == sorted(many)
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()}
    assert all(got[i] == lang for i, _, lang in rows if lang not in ("aa", "bb"))
