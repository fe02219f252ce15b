from __future__ import annotations

import re
from collections import Counter

import numpy as np

from silsila.llm import neighbours, quality_rules
from silsila.llm.queries import QUERIES


def brute(t):
    w = re.findall("[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if n[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside)]


def test_base_counts(texts):
    odd = ["", "  \n", "a", "a b", "a a a", "a a a a", "x y z x y z", "\x1c\x85 a b", "é\n\né\n é\né", "|\n|\n|", "a b c\na b c"]
    for t in [*texts.values(), *odd]:
        assert quality_rules.statistics(t)[0] == brute(t)
    codes, many = quality_rules.word_codes([b"%d" % (i % 7) for i in range(100)])
    assert quality_rules.repeated_words(codes, many) == quality_rules.repeated_words(codes, 2_000_000) == 100


def auc(score, y):
    good, bad = score[y == 1], score[y == 0]
    return float(((good[:, None] > bad) + 0.5 * (good[:, None] == bad)).mean())


def test_trees_are_monotone_and_learn():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 0] - x[:, 1] + 0.3 * np.sin(9 * x[:, 2]) + 0.1 * rng.standard_normal(3000)) > 0).astype(float)
    trees = quality_rules.fit_trees(x[:2000], y[:2000], [1, -1, 0, 1])
    assert auc(trees.score(x[2000:]), y[2000:]) > 0.95
    for f, sign in ((0, 1), (1, -1), (3, 1)):
        more = x.copy()
        more[:, f] += rng.random(3000)
        assert (sign * (trees.score(more) - trees.score(x)) >= -1e-12).all()
    flat = [trees.roots[0]]                                     # the flat arrays against a walk of one row
    for i in range(50):
        total = trees.start
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if x[i, trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        assert abs(trees.score(x[i:i + 1])[0] - 1 / (1 + np.exp(-total))) < 1e-9
    assert flat


def test_rules_query(spark, sf, texts):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op1_quality_rules"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == brute(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    clean = [r.kept for r in got if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert np.mean(clean) > 0.97


def test_rules_on_odd_rows(odd, nothing, marks, no_marks):
    for labels in (marks, no_marks):
        got = {r.doc_id: r for r in quality_rules.quality_verdicts(odd, labels).collect()}
        assert got[1].base_failed and got[1].n_words == 0 and not got[1].kept and got[7].base_failed
        assert quality_rules.quality_verdicts(odd, labels).count() == odd.count()
        assert quality_rules.quality_verdicts(nothing, labels).count() == 0


def test_votes_are_those_of_the_nearest():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 4, (80, neighbours.WIDTH)).astype(np.float32) * (rng.random((80, neighbours.WIDTH)) < 0.02)
    idf = np.ones(neighbours.WIDTH, np.float32)
    basis = neighbours.latent_space(neighbours._weigh(counts, idf), 20).astype(np.float32)
    votes = rng.integers(0, 2, 60).astype(np.float32)
    m = neighbours.Neighbours(idf, basis, np.zeros((0, 20), np.float32), votes, float(votes.mean()), nearest=7)
    m.vectors = m.embed(counts[:60])
    got = m.score(counts, block=9)
    z = m.embed(counts)
    for i in range(80):
        s = z[i] @ m.vectors.T
        top = np.argsort(-s)[:7]
        w = np.exp(m.sharpness * (s[top].astype(float) - 1))
        tail = 0.1 * np.exp(-m.sharpness)
        assert abs(got[i] - ((w * votes[top]).sum() + tail * m.prior) / (w.sum() + tail)) < 1e-3
    assert np.allclose(m.score(np.zeros((1, neighbours.WIDTH), np.float32)), m.prior)


def test_classifier_held_out(spark, sf):
    sf = sf.replace("0.001", "0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in QUERIES["op8_quality_neighbours"](spark, sf).collect()]
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in got if r.held_out and r.doc_id in labels]
    score, y = np.array([r.score for r in held]), np.array([labels[r.doc_id] for r in held])
    assert auc(score, y) > 0.95 and ((score >= 0.3) == y).mean() > 0.95
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)


def test_classifier_on_odd_rows(odd, nothing, marks, no_marks):
    m = neighbours.train(odd, marks)
    got = {r.doc_id: r.score for r in neighbours.classify(odd, m).collect()}
    assert len(got) == 13 and got[1] == got[2] == m.prior
    assert neighbours.train(odd, no_marks) is None and neighbours.train(nothing, marks) is None
    assert {r.score for r in neighbours.classify(odd, None).collect()} == {0.5}
    assert neighbours.classify(nothing, m).count() == 0
