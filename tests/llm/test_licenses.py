from __future__ import annotations

import re

from pyspark.sql import functions as F

from silsila.llm import licenses
from silsila.llm.license_rules import ANCHORS, GROUPS, LONE_ANCHORS, PHRASES, RULES


def brute(text):
    """The scan without gates, in plain Python."""
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    flat = " " + " ".join(words) + " "
    base = [(i, label) for p, label in PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    found = []
    for r in RULES:
        for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", flat):
            first = flat.count(" ", 0, m.start()) - 1
            found.append((first, first + m[0].count(" "), r))
    kept = [(a, b, r) for a, b, r in found if not any(
        c <= a and d >= b and s.tier <= r.tier and ((c, d) != (a, b) or (s.tier, s.number) < (r.tier, r.number)) for c, d, s in found if s is not r or (c, d) != (a, b))]
    labels = {x for _, x in base} | {r.label for _, _, r in kept}
    at = [i for i, _ in base]
    score = 1.0 if base else max([r.confidence for _, _, r in kept], default=0.0)
    return (len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), score)


SAMPLES = [
    "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "Released under the MIT License. Under the MIT license!",
    "This work is licensed under the GNU General Public License, version 3.", "GNU Lesser General Public License v2.1 or GPL", "cc by nc cc by nc cc-by-nc",
    "SPDX-License-Identifier: BSD-3-Clause", "public\ndomain dedication", "see the Mozilla Public License version 2.0", "in the public domain",
    "All rights reserved. Copyright (c) 2021 by us", "an example of a reply with success", "UNDER THE MİT LICENSE under the mit licenſe", "under the MIT Kicense",
    "provided as is without any warranty of any kind", "the new BSD license, the 2-clause BSD license and MPL 1.1", "AGPLv3", "ASL 2.0", "under the mit license" * 3,
    "dual licensed under the terms of the MIT or the Apache license", "éunder the mit license", "under the mit licenseé", "Creative Commons Attribution ShareAlike 4.0",
]


def test_against_brute_force(make):
    got = licenses.scan_licenses(make(list(enumerate(SAMPLES)))).collect()
    for r in got:
        assert tuple(r)[1:] == brute(SAMPLES[r.doc_id]), SAMPLES[r.doc_id]


def test_rules_are_many_and_gated():
    assert len(RULES) > 300 and [r.number for r in RULES] == list(range(len(RULES)))
    for keywords, rules in GROUPS:
        for r in rules:
            names = re.compile(r.pattern)
            assert names.groups == 0
    # an anchor stands in every sample text in which the ungated scan finds something
    for s in SAMPLES:
        if brute(s)[1] or brute(s)[5]:
            low = s.lower()
            assert any(a in low for a in ANCHORS) or re.search(rf"(^|[^a-z])({'|'.join(LONE_ANCHORS)})([^a-z]|$)", low), s


def test_native_plan(odd):
    plan = licenses.scan_licenses(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_containment(spark):
    rows = [("k", "a", 3, 5, 0.8, 0, 9), ("k", "b", 4, 6, 0.6, 2, 5), ("k", "c", 2, 1, 0.9, 2, 5), ("k", "d", 3, 7, 0.8, 0, 9), ("k", "e", 4, 8, 0.6, 5, 12),
            ("j", "f", 4, 9, 0.6, 2, 5)]
    found = spark.createDataFrame(rows, "key string, label string, tier int, number int, confidence double, first bigint, last bigint")
    assert {r.label for r in licenses.resolve(found).collect()} == {"a", "c", "e", "f"}


def test_odd_rows(odd, nothing):
    got = licenses.scan_licenses(odd).collect()
    want = [(r.doc_id, *brute(r.text)) for r in odd.collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert licenses.scan_licenses(nothing).count() == 0
    assert licenses.scan_licenses(odd.withColumn("text", F.lit(None).cast("string"))).filter("n_words > 0 or labels <> ''").count() == 0
