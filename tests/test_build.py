"""The whole job on a small Arabic library."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from silsila.plans import build as BD
from tests.conftest import rows


def page(no, *records, foot=""):
    body = " ".join(f'<span class="punct">{n} -</span> {text}' for n, text in records)
    note = f'<div class="footnote">{foot}</div>' if foot else ""
    return f'<div class="PageText"><div class="PageHead"><span class="PageNumber">{no}</span></div>{body}{note}</div>'


TERMINAL = "أن النبي صلى الله عليه وسلم قال الأعمال بالنيات"
BOOK = page(
    1,
    (1, f"حدثنا يوسف بن خالد بن عمير عن مالك بن أنس بن مالك عن نافع عن عمر بن حفص بن سعد {TERMINAL}"),
    (2, f"حَدَّثَنَا يُوسُفُ بْنُ خَالِدِ بْنِ عُمَيْرٍ عن أبيه عن مالك بن أنس بن مالك {TERMINAL}"),
    foot="حاشية على الحديث",
) + page(2, (3, f"حدثنا يوسف بن خالد بن عمير عن نافع عن عمر بن حفص بن سعد {TERMINAL}"), (4, "باب في السفر"), (5, f"حدثنا سعد بن هلال بن رافع عن مالك بن أنس بن مالك {TERMINAL}"))

ENTRIES = page(
    1,
    (1, "يوسف بن خالد بن عمير بن حازم، أبو يعقوب البصري روى عن: مالك بن أنس بن مالك، وخالد بن عمير بن حازم روى عنه: قتيبة بن سعيد بن جميل وقال يحيى: ثقة مأمون. ولد سنة خمسين ومائة"),
    (2, "مالك بن أنس بن مالك الأصبحي، أبو عبد الله المدني روى عن: نافع بن سالم بن زيد، وعمر بن حفص بن سعد روى عنه: يوسف بن خالد بن عمير، وقال أحمد: ثبت حجة"),
    (3, "نافع بن سالم بن زيد، مولى آل عمر روى عن: عمر بن حفص بن سعد روى عنه: مالك بن أنس بن مالك"),
) + page(
    2,
    (4, "نافع بن عمر بن جميل، المكي روى عن: عطاء بن أبي رباح روى عنه: قتيبة بن سعيد بن جميل"),
    (5, "عمر بن حفص بن سعد، القرشي روى عن: أبي بكر الصديق روى عنه: نافع بن سالم بن زيد"),
    (6, "خالد بن عمير بن حازم، السدوسي روى عن: مالك بن أنس بن مالك روى عنه: يوسف بن خالد بن عمير بن حازم"),
)
SUMMARIES = page(
    1,
    (1, "مالك بن أنس بن مالك الأصبحي ثقة من السابعة مات سنة تسع وسبعين ومائة"),
    (2, "نافع بن سالم بن زيد ثقة ثبت من الثالثة مات سنة سبع عشرة ومائة"),
    (3, "نافع بن عمر بن جميل ضعيف من السابعة"),
    (4, "سعد بن هلال بن رافع صدوق من السادسة"),
)
SECOND = page(
    1,
    (1, "مالك بن أنس بن مالك الأصبحي، روى عن: نافع بن سالم بن زيد، روى عنه: يوسف بن خالد بن عمير، وقال يحيى: ثقة. مات سنة 179"),
    (2, "نافع بن سالم بن زيد، روى عن: عمر بن حفص بن سعد وعنه: مالك بن أنس بن مالك"),
)


@pytest.fixture(scope="module")
def job(spark):
    def files(source, name, html):
        return spark.createDataFrame([(source, name, f"<html><body>{html}</body></html>")], "source string, file_name string, html string")

    corpus = BD.build_corpus(files("books", "كتاب السنن - المجلد 01", BOOK))
    entries = BD.build_entries(files("tk", "001", ENTRIES))
    summaries = BD.build_summaries(files("tq", "001", SUMMARIES))
    secondary = BD.build_secondary(files("tt", "001", SECOND), {"tt": None})
    occ = corpus["occurrences"]
    resolved = BD.resolve_anchors(occ, entries)
    made = BD.build_cards(resolved, entries, summaries)
    kept = {}
    final = BD.resolve_more(occ, resolved, entries, made, secondary, kept)
    made = BD.build_cards(final, entries, summaries)
    first = BD.resolve_cards(occ, final, made, summaries, secondary)
    return {"corpus": corpus, "entries": entries, "resolved": final, "made": made, "first": first, "occ": occ, "secondary": secondary,
            "kept": kept, "second": BD.build_second_evidence(made["anchors"], secondary)}


def test_corpus_layers(job):
    c = job["corpus"]
    assert rows(c["source_files"], "book", "volume", "kind") == [("كتاب السنن", 1, "volume")]
    assert c["records"].count() == 4          # the title is dropped
    assert rows(c["footnotes"], "layer", "text") == [("footnote", "حاشية على الحديث")]
    assert rows(c["chains"], "boundary_method") == [("prophet_boundary",)] * 4
    assert c["occurrences"].count() == 4 + 3 + 3 + 2
    assert job["entries"].count() == 6


def test_a_file_under_two_names_counts_once(spark, job):
    html = f"<html><body>{BOOK}</body></html>"
    twice = spark.createDataFrame([("books", "كتاب السنن - المجلد 01", html), ("books", "كتاب السنن", html), ("z", "كتاب السنن - المجلد 01", html)],
                                  "source string, file_name string, html string")
    c = BD.build_corpus(twice)
    assert rows(c["source_files"], "book", "volume", "kind") == [("كتاب السنن", None, "standalone")]
    assert rows(c["file_copies"], "source", "duplicate_of") == [("books", "books/كتاب السنن"), ("z", "books/كتاب السنن")]
    for layer in ("occurrences", "observed_edges"):
        ids = ["occurrence_id"] if layer == "occurrences" else ["from_name", "to_name", "evidence_count", "chain_count"]
        ids = [i for i in ids if i in c[layer].columns]
        assert rows(c[layer], *ids) == rows(job["corpus"][layer], *ids)
    assert c["occurrences"].count() == c["occurrences"].select("occurrence_id").distinct().count()


def test_library_bytes(spark, tmp_path):
    import hashlib
    folder = tmp_path / "books"
    folder.mkdir()
    raw = b"\xef\xbb\xbf<html>\xff</html>"
    (folder / "a b.htm").write_bytes(raw)
    got = BD.read_library(spark, str(tmp_path)).first()
    assert (got.source, got.file_name, got.sha256, got.size_bytes) == ("books", "a b", hashlib.sha256(raw).hexdigest(), len(raw))
    assert got.html.endswith("<html>\ufffd</html>")


def test_identities(job):
    names = {r["anchor"]: r["canonical_norm"] for r in job["entries"].collect()}
    got = {(r["chain"], r["seq"]): (names[r["entity"]], r["layer"]) for r in job["occ"].join(job["resolved"], "occurrence_id").selectExpr(
        "chain_id chain", "sequence_index seq", "entity", "layer").collect()}
    by_name = {}
    for (_, _), (name, layer) in got.items():
        by_name.setdefault(name, set()).add(layer)
    assert by_name["يوسف بن خالد بن عمير بن حازم"] == {"provisional_anchor"}
    assert by_name["خالد بن عمير بن حازم، السدوسي"] == {"strong_relational"}      # "his father"
    assert "strong_context" in by_name["نافع بن سالم بن زيد"]            # from the lists of both neighbours
    assert "نافع بن عمر بن جميل" not in by_name


def test_stages_tell_their_evidence(job):
    """One typed value through all stages, those of the cards included."""
    assert job["resolved"].schema["evidence"].dataType == job["first"]["card_map"].schema["evidence"].dataType
    told = {r["layer"]: r["evidence"] for r in job["first"]["card_map"].collect()}
    seed = told["unique_source_card_prefix"]
    assert (seed.name, seed.score, seed.prev) == ("سعد بن هلال بن رافع", 1.0, None)
    kin = {r["layer"]: r["evidence"] for r in job["resolved"].collect()}["strong_relational"]
    assert (kin.token, kin.score, kin.pass_no) == ("ابيه", 7.0, 1)
    assert rows(job["kept"]["kinship"], "token", "status") == [("ابيه", "resolved")]


def test_second_evidence(job):
    """C-07: statements, dates and grades of the matched secondary entries; grades only from sources of one critic."""
    second = job["second"]
    name = {r["anchor"]: r["canonical_norm"] for r in job["entries"].collect()}
    assert sorted(name[r.anchor].split("،")[0] for r in second["matches"].collect()) == ["مالك بن انس بن مالك الاصبحي", "نافع بن سالم بن زيد"]
    assert rows(second["statements"], "source", "critic", "statement", "judgment", "confidence") == [("tt", "يحيي", "ثقة", "thiqa", 0.88)]
    assert rows(second["dates"], "event", "year") == [("death", 179)]
    assert second["grades"].count() == 0
    named = job["secondary"].withColumn("source", F.lit("الكاشف"))
    grades = BD.build_second_evidence(job["made"]["anchors"], named)["grades"]
    assert rows(grades, "critic", "judgment") == [("الذهبي", "thiqa")]
    assert "سنة 179" in grades.first()["exact_text"]


def test_cards_first(job):
    layers = rows(job["first"]["card_map"].groupBy("layer").count())
    assert ("unique_source_card_prefix", 1) in layers                    # known to the summaries only
    provisional = rows(job["first"]["provisional"], "identity_text", "grade", "tabaqa", "occurrences")
    assert provisional == [("سعد بن هلال بن رافع", "saduq", 6, 1)]


def test_facts_and_relations(job):
    made = job["made"]
    rel = rows(made["relations"], "status")
    assert ("bilateral_reported",) in rel
    facts = {r["anchor"]: r for r in made["structured"].collect()}
    name = {r["anchor"]: r["canonical_norm"] for r in job["entries"].collect()}
    by_name = {name[a]: r for a, r in facts.items()}
    malik = next(r for n, r in by_name.items() if n.startswith("مالك"))
    assert (malik["grade"], malik["tabaqa"]) == ("thiqa", 7)
    yusuf = next(r for n, r in by_name.items() if n.startswith("يوسف"))
    assert yusuf["birth_year"] == 150
    critics = rows(made["statements"], "critic", "judgment")
    assert ("يحيي", "thiqa") in critics


def test_links_and_mart(job, tmp_path, spark):
    res = BD.analyze(job["occ"], job["resolved"], job["made"])
    statuses = {r[0] for r in rows(res["links"], "continuity_status")}
    assert "supported_reported_and_observed" in statuses
    total = res["branches"].selectExpr("sum(total_links - supported_links - warning_links - unresolved_links) d").first()["d"]
    assert total == 0
    queue = BD.candidate_queue(job["occ"], job["resolved"], job["made"])
    assert queue["summary"].filter("candidate_count < 1").count() == 0
    mart = BD.build_mart(job["corpus"], job["made"], job["first"], job["second"])
    refs = [r["statement_ref"][:3] for r in mart["critic_statements"].collect()]
    assert refs.count("S4:") == 1 and refs.count("S2:") == job["made"]["statements"].count()
    assert '"token":"ابيه"' in mart["sanad_nodes"].filter("occurrence_type <> 'named_candidate' AND card_ref IS NOT NULL").first()["evidence"]
    assert set(mart) == {"cards", "critic_statements", "sanads", "sanad_nodes", "sanad_edges", "branch_summary", "terminal_repairs"}
    nodes = mart["sanad_nodes"]
    assert nodes.count() == job["occ"].count() and nodes.select("occurrence_id").distinct().count() == nodes.count()
    from silsila.plans.mart import publish
    publish(str(tmp_path), **mart)
    for name, df in mart.items():
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == df.count()
    assert rows(mart["sanads"], "book", "volume")[0] == ("كتاب السنن", 1)
