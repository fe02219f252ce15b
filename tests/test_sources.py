from __future__ import annotations

import json

from pyspark.sql import functions as F

from silsila import lexicon as lx
from silsila.functions import text as T
from silsila.plans import build as BD
from silsila.sources import manifest as MF
from silsila.sources import pages as PG
from silsila.sources import tables as TB
from silsila.sources.search import phrase_pages
from silsila.sources.seeds import read_seed, seed_entities
from tests.conftest import rows

HTML = """<div class="PageText"><div class="PageHead"><span class="PageNumber">12</span> <span class="punct">9 -</span></div>
lead <span class="punct">1 -</span> one <b>bold</b> <span class="punct">:</span> more<sup><span class="punct">7 -</span></sup>
<span class="punct">(2) –</span> two &amp; three<div class="footnote"><span class="punct">5 -</span> note</div></div>
<div class="PageText"><span class="PageNumber">13</span> tail of two <span class="punct">3 -</span> last</div>"""


def files(spark, html=HTML, source="s", name="001"):
    return spark.createDataFrame([(source, name, html)], "source string, file_name string, html string")


def test_references(spark):
    texts = ["a &amp;lt; b", "&#8204;12 -", "x&#x41;&#X1F600;y", "caf&eacute; &hellip; &nosuch; & &;", "&apos;&quot;&#39;", "no reference", "&#xD800;&#0;", None, "&", "1&nbsp;2"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in rows(df.withColumn("o", PG.resolve_references("t")), "i", "o")]
    assert got == ["a &lt; b", "\u200c12 -", "xA\U0001f600y", "café … &nosuch; & &;", "'\"'", "no reference", "\ufffd\ufffd", None, "&", "1 2"]
    page = '<div class="PageText"><span class="punct">&#8204;12 -</span> one &copy; two</div>'
    pages = PG.split_pages(spark.createDataFrame([(page,)], "html string"))
    assert rows(PG.page_records(pages, ["page_no"]), "marker", "text") == [("12", "one © two")]


def test_page_records_and_footnotes(spark):
    pages = PG.split_pages(files(spark))
    assert rows(pages, "page_no", "page_label")[0] == (1, "12")
    got = rows(PG.page_records(pages, ["page_no"]), "page_no", "marker", "text")
    assert got == [(1, "1", "one bold more"), (1, "2", "two & three"), (2, "3", "last")]
    assert rows(PG.side_layers(pages, ["page_no"]), "page_no", "layer", "text") == [(1, "footnote", "5 - note")]


def test_nested_elements(spark):
    html = ('<div class="PageText"><div class="PageHead">head <div class="PageHead">inner</div><div>plain</div> more</div>lead '
            '<span class="punct"><span>1</span> -</span> one <div class="footnote">note <DIV class="x footnote">deep <div>plain</div></DIV> '
            'rest end</div> two<sup>a<sup>b</sup>c</sup> <span class="footnote">s<span>t</span></span>three</div></div> stray'
            '<div class="PageText"><span class="punct">2 -</span> last <div class="footnote">never <div>closed</div> here</div>')
    pages = PG.split_pages(files(spark, html))
    assert rows(PG.page_records(pages, ["page_no"]), "page_no", "marker", "text") == [(1, "1", "one two three stray"), (2, "2", "last")]
    assert rows(PG.side_layers(pages, ["page_no"]), "page_no", "layer_no", "text") == [
        (1, 1, "note deep plain rest end"), (1, 2, "deep plain"), (1, 3, "s t"), (2, 1, "never closed here")]


def test_unclosed_elements_run_to_the_end(spark):
    html = '<div class="PageText"><span class="punct">1 -</span> one <div class="footnote">note <div>open'
    pages = PG.split_pages(files(spark, html))
    assert rows(PG.page_records(pages, ["page_no"]), "marker", "text") == [("1", "one")]
    assert rows(PG.side_layers(pages, ["page_no"]), "text") == [("note open",)]


def test_control_references_and_raw_sentinels(spark):
    html = '<div class="PageText"><span class="punct">1 -</span> a&#1;7&#2;b &#x1; \x01 c \x02d &#9;e &lt;&amp;lt;&hellip;</div>'
    pages = PG.split_pages(files(spark, html))
    assert rows(PG.page_records(pages, ["page_no"]), "marker", "text") == [("1", "a\ufffd7\ufffdb \ufffd \ufffd c \ufffdd e <&lt;…")]


def test_many_tags_are_scanned_in_linear_time(spark):
    body = "<div>x</div>" * 20_000
    html = f'<div class="PageText"><span class="punct">1 -</span> one <div class="footnote">{body}</div> end</div>'
    pages = PG.split_pages(files(spark, html))
    assert rows(PG.page_records(pages, ["page_no"]), "marker", "text") == [("1", "one end")]


def test_entries_run_on_across_pages_and_files(spark):
    more = files(spark, '<div class="PageText">still last <span class="punct">4 -</span> end</div>', name="002")
    pages = BD.ordered_pages(files(spark).unionByName(more))
    bodies = PG.entry_bodies(PG.entry_parts(pages, "source", "page_order", layout=PG.ENTRY_PAGES, block=2), "source")
    assert rows(bodies, "number", "body") == [("1", "one bold : more"), ("2", "two & three 13 tail of two"), ("3", "last still last"), ("4", "end")]


def test_titled_entries(spark):
    html = ('<div class="PageText"><span data-type="title">[1] مالك بن أنس</span> ثقة <span data-type="title">باب الألف</span> كلام '
            '<span class="title">[2] نافع</span> مولى</div>')
    out = BD.build_secondary(files(spark, html, "src"), {"src": "bracketed"})
    assert rows(out, "entry_no", "heading", "body") == [(1, "مالك بن أنس", "مالك بن أنس ثقة كلام"), (2, "نافع", "نافع مولى")]
    allowed = spark.createDataFrame([("علي بن زيد",), ("باب علي بن زيد",), ("أبو بكر الصديق",), ("كلام",)], "h string")
    assert [r[0] for r in allowed.select(PG.heading_allowed("h", 4, 220)).collect()] == [True, False, True, False]


def test_file_names(spark):
    df = spark.createDataFrame([("كتاب", "j007"), ("كتاب", "المقدمة"), ("كتاب", "م 2"), ("كتاب", "كتاب"), ("كتاب", "فهرس/عام")], "book string, stem string")
    named = df.select(MF.classify_name("book", "stem", F.lit(".htm")).alias("f")).select("f.canonical_name", "f.kind", "f.volume").collect()
    assert [tuple(r) for r in named] == [
        ("كتاب - المجلد 07.htm", "volume", 7), ("كتاب - المقدمة.htm", "intro", None), ("كتاب - ملحق 2.htm", "supplement", None),
        ("كتاب.htm", "standalone", None), ("كتاب - فهرس - عام.htm", "named", None)]
    back = spark.createDataFrame([("كتاب - المجلد 07",), ("كتاب - ملحق 2",), ("كتاب - المقدمة",), ("كتاب",)], "stem string")
    assert [tuple(r[0]) for r in back.select(MF.parse_name("stem")).collect()] == [
        ("كتاب", 7, "volume"), ("كتاب", None, "supplement"), ("كتاب", None, "introduction"), ("كتاب", None, "standalone")]


def test_files_and_manifest(spark, tmp_path):
    for folder, name, text in (("a", "001.htm", "x"), ("a", "002.htm", "y"), ("b", "b.htm", "x")):
        (tmp_path / "in" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / folder / name).write_text(text, "utf-8")
    inv = MF.read_files(spark, str(tmp_path / "in")).withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))
    inv = inv.withColumn("ord", F.col("name")).withColumn("alone", F.col("name").startswith("b").cast("int"))
    out = MF.dedup_content(inv.drop("content"), preferred="alone")
    assert rows(out, "name", "canonical_name", "duplicate_of", "size_bytes") == [("001.htm", "b.htm", "b.htm", 1), ("002.htm", "002.htm", "", 1), ("b.htm", "b.htm", "", 1)]
    MF.write_manifest(out, str(tmp_path / "manifest"))
    assert spark.read.option("header", True).csv(str(tmp_path / "manifest" / "csv")).count() == 3
    assert spark.read.json(str(tmp_path / "manifest" / "json")).count() == 3
    pages = BD.read_library(spark, str(tmp_path / "in"))
    assert rows(pages, "source", "file_name", "html") == [("a", "001", "x"), ("a", "002", "y"), ("b", "b", "x")]


def test_seeds(spark, tmp_path):
    people = [{"id": 1, "shortName": "مالك", "longName": "مالك بن أنس", "deathYear": 179, "meta": {"k": 1}}, {"narrator_id": 2, "short_name": "نافع", "bio": "b"}]
    (tmp_path / "a.json").write_text(json.dumps(people, ensure_ascii=False), "utf-8")
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps(p, ensure_ascii=False) for p in people), "utf-8")
    for fmt in ("json", "jsonl"):
        got = seed_entities(read_seed(spark, str(tmp_path / f"a.{fmt}"), fmt))
        assert rows(got, "entity_id", "long_norm", "death_year", "metadata", "biography") == [(1, "مالك بن انس", 179, '{"k":1}', ""), (2, "", None, "", "b")]


def test_table_sinks(spark, tmp_path):
    old = spark.createDataFrame([(1, "candidate_only"), (2, "strong")], "k int, status string")
    new = spark.createDataFrame([(1, "strong_graph"), (2, "strong_graph"), (3, "strong_graph")], "k int, status string")
    assert rows(TB.upgrade_status(old, new, ["k"], [F.col("status")])) == [(1, "strong_graph"), (2, "strong"), (3, "strong_graph")]
    blank = spark.createDataFrame([(1, None), (2, "candidate_only")], "k int, status string")
    twice = spark.createDataFrame([(1, "b"), (3, "b"), (3, "a"), (2, "c")], "k int, status string")
    assert rows(TB.upgrade_status(blank, twice, ["k"], [F.col("status")])) == [(1, None), (2, "c"), (3, "a")]
    assert rows(TB.insert_absent(old, new, ["k"], [F.col("status")])) == [(1, "candidate_only"), (2, "strong"), (3, "strong_graph")]
    assert rows(TB.upsert(old, new, ["k"], [F.col("status")])) == [(1, "strong_graph"), (2, "strong_graph"), (3, "strong_graph")]
    for _ in range(2):
        TB.refresh(old, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_phrase_pages_keep_two_per_source(spark):
    pages = spark.createDataFrame([(i, "s", "x مالك بن أنس y", "x مالك بن انس y") for i in range(5)] + [(9, "t", "مالك بن انسان", "مالك بن انسان")], "page_id int, source string, text string, text_norm string")
    names = spark.createDataFrame([("a", "مالك بن أنس", "مالك بن انس")], "owner_id string, name_text string, key string")
    assert rows(phrase_pages(names, pages, lead=1, length=7), "page_id", "rank", "snippet") == [(0, 1, " مالك بن"[:8]), (1, 2, " مالك بن"[:8])]


def test_checkpoint_folder_comes_from_the_session(spark, tmp_path):
    from silsila.plans.session import checkpointed
    df = checkpointed(spark.range(3))
    assert df.count() == 3


def test_manifest_is_marked_and_comes_back(spark, tmp_path):
    rows_in = [(1, 'a, "b"\nc', ""), (2, "كتاب", "a"), (3, None, "")]
    df = spark.createDataFrame(rows_in, "id int, name string, duplicate_of string")
    MF.write_manifest(df, str(tmp_path))
    written = [f.read_bytes() for f in (tmp_path / "csv").glob("*.csv")]
    assert written and all(b.startswith("\ufeffid,name".encode()) for b in written)
    schema = "id int, name string, duplicate_of string"
    assert rows(MF.read_manifest(spark, str(tmp_path), schema, "json")) == sorted(rows_in, key=repr)
    assert rows(MF.read_manifest(spark, str(tmp_path), schema)) == sorted([(i, n or "", c) for i, n, c in rows_in], key=repr)


def test_a_heading_is_normalised_once(spark, tmp_path):
    from silsila.plans.catalog import QUERIES
    texts = ["محمد بن علي", "  أبو بكر.", "ذكر من اسمه محمد بن", "x", "اِبن زيد بن عمر"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, h string")
    marks = f"[{lx.MARKS}]"
    found = df.filter(PG.heading_allowed("h", 4, 220))
    assert found._jdf.queryExecution().optimizedPlan().toString().count(marks) == 1
    once = df.select("id", T.normalize("h", T.HEADINGS).alias("n"))
    assert rows(found, "id") == rows(once.filter(PG.heading_allowed("n", 4, 220, ready=True)), "id") == rows(once.filter(PG.heading_allowed("n", 4, 220)), "id")
    spark.createDataFrame([(1, "On the of. In x")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["heading_filter"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString().count(marks) == 1
