from __future__ import annotations

from pyspark.sql import functions as F

from silsila.functions import rules as R
from silsila.functions.text import normalize
from silsila.operators import evidence as EV
from silsila.operators import extract as E
from tests.conftest import rows

CHAIN = "حدثنا محمد بن جعفر عن شعبة عن قتادة عن أنس أن النبي صلى الله عليه وسلم قال كذا"


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values, 1)], "id int, text string")


def test_record_types(spark):
    long = " ".join(["كلمة"] * 30)
    got = rows(texts(spark, "باب الصلاة", CHAIN, "قال مالك " + long, long + " رسول الله", "قصير").select("id", E.classify_record("text").alias("k")))
    assert [k for _, k in got] == ["title", "hadith", "report", "report", "other"]
    assert rows(E.typed_records(texts(spark, "كِتَاب العلم", "قصير")), "id", "needs_review") == [(2, 1)]


def test_terminal_boundary(spark):
    r = E.extract_chains(texts(spark, CHAIN)).first()
    assert r["chain_raw"] == "حدثنا محمد بن جعفر عن شعبة عن قتادة عن أنس"
    assert (r["boundary_method"], r["confidence"], r["terminal_hint"], r["needs_extension_review"]) == ("prophet_boundary", 0.9, 1, 0)


def test_terminal_kept_after_heard(spark):
    r = E.extract_chains(texts(spark, "حدثنا علي بن محمد عن شعبة قال سمعت رسول الله صلى الله عليه وسلم يقول كذا")).first()
    assert r["chain_raw"].endswith("سمعت رسول الله صلى الله عليه وسلم يقول")


def test_reporter_and_open_boundaries(spark):
    reporter = "حدثنا علي عن شعبة عن قتادة قال: سمعت الحسن يقول: لا بأس به. ثم قال رسول الله كذا"
    r = E.extract_chains(texts(spark, reporter)).first()
    assert r["boundary_method"] == "reporter_boundary" and r["chain_raw"].endswith("يقول:")
    assert r["needs_extension_review"] == 1 and r["needs_review"] == 1
    r = E.extract_chains(texts(spark, "حدثنا علي بن محمد عن شعبة بلا نهاية")).first()
    assert (r["boundary_method"], r["confidence"]) == ("open_ended", 0.4)
    assert E.extract_chains(texts(spark, "كلام لا سند فيه", "حدثنا علي")).count() == 0


def test_continuation(spark):
    got = rows(texts(spark, " حَدَّثَنَا", "، وقال", "ثم").select("id", E.is_continuation("text").alias("c")))
    assert [c for _, c in got] == [True, True, False]


def mentions(spark, text):
    df = E.extract_mentions(texts(spark, text).withColumnRenamed("id", "chain_id"), text="text")
    return [tuple(r) for r in df.orderBy("sequence_index").select("sequence_index", "transmission_term", "normalized_name", "branch_hint", "mention_type").collect()]


def test_mentions(spark):
    got = mentions(spark, "حدثنا محمد بن جعفر عن شعبة عن قتادة عن أنس")
    assert [(g[0], g[1], g[2]) for g in got] == [(1, "حدثنا", "محمد بن جعفر"), (2, "عن", "شعبة"), (3, "عن", "قتادة"), (4, "عن", "انس")]
    assert [g[2] for g in mentions(spark, "حدثنا معن بن عيسى")] == ["معن بن عيسي"]          # no connector inside a word
    got = mentions(spark, "حدثنا قتيبة (ح) وحدثنا علي عن أبيه عن النبي")
    assert [(g[2], g[3], g[4]) for g in got] == [
        ("قتيبة", 0, "named_candidate"), ("علي", 1, "named_candidate"), ("ابيه", 1, "relational_or_unknown"), ("النبي", 1, "prophet_terminal")]


def test_embedded_mentions(spark):
    got = mentions(spark, "حدثنا مالك عن نافع أن عبد الله بن عمر أخبره، كذا")
    assert ("embedded_اخبره" in got[-1][1] or got[-1][1] == "embedded_أخبره") and got[-1][2] == "عبد الله بن عمر"
    assert [g[0] for g in got] == list(range(1, len(got) + 1))


def test_bare_route_mark_needs_a_route_verb(spark):
    got = mentions(spark, "حدثنا قتيبة ح وحدثنا علي عن زيد")
    assert [(g[2], g[3]) for g in got][1:] == [("علي", 1), ("زيد", 1)]
    assert [g[3] for g in mentions(spark, "حدثنا قتيبة ح عن علي عن زيد")] == [0, 0, 0]
    assert [g[3] for g in mentions(spark, "حدثنا قتيبة ( ح ) عن علي")] == [0, 1]


def test_offsets_are_text_positions(spark):
    text = "حَدَّثَنَا قتيبة عن الليث  عن  نافع"
    df = E.extract_mentions(texts(spark, text).withColumnRenamed("id", "chain_id"), text="text")
    for r in df.collect():
        assert text[r["start"]:].replace("َ", "").replace("ّ", "").startswith(r["transmission_term"])


def atoms(spark, value, **kw):
    return spark.createDataFrame([(value,)], "s string").select(E.atomic_names("s", **kw).alias("a")).first()["a"]


def test_atoms(spark):
    assert atoms(spark, "أبو بكر وعثمان") == ["أبو بكر", "عثمان"]
    assert atoms(spark, "وكيع") == ["وكيع"]
    assert atoms(spark, "وكيع", strict_conjunction=False) == ["كيع"]                         # the loose rule eats the letter
    assert atoms(spark, "قتيبة بن سعيد، ومالك بن أنس واللفظ لقتيبة") == ["قتيبة بن سعيد", "مالك بن أنس"]
    df = spark.createDataFrame([(1, "قتيبة ومالك", "named_candidate"), (2, "أبيه", "relational_or_unknown")], "m int, raw_name string, mention_type string")
    got = E.atomic_occurrences(df, ["m"])
    assert rows(got, "m", "atomic_index", "is_group", "needs_review") == [(1, 1, 1, 0), (1, 2, 1, 0), (2, 1, 0, 1)]


def test_list_segments(spark):
    df = spark.createDataFrame([("نافع مولى ابن عمر، ومالك بن أنس، ويحيى (خ)؛ با",)], "s string")
    assert df.select(E.list_segments("s").alias("x")).first()["x"] == ["نافع مولي بن عمر", "مالك بن انس", "يحيي"]


def test_terminal_repair(spark):
    df = texts(spark, "النبي صلى الله عليه وسلم", "عائشة قالت قال رسول الله", "ثوبان مولى رسول الله", "علي").withColumnRenamed("text", "raw_atomic_name")
    assert rows(E.repair_terminals(df), "id", "repair_kind", "hidden_name", "needs_terminal", "needs_review") == [
        (1, "pure_prophet", "", 1, 0), (2, "narrator_plus_prophet", "عائشة", 1, 0),
        (3, "narrator_descriptor_only", normalized(spark, "ثوبان مولى رسول الله"), 0, 0), (4, "other", "علي", 0, 1)]


def normalized(spark, value):
    return spark.createDataFrame([(value,)], "s string").select(normalize("s")).first()[0]


def test_statements(spark):
    body = "مالك بن أنس. قال يحيى عن أحمد: ثقة ثبت. وقال رسول الله: ثقة. وقال علي: كان يصلي"
    df = texts(spark, body).select("id", F.explode(EV.statements(R.light_text("text"))).alias("s"))
    assert rows(df, "s.critic", "s.attribution", "s.statement") == [("احمد", "يحيي عن احمد", "ثقة ثبت")]


def test_dates(spark):
    df = texts(spark, "ولد في مكة سنة خمسين وهو صغير، مات بالمدينة سنة تسع وسبعين ومائة")
    words = df.select(F.explode(EV.word_dates(R.light_text("text"))).alias("d"))
    assert rows(words, "d.event", "d.year", "d.confidence") == [("birth", 50, 0.92), ("death", 179, 0.92)]
    df = texts(spark, "مات بمكة سنة (179) وقيل ولد عام 93")
    assert rows(df.select(F.explode(EV.digit_dates("text")).alias("d")), "d.event", "d.year") == [("birth", 93), ("death", 179)]


def test_best_years(spark):
    df = spark.createDataFrame([(1, "birth", 50, 0), (1, "birth", 60, 1), (1, "birth", 60, 2), (1, "death", 100, 3), (1, "death", 90, 4), (2, "birth", 7, 1), (2, "birth", 6, 0)],
                               "entity int, event string, year int, pos int")
    assert rows(EV.best_years(df)) == [(1, 60, 90), (2, 6, None)]


def test_source_grades(spark):
    df = spark.createDataFrame([("الكاشف في معرفة", "فلان ثقة"), ("التاريخ الكبير", "فيه نظر"), ("ميزان", "ثقة")], "source string, body string")
    assert rows(EV.source_grades(df, "source", "body"), "critic", "judgment") == [("البخاري", "weak"), ("الذهبي", "thiqa")]


def test_a_route_mark_that_closes_a_connector_counts_half(spark, tmp_path):
    import duckdb

    from silsila.plans.catalog import ORACLES, QUERIES
    from tests.oracle import compare
    data = ["the\nAda of Bea", "a\nthe\nAda of\nBea de Cid", "the \nAda of Bea", "the\n\nAda of Bea", "the the\nthe Ada", "x\n\ny the Ada\nof\nBea\nla\nCid the Dan",
            "the\nof\nla\nde Ada", "", "the", "\nthe\n"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, x) for i, x in enumerate(data)])
    con.execute(f"COPY documents TO '{tmp_path}/documents.parquet' (FORMAT parquet)")
    ok, note = compare(QUERIES["mentions"](spark, str(tmp_path)), con, ORACLES["mentions"])
    assert ok, note
