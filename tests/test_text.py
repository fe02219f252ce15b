from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from silsila import lexicon as lx
from silsila.functions import keys as K
from silsila.functions import rules as R
from silsila.functions import text as T


def one(spark, value, *cols):
    row = spark.createDataFrame([(value,)], "s string").select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return row[0] if len(cols) == 1 else tuple(row)


def test_profiles(spark):
    assert one(spark, "أَحْمَد  بْنُ إبراهيم،", T.normalize("s")) == "احمد بن ابراهيم"
    assert one(spark, "أبي بكر ابن عياش", T.normalize("s", T.CARDS)) == "ابو بكر بن عياش"
    assert one(spark, None, T.normalize("s")) == ""
    assert one(spark, "علي (ت ١٢) بن [زيد]", T.normalize("s", T.LISTS)) == "علي بن [زيد]"
    assert one(spark, "علي بن [زيد]", T.normalize("s", T.HEADINGS)) == "علي بن زيد"
    assert one(spark, "ابنه ابن", T.normalize("s", T.LINEAGE)) == "ابنه بن"      # whole tokens only
    assert one(spark, "أبي بكر", T.kunya_normalize("s")) == "ابو بكر"


def test_ids_are_stable(spark):
    a, b, c = one(spark, "x", T.stable_id("A_", "s", F.lit(None)), T.stable_id("A_", "s", F.lit("")), T.stable_id("A_", F.lit(None), "s"))
    assert a == b and a != c and len(a) == 22


def test_entry_parts(spark):
    body = "ع: مالك بن أنس الأصبحي، أبو عبد الله روى عن: نافع، والزهري رَوَى عنه: شعبة وقال أحمد: ثقة"
    strict = T.STRICT_LABELS
    assert one(spark, body, T.canonical_name(T.entry_heading("s"))) == "مالك بن أنس الأصبحي"
    assert one(spark, body, strict.teacher_list("s")) == "نافع، والزهري"
    assert one(spark, body, strict.student_list("s")) == "شعبة"
    loose = "مالك روى عنه شعبة وعنها ليلى"
    assert one(spark, loose, T.LOOSE_LABELS.teacher_list("s")) == ""           # "from him" is not "from"
    assert one(spark, loose, T.LOOSE_LABELS.student_list("s")) == "شعبة وعنها ليلى"
    assert one(spark, "مالك بن أنس ثقة من السابعة", T.identity_text("s")) == "مالك بن أنس"
    assert one(spark, "ثقة مات سنة ستين. وقيل توفي سنة سبعين [كذا]", T.death_phrases("s")) == "مات سنة ستين"
    assert one(spark, "رافع بن خديج قال سمعت", T.cut_at_words("s", lx.RELATIVE_CUTS)) == "رافع بن خديج"


def test_number_and_class_words(spark):
    assert one(spark, "خمس وعشرين ومائة", R.number_words("s")) == 125
    assert one(spark, "سنة ثلاث عشرة ومائتين", R.number_words("s")) == 213
    assert one(spark, "في رمضان كذا", R.number_words("s")) is None
    assert one(spark, "ثقة من السابعة", R.class_ordinal("s")) == 7
    assert one(spark, "من الحادية عشرة", R.class_ordinal("s")) == 11


@pytest.mark.parametrize("text, grade", [
    ("ثقة، من السابعة", "thiqa"), ("ضعيف جدا", "very_weak"), ("كذاب", "matruk_kadhdhab"), ("ضعيف", "weak"), ("كلام", None)])
def test_summary_grades(spark, text, grade):
    assert one(spark, text, R.summary_grade("s")) == grade


def test_judgments(spark):
    assert one(spark, "ليس بثقة", R.statement_judgment("s")) == "weak"           # negations first
    assert one(spark, "لا بأس به", R.statement_judgment("s")) == "acceptable"    # also with its hamza
    assert one(spark, "فيه نظر", R.secondary_grade("s")) == "weak"
    assert one(spark, "مقبول", R.source_card_grade("s")) == "acceptable"
    assert one(spark, "matruk_kadhdhab", R.shared_grade("s")) == "rejected"
    assert one(spark, "صدوق يدلس سيئ الحفظ", *R.trait_flags("s")) == (1, 0, 0, 1)


def test_keys(spark):
    name = "عبد الله بن محمد بن علي"
    assert set(one(spark, name, K.specific_keys("s"))) == {name, "عبد الله بن محمد"}
    assert one(spark, "سفيان", K.specific_keys("s")) == ["سفيان"]
    assert one(spark, name, K.lineage_tail("s")) == "محمد بن علي"
    assert one(spark, "خ م مالك بن انس بن مالك الاصبحي", K.source_key("s")) == "مالك بن انس بن مالك"
    assert one(spark, "مالك بن", K.source_key("s")) is None
    assert one(spark, "مالك بن انس", K.lineage_eligible("s")) and not one(spark, "ابو بكر بن علي", K.lineage_eligible("s"))
    assert [p["key"] for p in one(spark, "a b", K.prefixes(K.tokens("s"), 3, 6))] == []      # shorter than lo
    assert [p["key"] for p in one(spark, "a b c", K.prefixes(K.tokens("s"), 2, 6))] == ["a b", "a b c"]
    assert [g["key"] for g in one(spark, "a b c", K.ngrams(K.tokens("s"), 2, 3))] == ["a b", "b c", "a b c"]
    assert set(one(spark, "جحيفة بن ابو طالب علي", K.own_kunya("s", F.lit("وهب، ويقال: ابو جحيفة")))) == {
        "ابو طالب", "ابو طالب علي", "ابو جحيفة"}
