"""Ordered rule lists turned into ``when`` cascades, plus number and class words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from silsila import lexicon as lx
from silsila.functions.text import HEADINGS, LIGHT, _col, collapse, fold_letters, normalize, strip_marks, trim_chars


def _plain(word: str, folded: bool) -> str:
    """Write a lexicon word the way the normaliser would."""
    if not folded:
        return word
    table = {ord(c): "ا" for c in lx.ALEF_FORMS} | {ord("ى"): "ي"}
    return " ".join(word.translate(table).split())


def contains_any(c, words, whole: bool = False, folded: bool = True) -> Column:
    """True when one of the words occurs; ``whole`` asks for word edges on both sides."""
    c = _col(c)
    words = [_plain(w, folded) for w in words]
    if whole:
        return c.rlike(lx.WORD_START + lx.any_of(words, vocal=False) + lx.WORD_END)
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def first_rule(c, rules, default=None, whole: bool = False, folded: bool = True) -> Column:
    """Label of the first rule one of whose words occurs in ``c``."""
    out = None
    for label, words in rules:
        test = contains_any(c, words, whole, folded)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(F.lit(default).cast("string"))


def shared_grade(c) -> Column:
    """Bring the grade labels of all rule lists to one vocabulary."""
    c = _col(c)
    return reduce(lambda acc, kv: F.when(c == kv[0], kv[1]).otherwise(acc), lx.GRADE_SYNONYMS.items(), c)


def summary_grade(c) -> Column:
    return first_rule(normalize(c, LIGHT), lx.SUMMARY_GRADES, whole=True)


def statement_judgment(c) -> Column:
    return first_rule(normalize(c, LIGHT), lx.STATEMENT_JUDGMENTS, default="other")


def secondary_grade(c) -> Column:
    return first_rule(normalize(c, HEADINGS), lx.SECONDARY_GRADES, default="other")


def source_card_grade(c) -> Column:
    return first_rule(normalize(c, HEADINGS), lx.SOURCE_CARD_GRADES)


def trait_flags(c, traits=lx.TRAITS) -> list[Column]:
    text = normalize(c, LIGHT)
    return [contains_any(text, words).cast("int").alias(f"has_{name}") for name, words in traits]


def number_words(c, values: dict[str, int] | None = None, conjunction: str = "و",
                 drop=("سنة",), trim: str = " ،؛.") -> Column:
    """Sum of the number words, NULL unless all tokens but at most one are number words."""
    if values is None:
        values = {**lx.NUMBER_ONES, **lx.NUMBER_TENS, **lx.NUMBER_HUNDREDS, **lx.NUMBER_TEEN}
        values = {_plain(k, True): v for k, v in values.items()}
    table = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    text = normalize(c, LIGHT)
    for word in drop:
        text = F.replace(text, F.lit(word), F.lit(""))
    toks = F.filter(F.split(trim_chars(text, trim), r"\s+"), lambda t: t != "")
    if conjunction:
        toks = F.transform(
            toks,
            lambda t: F.when(
                t.startswith(conjunction) & table[F.substring(t, F.lit(2), F.length(t))].isNotNull(), F.substring(t, F.lit(2), F.length(t))
            ).otherwise(t),
        )
    known = F.filter(F.transform(toks, lambda t: table[t]), lambda v: v.isNotNull())
    total = F.aggregate(known, F.lit(0), lambda a, v: a + v)
    return F.when((F.size(known) > 0) & (F.size(known) >= F.greatest(F.lit(1), F.size(toks) - 1)), total)


def class_ordinal(c, ordinals: dict[str, int] | None = None,
                  lead: str = lx.CLASS_LEAD) -> Column:
    """Generation class named after "from [the class]"."""
    ordinals = {_plain(k, True): v for k, v in (ordinals or lx.CLASS_ORDINALS).items()}
    table = F.create_map(*[F.lit(x) for kv in ordinals.items() for x in kv])
    words = lx.any_of(ordinals, vocal=False)
    hit = F.regexp_extract(normalize(c, LIGHT), lead + f"({words})", 1)
    return table[F.nullif(hit, F.lit(""))]


def light_text(c) -> Column:
    return F.trim(collapse(fold_letters(strip_marks(F.coalesce(_col(c), F.lit(""))))))
