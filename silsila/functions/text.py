"""String normalisation as Column expressions. No UDF: everything stays in the JVM."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silsila import lexicon as lx


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_marks(c) -> Column:
    """Remove combining marks (vowel signs, Quranic signs)."""
    return F.regexp_replace(_col(c), f"[{lx.MARKS}]", "")


def fold_letters(c) -> Column:
    """Map alef forms and alef maqsura to their plain letters."""
    return F.translate(_col(c), lx.ALEF_FORMS + "ى", "ا" * len(lx.ALEF_FORMS) + "ي")


def collapse(c) -> Column:
    """Every run of white space (Unicode) becomes one space."""
    return F.regexp_replace(_col(c), r"(?U)\s+", " ")


def trim_chars(c, chars: str) -> Column:
    return F.btrim(_col(c), F.lit(chars))


def swap_token(c, old: str, new: str) -> Column:
    """Replace whole tokens only; a token inside a longer word is left alone."""
    return F.regexp_replace(_col(c), r"(?<![^ ])" + lx.quote(old) + r"(?![^ ])", new)


@dataclass(frozen=True)
class Profile:
    """One normalisation family. Both sides of a join must use the same one."""

    fold: bool = True
    drop_invisible: bool = True
    lineage: tuple = ()          # (old token, new token) pairs
    parentheses_up_to: int = 0   # remove "(...)" of at most this many characters
    blank: str = ""              # characters turned into spaces
    lower: bool = False
    trim: str = lx.NAME_TRIM


PLAIN = Profile()
LINEAGE = replace(PLAIN, lineage=(("ابن", "بن"),), trim=lx.HEADING_TRIM)
LISTS = replace(PLAIN, lineage=(("ابن", "بن"),), parentheses_up_to=30)
KINSHIP = replace(LISTS, parentheses_up_to=40)
HEADINGS = replace(LINEAGE, blank=lx.BRACKETS + lx.TATWEEL + lx.ZERO_WIDTH)
CARDS = replace(HEADINGS, lineage=(("ابن", "بن"), ("ابي", "ابو")))
LIGHT = Profile(drop_invisible=False, trim=" ")
PROFILES = {
    "plain": PLAIN, "lineage": LINEAGE, "lists": LISTS, "kinship": KINSHIP,
    "headings": HEADINGS, "cards": CARDS, "light": LIGHT,
}


def normalize(c, profile: Profile = PLAIN) -> Column:
    """Apply a profile; NULL becomes the empty string."""
    out = F.coalesce(_col(c).cast("string"), F.lit(""))
    out = strip_marks(out)
    if profile.lower:
        out = F.lower(out)
    if profile.fold:
        out = fold_letters(out)
    if profile.parentheses_up_to:
        out = F.regexp_replace(out, r"\([^)]{0,%d}\)" % profile.parentheses_up_to, " ")
    if profile.blank:
        out = F.translate(out, profile.blank, " " * len(profile.blank))
    if profile.drop_invisible:
        out = F.translate(out, lx.TATWEEL + lx.ZERO_WIDTH, "")
    out = trim_chars(collapse(out), profile.trim)
    for old, new in profile.lineage:
        out = swap_token(out, old, new)
    return out


def kunya_normalize(c, genitive: str = "ابي", base: str = "ابو") -> Column:
    """Kinship profile with the genitive kunya word turned into its base form."""
    return swap_token(normalize(c, KINSHIP), genitive, base)


def apply_rules(c, rules) -> Column:
    """Apply (pattern, replacement) rules in order."""
    out = _col(c)
    for pattern, replacement in rules:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def clean_phrase(c, grammar=lx.ARABIC) -> Column:
    """Cut honorifics, narration tails and route marks off a raw mention."""
    edge = lx.ZERO_WIDTH + grammar.trim
    return trim_chars(apply_rules(trim_chars(c, edge), grammar.phrase_rules), edge)


def strip_notes(c, grammar=lx.ARABIC) -> Column:
    """Drop editorial notes (wording notes, "all of them", "read to him")."""
    return trim_chars(apply_rules(F.trim(_col(c)), grammar.note_rules), grammar.trim)


def cut_at_words(c, words, stops: str = r".؛;:\[", trim: str = lx.NAME_TRIM) -> Column:
    """Text before the first of ``words`` or of the stop characters."""
    head = F.split(trim_chars(c, trim), lx.WORD_START + lx.any_of(words, vocal=False) + lx.WORD_END, 2)[0]
    return trim_chars(F.split(head, f"[{stops}]", 2)[0], trim)


def before(c, pattern: str, max_chars: int | None = None) -> Column:
    """Text before the first match of ``pattern``, at most ``max_chars`` long."""
    head = F.split(_col(c), pattern, 2)[0]
    return F.trim(F.substring(head, 1, max_chars) if max_chars else head)


def section(c, start: str, ends) -> Column:
    """Text between the first ``start`` label and the nearest of the ``ends`` labels, else ''."""
    after = F.split(_col(c), "(?i)" + start, 2)
    body = F.when(F.size(after) > 1, after[1]).otherwise(F.lit(""))
    return F.trim(F.split(body, "(?i)(?:" + "|".join(ends) + ")", 2)[0])


_LABEL = lx.spelled("روى")
FROM_LABEL = _LABEL + r"\s+" + lx.spelled("عن") + r"\s*:"
FROM_HIM_LABEL = _LABEL + r"\s+" + lx.spelled("عنه") + r"\s*:"
HEADING_LABELS = f"(?:{FROM_LABEL}|{FROM_HIM_LABEL})"
#: Later spelling of the labels: the colon may be missing, "from" is never "from him/her".
FROM_LABEL_LOOSE = _LABEL + r"\s+" + lx.spelled("عن") + r"(?![\p{L}\p{M}])\s*:?"
FROM_HIM_LABEL_LOOSE = (
    "(?:" + _LABEL + r"\s+(?:" + lx.spelled("عنه") + "|" + lx.spelled("عنها") + ")|"
    + lx.spelled("وعنه") + "|" + lx.spelled("وعنها") + r")(?![\p{L}\p{M}])\s*:?"
)
SAID_LABEL = "(?:" + lx.spelled("وقال") + "|" + lx.spelled("قال") + r")\s"
MENTIONED_LABEL = lx.any_of(("ذكره", "وذكره", "روى له", "وروى له"))


@dataclass(frozen=True)
class Labels:
    """Section labels of a biography: teachers, students, and where the lists end."""

    teachers: str = FROM_LABEL
    students: str = FROM_HIM_LABEL
    said: str = SAID_LABEL
    mentioned: str = MENTIONED_LABEL

    def heading_end(self) -> str:
        return f"(?:{self.teachers}|{self.students})"

    def teacher_list(self, c) -> Column:
        return section(c, self.teachers, [self.students, self.said])

    def student_list(self, c) -> Column:
        return section(c, self.students, [self.said, self.mentioned])


STRICT_LABELS = Labels()
LOOSE_LABELS = Labels(FROM_LABEL_LOOSE, FROM_HIM_LABEL_LOOSE)


def entry_heading(c, labels: str = HEADING_LABELS, max_chars: int = 900) -> Column:
    return before(c, labels, max_chars)


_SIGLA = rf"^\s*(?:[{lx.SIGLA_LETTERS}]+(?:\s+[{lx.SIGLA_LETTERS}]+)*\s*:)?\s*"
_HEADING_END = r"\s*\(\d+\)\s*[,،]|[,،]\s*" + lx.any_of(lx.HEADING_CUTS)


def canonical_name(c, sigla: str = _SIGLA, ends: str = _HEADING_END,
                   trim: str = lx.NAME_TRIM, max_chars: int = 400) -> Column:
    """Name part of a heading: source sigla dropped, cut at the first epithet or note number."""
    name = F.split(F.regexp_replace(_col(c), sigla, ""), ends, 2)[0]
    name = F.regexp_replace(name, r"\s*\(\d+\)\s*$", "")
    return F.substring(trim_chars(name, trim), 1, max_chars)


def identity_text(c, cuts=lx.IDENTITY_CUTS, max_chars: int = 600) -> Column:
    """Text of a summary entry before its first grade, class or death word."""
    body = F.trim(F.regexp_replace(_col(c), r"^\s*\d+\s*-\s*", ""))
    return F.trim(F.substring(F.split(body, r"\s+(?=" + lx.any_of(cuts, vocal=False) + ")", 2)[0], 1, max_chars))


def death_phrases(c, verbs=lx.DEATH_VERBS, stops: str = r".؛\[\]", limit: int = 3) -> Column:
    """Up to ``limit`` distinct death phrases, joined (the source rule keeps three)."""
    found = F.regexp_extract_all(_col(c), F.lit("(" + lx.any_of(verbs, vocal=False) + r"\s+.{0,180})"), F.lit(1))
    pieces = F.transform(found, lambda p: F.trim(F.split(p, f"[{stops}]", 2)[0]))
    return F.array_join(F.slice(F.array_distinct(F.filter(pieces, lambda p: p != "")), 1, limit), " | ")


def stable_id(prefix: str, *parts, n: int = 20) -> Column:
    """Prefix plus the first ``n`` hex digits of SHA-256 over the parts; NULL counts as ''."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\x1f", *texts), 256), 1, n))


def card_ref(card_type, card_id) -> Column:
    """Display reference: ``A:`` for an existing anchor, ``P:`` for a provisional card."""
    tag = F.when(_col(card_type) == "existing_anchor", F.lit("A:")).otherwise(F.lit("P:"))
    return F.concat(tag, _col(card_id))


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator of one row.

    Filters on, and further uses of, a plain projected column are inlined by the optimizer,
    which computes long regex chains many times over. A generator is a border for both.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
