"""Word lists and patterns, kept apart from the logic that uses them.

Operators take these as parameters. The defaults are Arabic; the test tables use
lexicons of their own (see ``silsila.plans``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These decide the results and are stated as they are.
# ---------------------------------------------------------------------------

#: Combining marks removed before any comparison (regex class body).
MARKS = "\u0610-\u061A\u064B-\u065F\u0670\u06D6-\u06ED"
ALEF_FORMS = "ٱأإآ"
ZERO_WIDTH = "\u200c\u200d\u200e\u200f"
TATWEEL = "\u0640"
NAME_TRIM = " ،؛;:.()-"
HEADING_TRIM = " ،؛;:.-"
BRACKETS = "[]«»()"

TITLE_PREFIXES = ("باب", "كتاب", "أبواب", "فصل", "المقدمة", "مقدمة")
OPENERS = ("حدثنا", "حدثني", "أخبرنا", "أخبرني", "أنبأنا", "سمعت")
BARE_OPENERS = ("حدثنا", "حدثني", "اخبرنا", "اخبرني", "انبانا", "سمعت")
REPORT_OPENERS = ("قال", "عن")
CONTINUATIONS = (
    "حدثنا", "وحدثنا", "حدثني", "وحدثني", "اخبرنا", "واخبرنا", "اخبرني", "واخبرني",
    "انبانا", "وانبانا", "سمعت", "وسمعت", "قالا", "وقالا", "قال", "وقال", "انه سمع",
    "انها سمعت", "اخبره", "اخبرها",
)
TERMINAL_SUBJECTS = ("رسول الله", "النبي")
TERMINAL_LINKS = ("أن", "أنه", "أنها")
HEARD = ("سمعت", "رأيت")
SAID = ("قال",)
SAID_AFTER_HEARD = ("يقول", "قال")
BLESSING = "صلى الله عليه وسلم"
NEAR_VERBS = ("عن", "اخبر", "حدث", "سمع", "قال")
TRANSMISSION_STEMS = ("عن", "حدث", "اخبر", "سمع")

CONNECTORS = (
    "حدثنا", "حدثني", "أخبرنا", "اخبرنا", "أخبرني", "اخبرني", "أنبأنا", "انبأنا",
    "عن", "سمعت", "أنه سمع", "أنها سمعت",
)
EMBEDDED_LEADS = ("أن",)
EMBEDDED_VERBS = ("أخبره", "أخبرها", "قال")
ROUTE_VERBS = ("حدث", "أخبر")
HONORIFICS = ("رضي الله عنهما", "رضي الله عنه", "رضي الله عنها", "رحمه الله", "رحمها الله")
PHRASE_CUTS = ("على المنبر", "في قوله تعالى", "رواية")
PHRASE_TAILS = ("أنها قالت", "أنه قال", "يقول", "قال", "قالا", "نحوه")
SAID_BEFORE_COLON = ("قال", "قالا")

RELATIONAL_MENTIONS = (
    "ابيه", "ابيها", "ابوه", "ابوها", "عمه", "عمهما", "جده", "امه", "اخيه",
    "رجل", "بعض اصحابه", "من حدثه", "شيخ", "رجل من اصحابه",
)
RELATIONAL_ATOMS = (
    "ابي", "ابيه", "ابيها", "ابوه", "ابوها", "عمه", "عمهما", "جده", "امه", "اخيه", "رجل", "شيخ",
)
KIN_TOKENS = ("ابيه", "ابي", "ابيها", "جده", "عمه", "اخيه", "امه")
FATHER_TOKENS = ("ابيه", "ابي", "ابيها")
GRANDFATHER_TOKENS = ("جده",)
RELATIVE_CUTS = (
    "انه", "انها", "ان", "قال", "قالت", "حدثه", "حدثها", "اخبره", "اخبرها", "سمع", "سمعت",
    "وكان", "وكانت", "فانه", "ومن طريق", "اخرجه", "ذكره", "فذكره", "يروي", "روى",
)

NOTE_HEADS = ("قال", "واللفظ", "لفظه", "قالا")
WORDING_NOTES = ("واللفظ", "اللفظ")
GROUP_NOTES = ("قالوا", "جميعا", "جميعهم")
READING_NOTES = ("قراءة عليه وانا اسمع", "قراءة عليه وأنا أسمع", "قراءة عليه")
ATOM_TAILS = ("وانا اسمع", "وأنا أسمع", "نحوه", "قالت", "يقول", "قال", "قالا")

#: Words that may open a name after a conjunction.
NAME_STARTS = (
    "أبو", "أبي", "ابو", "ابي", "ابن", "عبد", "محمد", "احمد", "أحمد", "يحي", "يحيى", "زهير",
    "قتيبة", "اسحاق", "إسحاق", "عثمان", "عمرو", "سعيد", "سفيان", "شعبة", "حماد", "هشام",
    "مالك", "نافع", "عروة", "علقمة", "عبيد", "الحارث", "سليمان", "موسي", "موسى", "خالد",
    "جرير", "وكيع", "الليث", "يونس", "ايوب", "أيوب", "ابراهيم", "إبراهيم", "منصور", "عكرمة",
    "عطاء", "انس", "أنس", "عائشة", "جابر", "معمر", "ثابت", "سالم", "يزيد", "علي", "على",
    "الزهري", "الاعمش", "الأعمش", "قتادة", "الاوزاعي", "الأوزاعي", "الشعبي", "الأعرج",
    "الحسن", "الضحاك", "مجاهد", "طاوس", "مسروق",
)

NUMBER_ONES = {
    "صفر": 0, "واحد": 1, "واحدة": 1, "احد": 1, "احدى": 1, "اثنان": 2, "اثنين": 2, "اثنتان": 2,
    "اثنتين": 2, "اثنتي": 2, "اثنتا": 2, "ثلاث": 3, "ثلاثة": 3, "اربع": 4, "اربعة": 4, "خمس": 5,
    "خمسة": 5, "ست": 6, "ستة": 6, "سبع": 7, "سبعة": 7, "ثمان": 8, "ثماني": 8, "ثمانية": 8,
    "تسع": 9, "تسعة": 9,
}
NUMBER_TENS = {
    "عشرون": 20, "عشرين": 20, "ثلاثون": 30, "ثلاثين": 30, "اربعون": 40, "اربعين": 40,
    "خمسون": 50, "خمسين": 50, "ستون": 60, "ستين": 60, "سبعون": 70, "سبعين": 70,
    "ثمانون": 80, "ثمانين": 80, "تسعون": 90, "تسعين": 90,
}
NUMBER_HUNDREDS = {
    "مئة": 100, "مائة": 100, "مئه": 100, "مائتين": 200, "مئتين": 200, "مائتان": 200,
    "مئتان": 200, "ثلاثمئة": 300, "ثلاثمائة": 300, "اربعمئة": 400, "اربعمائة": 400,
    "خمسمئة": 500, "خمسمائة": 500,
}
NUMBER_TEEN = {"عشر": 10, "عشرة": 10}
CLASS_ORDINALS = {
    "الاولى": 1, "الاول": 1, "الثانية": 2, "الثاني": 2, "الثالثة": 3, "الثالث": 3,
    "الرابعة": 4, "الرابع": 4, "الخامسة": 5, "الخامس": 5, "السادسة": 6, "السادس": 6,
    "السابعة": 7, "السابع": 7, "الثامنة": 8, "الثامن": 8, "التاسعة": 9, "التاسع": 9,
    "العاشرة": 10, "العاشر": 10, "الحادية عشرة": 11, "الحادي عشر": 11,
    "الثانية عشرة": 12, "الثاني عشر": 12,
}

SUMMARY_GRADES = (
    ("matruk_kadhdhab", ("كذاب", "وضاع", "متروك")),
    ("very_weak", ("ضعيف جدا", "واهي الحديث", "منكر الحديث", "ساقط")),
    ("weak", ("ضعيف", "لين الحديث", "لين")),
    ("unknown", ("مجهول الحال", "مجهول", "مستور")),
    ("acceptable", ("مقبول",)),
    ("saduq", ("صدوق",)),
    ("thiqa", ("ثقة",)),
    ("companion", ("صحابي", "له صحبة")),
)
STATEMENT_JUDGMENTS = (
    ("rejected", ("كذاب", "وضاع", "متروك")),
    ("weak", ("ليس بثقة", "ليس ثقة", "لا يكتب حديثه", "لا يحتج به", "ليس بالقوي", "ليس بقوي",
              "منكر الحديث", "واهي الحديث")),
    ("weak", ("ضعيف", "لين الحديث")),
    ("unknown", ("مجهول",)),
    ("acceptable", ("لا بأس به", "ليس به بأس")),
    ("saduq", ("صدوق",)),
    ("thiqa", ("ثقة", "ثبت", "حجة")),
    ("acceptable", ("صالح الحديث",)),
    ("praise", ("حافظ", "امام")),
)
SECONDARY_GRADES = (
    ("rejected", ("كذاب", "وضاع", "متروك")),
    ("very_weak", ("ضعيف جدا", "واهي الحديث", "منكر الحديث")),
    ("weak", ("ضعيف", "ليس بالقوي", "فيه نظر", "لين الحديث", "لا يحتج")),
    ("unknown", ("مجهول",)),
    ("acceptable", ("لا باس به", "ليس به باس", "صالح الحديث")),
    ("saduq", ("صدوق",)),
    ("thiqa", ("ثقة", "ثبت", "حجة")),
)
SOURCE_CARD_GRADES = (
    ("rejected", ("كذاب", "وضاع", "متروك")),
    ("very_weak", ("ضعيف جدا", "واهي الحديث", "منكر الحديث")),
    ("weak", ("ضعيف", "ليس بالقوي", "فيه نظر", "لين الحديث")),
    ("unknown", ("مجهول",)),
    ("acceptable", ("مقبول",)),
    ("saduq", ("صدوق",)),
    ("thiqa", ("ثقة", "ثبت", "حجة")),
    ("companion", ("صحابي", "صحابية")),
)
TRAITS = (
    ("tadlis", ("دلس", "مدلس")),
    ("ikhtilat", ("اختلط", "اختلاط")),
    ("late_memory_change", ("تغير حفظه", "تغير باخره", "تغير باخرة")),
    ("poor_memory", ("سيء الحفظ", "سئ الحفظ", "سيئ الحفظ")),
)
STATEMENT_WORDS = (
    "ثقة", "ضعيف", "صدوق", "حجة", "ثبت", "لا بأس به", "ليس به بأس", "متروك", "كذاب", "مجهول",
    "لين", "صالح الحديث", "سيئ الحفظ", "سيء الحفظ", "ليس بالقوي", "ليس بقوي", "لا يحتج", "حافظ",
    "امام",
)
SECONDARY_STATEMENT_WORDS = (
    "ثقة", "صدوق", "ضعيف", "متروك", "كذاب", "مجهول", "لا بأس به", "ليس به بأس", "ليس بالقوي",
    "فيه نظر", "لين", "حجة", "ثبت", "حافظ", "صالح الحديث", "سيئ الحفظ", "سيء الحفظ",
    "منكر الحديث", "واهي الحديث",
)
EXCLUDED_ATTRIBUTIONS = ("رسول الله", "النبي", "الرجل", "بعض الفقهاء", "موضع اخر", "موضع آخر")
SECONDARY_EXCLUDED_ATTRIBUTIONS = ("رسول الله", "النبي")
HEADING_EXCLUSIONS = (
    "باب", "حرف", "فصل", "القسم", "مقدمة", "من اسمه", "ذكر من", "الكنى", "النساء", "دراسة", "جوانب",
)
IDENTITY_CUTS = (
    "ثقة", "صدوق", "ضعيف", "مقبول", "مجهول", "متروك", "كذاب", "لين", "صحابي", "صحابية", "مستور",
    "لا بأس به", "ليس به بأس", "سيئ الحفظ", "سيء الحفظ", "حافظ", "إمام", "امام", "فقيه",
    "صالح الحديث", "رمي ب", "اتهم ب", "من الطبقة", "مات سنة",
)
HEADING_CUTS = (
    "أبو", "ابو", "ويقال", "وهو", "مولى", "له صحبة", "من أهل", "الكوفي", "البصري", "المدني",
    "المكي", "الشامي", "القرشي", "الثقفي", "الانصاري", "الأنصاري",
)
SIGLA_LETTERS = "خمدتسقعربك4"
SOURCE_SIGLA = ("ع", "خ", "م", "د", "ت", "س", "ق", "بخ", "4")
DEATH_VERBS = ("مات", "توفي", "توفى", "قتل")
DEATH_VERBS_WORDS = ("مات", "توفي", "توفى")
BIRTH_VERBS = ("ولد", "ولدت", "مولده")
YEAR_WORDS = ("سنة", "عام")
DATE_TAILS = ("وهو", "وله", "وكان", "ودفن", "عن", "قال")
SOURCE_GRADE_TRIGGERS = {
    "الكاشف": (("ثقة", "صدوق", "ضعيف", "متروك", "لا باس به", "حجة", "ثبت", "حافظ", "لين"), None, "الذهبي", 0.86),
    "التاريخ الكبير": (("فيه نظر", "منكر الحديث", "كثير الوهم", "لا يتابع", "سكتوا عنه"), None, "البخاري", 0.90),
}
WEAK_GRADES = ("weak", "very_weak", "rejected", "unknown")
#: Statuses of resolutions that count as evidence for unique prefixes.
TRUSTED_STATUSES = (
    "provisional_anchor", "strong_context", "strong_graph", "strong_relational", "strong_relational_named", "strong_secondary_alias",
)
#: One shared grade vocabulary: spellings of the same class in the four rule lists.
GRADE_SYNONYMS = {"matruk_kadhdhab": "rejected"}
#: Patterns of a narrator joined to a terminal; SUBJECT stands for the terminal words.
TERMINAL_REPAIR_PATTERNS = (
    r"\s+(?:قالت|قال|يقول|يقولون)\s*:?\s*(?:قال\s+)?SUBJECT",
    r"\s+(?:سمعت|سمع)\s+SUBJECT",
    r"\s+(?:ان|انه|انها)\s+SUBJECT",
    r"\s+(?:يبلغ به|رفعه الي|رفعه إلى)\s+SUBJECT",
)
#: Words before a generation class, and the marker that opens a numbered record.
CLASS_LEAD = r"(?:من\s+(?:رؤوس\s+)?(?:الطبقة\s+)?|الطبقة\s+)"
RECORD_MARKER = r"^\s*[\u200c\u200d\u200e\u200f]*\(?(\d{1,6})\)?\s*[-–—]\s*$"

# ---------------------------------------------------------------------------
# Pattern building (Java regex).
# ---------------------------------------------------------------------------

#: Left and right edges of a word. ``\b`` moves on vocalised text, these do not.
WORD_START = r"(?<![\p{L}\p{M}\p{N}_])"
WORD_END = r"(?![\p{L}\p{M}\p{N}_])"
#: Edge that lets a bare conjunction letter with its vowel mark stand before the word.
LOOSE_START = r"(?<![\p{L}\p{N}_])"


def quote(text: str) -> str:
    """Escape for Java regex (``re.escape`` is compatible for the characters in use)."""
    return re.escape(text)


def spelled(word: str, bounded: bool = False) -> str:
    """Pattern for ``word`` under any vocalisation; a space is any run of white space."""
    marks = f"[{MARKS}]" + ("{0,3}" if bounded else "*")
    gap = r"\s{1,3}" if bounded else r"\s+"
    return "".join(gap if ch == " " else quote(ch) + marks for ch in word)


def any_of(words, vocal: bool = True, bounded: bool = False) -> str:
    """Alternation, longest word first so that no word hides a longer one."""
    ordered = sorted(dict.fromkeys(words), key=lambda w: (-len(w), w))
    return "(?:" + "|".join(spelled(w, bounded) if vocal else quote(w) for w in ordered) + ")"


@dataclass(frozen=True)
class ChainGrammar:
    """Word lists that drive record typing, chain boundaries and mention extraction."""

    title_prefixes: tuple = TITLE_PREFIXES
    openers: tuple = OPENERS
    bare_openers: tuple = BARE_OPENERS
    conjunctions: tuple = ("و", "ف")
    report_openers: tuple = REPORT_OPENERS
    continuations: tuple = CONTINUATIONS
    terminal_subjects: tuple = TERMINAL_SUBJECTS
    terminal_links: tuple = TERMINAL_LINKS
    heard: tuple = HEARD
    said: tuple = SAID
    said_after_heard: tuple = SAID_AFTER_HEARD
    blessing: str = BLESSING
    boundary_chars: str = ":؛;"
    near_verbs: tuple = NEAR_VERBS
    transmission_stems: tuple = TRANSMISSION_STEMS
    connectors: tuple = CONNECTORS
    embedded_leads: tuple = EMBEDDED_LEADS
    embedded_verbs: tuple = EMBEDDED_VERBS
    route_mark: str = "ح"
    route_verbs: tuple = ROUTE_VERBS
    relational: tuple = RELATIONAL_MENTIONS
    relational_atoms: tuple = RELATIONAL_ATOMS
    name_starts: tuple = NAME_STARTS
    list_marks: str = "،,"
    trim: str = NAME_TRIM
    phrase_rules: tuple = field(default_factory=lambda: phrase_rules())
    note_rules: tuple = field(default_factory=lambda: note_rules())

    def conj(self) -> str:
        if not self.conjunctions:
            return ""
        return f"(?:[{''.join(self.conjunctions)}][{MARKS}]*)?"


def phrase_rules() -> tuple:
    """(pattern, replacement) rules that cut a raw mention down to the name."""
    return (
        (r"(?s)[،,]\s*" + any_of(EMBEDDED_LEADS) + r"(?=\s).*$", ""),
        (r"(?s)\s+" + any_of(HONORIFICS) + r".*$", ""),
        (r"(?s)\s+" + any_of(PHRASE_CUTS) + WORD_END + r".*$", ""),
        (r"\s+" + any_of(("أنها قالت", "أنه قال")) + r"\s*$", ""),
        (r"\s+" + any_of(("يقول",)) + r"\s*$", ""),
        (r"\s+" + any_of(SAID_BEFORE_COLON) + r"\s*:?$", ""),
        (r"\s*\(ح\)?\.?\s*و?$", ""),
        (r"\s+" + any_of(("نحوه",)) + r"$", ""),
    )


def note_rules() -> tuple:
    """(pattern, replacement) rules that drop editorial notes from an atomic name."""
    return (
        (r"(?s)\s*\(" + any_of(NOTE_HEADS) + r".*$", ""),
        (r"(?s)\s*[-–—]\s*" + any_of(WORDING_NOTES) + r".*$", ""),
        (r"(?s)\s+" + any_of(WORDING_NOTES) + r"\s+.*$", ""),
        (r"\s+" + any_of(GROUP_NOTES) + r"\.?\s*$", ""),
        (r"\s+" + any_of(READING_NOTES) + r"\s*$", ""),
        (r"\s+" + any_of(ATOM_TAILS) + r"\s*$", ""),
    )


ARABIC = ChainGrammar()
