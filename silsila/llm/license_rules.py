"""Ordered signature rules of licenses, over texts of lower-cased words with one blank between them.

Tier 1 is an identifier tag, 2 a grant, 3 a reference, 4 a mention. A family is only tried where one of its keywords
occurs. Patterns begin and end at word edges and match whole words only.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    number: int
    label: str
    tier: int
    confidence: float
    pattern: str


class Family(NamedTuple):
    """``names`` say which license it is only beside the word license; ``full`` names stand alone; ``ids`` are tags;
    ``keywords`` are alternatives parted by bars, one of which every match contains."""
    label: str
    keywords: str
    names: str = ""
    full: str = ""
    ids: str = ""


def _version(n: str, minor: str = "0") -> str:
    return rf"(?: (?:version|ver|v))? (?:v)?{n}(?: {minor})?"


_GPL = r"(?:gnu )?general public licen[cs]e|gnu gpl|gpl"
_LGPL = r"(?:gnu )?(?:lesser|library) general public licen[cs]e|gnu lgpl|lgpl"
_AGPL = r"(?:gnu )?affero general public licen[cs]e|gnu agpl|agpl"
_CC = r"(?:creative commons|cc) "

#: Hand-written signatures per license, the more specific before the more general.
FAMILIES = (
    Family("mit", "mit|massachusetts", r"mit(?: x11)?|mit style|massachusetts institute of technology", "", "mit"),
    Family("mit-0", "mit", "mit no attribution|mit 0", "mit 0 licen[cs]e", "mit 0"),
    Family("expat", "expat", "expat", "", "expat"),
    Family("x11", "x11", "x11|x consortium", "", "x11"),
    Family("apache-2", "apache|asl", rf"apache(?: software)? (?:licen[cs]e)?{_version('2')}|apache{_version('2')}|asl 2(?: 0)?",
           rf"apache(?: software)? licen[cs]e{_version('2')}", "apache 2 0"),
    Family("apache-1.1", "apache", r"apache(?: software)?(?: version)? 1 1", r"apache(?: software)? licen[cs]e(?: version)? 1 1", "apache 1 1"),
    Family("apache", "apache", r"apache(?: software)?(?: foundation)?"),
    Family("bsd-2-clause", "bsd", r"(?:simplified|freebsd|2 clause|two clause) bsd|bsd (?:2|two) clause", "", "bsd 2 clause"),
    Family("bsd-3-clause", "bsd", r"(?:new|modified|revised|3 clause|three clause) bsd|bsd (?:3|three) clause", "", "bsd 3 clause"),
    Family("bsd-4-clause", "bsd", r"(?:original|old|4 clause|four clause) bsd|bsd (?:4|four) clause", "", "bsd 4 clause"),
    Family("0bsd", "bsd", r"(?:zero clause|0 clause) bsd|bsd (?:zero|0) clause|0bsd", "", "0bsd"),
    Family("bsd", "bsd|berkeley", r"bsd(?: style| type)?|berkeley software distribution"),
    Family("gpl-1", "general public|gpl", "", rf"(?:{_GPL}){_version('1')}|gplv1", r"gpl 1 0(?: only| or later)?"),
    Family("gpl-2", "general public|gpl", "", rf"(?:{_GPL}){_version('2')}|gplv2", r"gpl 2 0(?: only| or later)?"),
    Family("gpl-3", "general public|gpl", "", rf"(?:{_GPL}){_version('3')}|gplv3", r"gpl 3 0(?: only| or later)?"),
    Family("gpl", "general public|gpl", "", rf"{_GPL}"),
    Family("lgpl-2", "general public|gpl", "", rf"(?:{_LGPL}){_version('2')}|lgplv2", r"lgpl 2 0(?: only| or later)?"),
    Family("lgpl-2.1", "general public|gpl", "", rf"(?:{_LGPL}){_version('2', '1')}|lgplv2 1", r"lgpl 2 1(?: only| or later)?"),
    Family("lgpl-3", "general public|gpl", "", rf"(?:{_LGPL}){_version('3')}|lgplv3", r"lgpl 3 0(?: only| or later)?"),
    Family("lgpl", "general public|gpl", "", rf"{_LGPL}"),
    Family("agpl-3", "general public|gpl", "", rf"(?:{_AGPL}){_version('3')}|agplv3", r"agpl 3 0(?: only| or later)?"),
    Family("agpl", "general public|gpl", "", rf"{_AGPL}"),
    Family("gfdl", "free documentation|gfdl", "", r"(?:gnu )?free documentation licen[cs]e", r"gfdl 1 [123](?: only| or later)?"),
    Family("mpl-1.1", "mozilla|mpl", "", r"mozilla public licen[cs]e(?: version| v)? 1 1|mpl 1 1", "mpl 1 1"),
    Family("mpl-2", "mozilla|mpl", "", rf"mozilla public licen[cs]e{_version('2')}|mpl 2(?: 0)?", "mpl 2 0"),
    Family("mpl", "mozilla", "", "mozilla public licen[cs]e"),
    Family("epl-1", "eclipse|epl", "", rf"eclipse public licen[cs]e{_version('1')}|epl 1 0", "epl 1 0"),
    Family("epl-2", "eclipse|epl", "", rf"eclipse public licen[cs]e{_version('2')}|epl 2 0", "epl 2 0"),
    Family("eupl", "union|eupl", "", r"european union public licen[cs]e(?: (?:version|v))?(?: 1 [012])?", "eupl 1 [012]"),
    Family("cddl", "development and distribution|cddl", "", r"common development and distribution licen[cs]e(?: (?:version|v))?(?: 1 [01])?", "cddl 1 [01]"),
    Family("cpl", "common public|cpl", "", "common public licen[cs]e", "cpl 1 0"),
    Family("artistic-2", "artistic", rf"artistic{_version('2')}", rf"artistic licen[cs]e{_version('2')}", "artistic 2 0"),
    Family("artistic", "artistic", "(?:perl )?artistic", "", "artistic 1 0"),
    Family("isc", "isc|internet", "isc|internet (?:systems|software) consortium", "", "isc"),
    Family("zlib", "zlib", "zlib(?: libpng)?", "", "zlib"),
    Family("libpng", "libpng", "libpng", "", "libpng"),
    Family("boost", "boost|bsl", rf"boost(?: software)?{_version('1')}", r"boost software licen[cs]e", "bsl 1 0"),
    Family("unlicense", "unlicen", "", r"(?:the )?unlicen[cs]e", "unlicense"),
    Family("wtfpl", "wtfpl", "wtfpl", "", "wtfpl"),
    Family("cc0", "cc0", "cc0(?: 1 0)?", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    Family("cc-by-nc-nd", "creative commons|cc", "", rf"{_CC}(?:by nc nd|attribution non(?: )?commercial no(?: )?deriv(?:ative)?s?(?: works)?)(?: [1-4] [05])?", r"cc by nc nd [1-4] [05]"),
    Family("cc-by-nc-sa", "creative commons|cc", "", rf"{_CC}(?:by nc sa|attribution non(?: )?commercial share(?: )?alike)(?: [1-4] [05])?", r"cc by nc sa [1-4] [05]"),
    Family("cc-by-nc", "creative commons|cc", "", rf"{_CC}(?:by nc|attribution non(?: )?commercial)(?: [1-4] [05])?", r"cc by nc [1-4] [05]"),
    Family("cc-by-nd", "creative commons|cc", "", rf"{_CC}(?:by nd|attribution no(?: )?deriv(?:ative)?s?)(?: [1-4] [05])?", r"cc by nd [1-4] [05]"),
    Family("cc-by-sa", "creative commons|cc", "", rf"{_CC}(?:by sa|attribution share(?: )?alike)(?: [1-4] [05])?", r"cc by sa [1-4] [05]"),
    Family("cc-by", "creative commons|cc", "", rf"{_CC}(?:by|attribution)(?: [1-4] [05])?", r"cc by [1-4] [05]"),
    Family("cc", "creative commons", "creative commons"),
    Family("python", "python|psf", "python(?: software foundation)?|psf", "", "psf 2 0|python 2 0"),
    Family("php", "php", "php(?: 3 01?)?", "", "php 3 01?"),
    Family("ruby", "ruby", "ruby", "", "ruby"),
    Family("openssl", "openssl", "openssl", "", "openssl"),
    Family("vim", "vim", "vim", "", "vim"),
    Family("tcl", "tcl", "tcl(?: tk)?", "", "tcl"),
    Family("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)?", "", "ncsa"),
    Family("w3c", "w3c", "w3c(?: software)?", "", "w3c"),
    Family("postgresql", "postgresql", "postgresql", "", "postgresql"),
    Family("ofl", "open font|ofl", "", r"(?:sil )?open font licen[cs]e(?: (?:version|v))?(?: 1 [01])?", "ofl 1 [01]"),
    Family("odbl", "open database|odbl", "", "open database licen[cs]e", "odbl 1 0"),
    Family("odc-by", "open data commons|odc", "", "open data commons attribution licen[cs]e", "odc by 1 0"),
    Family("pddl", "open data commons|pddl", "", "open data commons public domain dedication(?: and licen[cs]e)?", "pddl 1 0"),
    Family("openrail", "rail", "(?:creativeml |bigscience )?open(?: )?rail(?: m)?", "", "openrail"),
    Family("llama", "llama", "llama(?: [23])?(?: community)?", "", "llama[23]?"),
    Family("afl", "academic free|afl", "", "academic free licen[cs]e", "afl 3 0"),
    Family("osl", "open software|osl", "", "open software licen[cs]e", "osl 3 0"),
    Family("ms-pl", "microsoft|ms pl", "", "microsoft public licen[cs]e", "ms pl"),
    Family("ms-rl", "microsoft|ms rl", "", "microsoft reciprocal licen[cs]e", "ms rl"),
    Family("bsl-1.1", "business source|busl", "", r"business source licen[cs]e(?: 1 1)?", "busl 1 1"),
    Family("sspl", "server side|sspl", "", r"server side public licen[cs]e", "sspl 1 0"),
    Family("elastic", "elastic", r"elastic(?: 2 0)?", "", "elastic 2 0"),
    Family("commons-clause", "commons clause", "", "commons clause"),
    Family("public-domain", "public domain", "", "(?:released (?:in)?to|dedicated to|in) the public domain|public domain dedication"),
    Family("proprietary", "propriet", "proprietary", "proprietary and confidential"),
    Family("commercial", "commercial", "commercial"),
    Family("all-rights-reserved", "reserved", "", "all rights(?: are)? reserved"),
    Family("no-warranty", "warrant", "", r"provided as is without (?:any )?warrant(?:y|ies)(?: of any kind)?"),
    Family("copyright-notice", "copyright", "", r"copyright(?: c)? (?:19|20)[0-9]{2}"),
)

_TERMS = r"(?: the)?(?: terms(?: and conditions)? of)?(?: the| a| an)? "
_GRANT = (r"(?:dual )?(?:licen[cs]ed|released|distributed|redistributed|published|provided|available|shared|covered)(?: to you| for use)?"
          r" (?:under|by|subject to)" + _TERMS)
_REFERENCE = r"(?:under|see|per|with|of|subject to|governed by|according to|accompanying|following)(?: the| a| an| this| its)? "
_LICENSE = r"(?: open source| public| software)? licen[cs]e"


def _templates(f: Family):
    """(tier, confidence, pattern) of a family, by priority."""
    if f.ids:
        yield 1, 1.0, rf"spdx licen[cs]e identifier (?:{f.ids})"
    either = "|".join(x for x in (rf"(?:{f.names}){_LICENSE}" if f.names else "", f.full) if x)
    yield 2, 0.95, rf"{_GRANT}(?:{either})"
    if f.names:
        yield 2, 0.9, rf"licen[cs]ed under{_TERMS}(?:{f.names})"
    yield 3, 0.8, rf"{_REFERENCE}(?:{either})"
    yield 4, 0.6, rf"(?:{either})"


def _numbered():
    number = 0
    for f in FAMILIES:
        rules = []
        for tier, confidence, pattern in _templates(f):
            rules.append(Rule(number, f.label, tier, confidence, pattern))
            number += 1
        yield f.keywords.split("|"), rules


#: (keywords, rules) per family, and all rules in order.
GROUPS = tuple(_numbered())
RULES = tuple(r for _, rules in GROUPS for r in rules)

#: Phrases that always count, and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: A text without any of these has neither a phrase nor a match of a rule; the lone ones have to stand alone.
ANCHORS = ("licens", "licenc", "copyright", "reserved", "domain", "warrant", "propriet", "commons", "gpl")
LONE_ANCHORS = ("cc", "mpl", "epl", "asl")
