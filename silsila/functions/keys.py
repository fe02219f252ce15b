"""Blocking keys and identity keys over token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silsila import lexicon as lx
from silsila.functions.text import _col


def tokens(c) -> Column:
    return F.filter(F.split(_col(c), " "), lambda t: t != "")


def prefixes(toks, lo: int, hi: int | None = None) -> Column:
    """Array of (len, key): the token prefixes of length lo..hi (empty when there are too few)."""
    toks = _col(toks)
    last = F.size(toks) if hi is None else F.least(F.lit(hi), F.size(toks))
    # sequence() counts downwards when its end is below its start, hence the guard
    return F.when(
        F.size(toks) >= lo,
        F.transform(
            F.sequence(F.lit(lo), F.greatest(last, F.lit(lo))),
            lambda n: F.struct(n.alias("len"), F.array_join(F.slice(toks, 1, n), " ").alias("key")),
        ),
    ).otherwise(F.array().cast("array<struct<len:int,key:string>>"))


def ngrams(toks, lo: int, hi: int) -> Column:
    """Array of (pos, len, key): every run of lo..hi tokens, pos from 0."""
    toks = _col(toks)
    per_length = F.transform(
        F.sequence(F.lit(lo), F.lit(hi)),
        lambda n: F.when(
            F.size(toks) >= n,
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size(toks) - n, F.lit(0))),
                lambda i: F.struct(
                    i.alias("pos"), n.alias("len"), F.array_join(F.slice(toks, i + 1, n), " ").alias("key")
                ),
            ),
        ).otherwise(F.array().cast("array<struct<pos:int,len:int,key:string>>")),
    )
    return F.flatten(per_length)


def person_name(segment, compound=("عبد", "ابو", "ام")) -> Column:
    """First name of a lineage segment; a compound head keeps its second token."""
    t = tokens(segment)
    return F.when(
        F.get(t, 0).isin(*compound) & (F.size(t) > 1), F.array_join(F.slice(t, 1, 2), " ")
    ).otherwise(F.coalesce(F.get(t, 0), F.lit("")))


def specific_keys(c, lineage: str = "بن", compound=("عبد", "ابو", "ام"),
                  kunya=("ابو", "ام"), min_chars: int = 4) -> Column:
    """Keys specific enough to prove a relation: the whole name, person + father,
    person + father + grandfather, a three-token kunya. ``c`` must be normalised."""
    c = _col(c)
    segs = F.filter(F.transform(F.split(c, rf"\s+{lx.quote(lineage)}\s+"), lambda s: F.trim(s)), lambda s: s != "")
    names = F.transform(segs, lambda s: person_name(s, compound))
    t = tokens(c)
    link = f" {lineage} "
    found = F.array(
        c,
        F.when(F.size(names) >= 2, F.array_join(F.slice(names, 1, 2), link)),
        F.when(F.size(names) >= 3, F.array_join(F.slice(names, 1, 3), link)),
        F.when(F.get(t, 0).isin(*kunya) & (F.size(t) >= 3), F.array_join(F.slice(t, 1, 3), " ")),
    )
    return F.array_distinct(F.filter(found, lambda k: k.isNotNull() & (F.length(k) >= min_chars)))


def lineage_tail(c, lineage: str = "بن") -> Column:
    """What follows the first lineage word, '' when there is none."""
    return F.regexp_extract(_col(c), lx.WORD_START + lx.quote(lineage) + r"\s+(.+)$", 1)


def source_key(c, sigla=lx.SOURCE_SIGLA) -> Column:
    """First five (else four, else three) tokens without source sigla; NULL below three."""
    t = F.filter(tokens(c), lambda x: ~x.isin(*sigla)) if sigla else tokens(c)
    return F.when(F.size(t) >= 3, F.array_join(F.slice(t, 1, 5), " "))


def lineage_eligible(c, lineage: str = "بن", kunya=("ابن", "ابو", "ابي", "ام")) -> Column:
    """A name of three or more tokens that is a lineage and does not open with a kunya word."""
    t = tokens(c)
    return (F.size(t) >= 3) & ~F.get(t, 0).isin(*kunya) & (F.get(t, 1) == lineage)


def card_aliases(c, lineage: str = "بن", kunya=("ابو", "ام")) -> Column:
    """Array of (alias, alias_type) for a normalised identity text."""
    c = _col(c)
    t = tokens(c)
    n = F.size(t)
    none = F.array().cast("array<struct<alias:string,alias_type:string>>")

    def pair(text, kind):
        return F.struct(text.alias("alias"), F.lit(kind).alias("alias_type"))

    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    heads = F.filter(at, lambda i: F.get(t, i).isin(*kunya) & (i + 1 < n))
    runs = F.flatten(
        F.transform(
            heads,
            lambda i: F.transform(
                F.filter(F.sequence(F.lit(3), F.lit(5)), lambda k: k <= n - i),
                lambda k: F.slice(t, i + 1, k),
            ),
        )
    )
    lineage_runs = F.filter(runs, lambda r: F.array_contains(r, lineage))
    sons = F.filter(at, lambda i: (F.get(t, i) == lineage) & (i + 1 < n))
    parts = F.concat(
        F.array(pair(c, "identity")),
        F.when(n > 0, F.array(pair(F.get(t, 0), "first_name"))).otherwise(none),
        F.transform(heads, lambda i: pair(F.array_join(F.slice(t, i + 1, 2), " "), "embedded_kunya")),
        F.transform(lineage_runs, lambda r: pair(F.array_join(r, " "), "embedded_kunya_lineage")),
        F.transform(sons, lambda i: pair(F.concat(F.lit(lineage + " "), F.get(t, i + 1)), "embedded_ibn_alias")),
        F.transform(prefixes(t, 2, 6), lambda p: pair(p["key"], "name_prefix")),
    )
    return F.array_distinct(F.filter(parts, lambda p: F.length(p["alias"]) >= 2))


def own_kunya(name, intro, letters: str = "ء-ي", word: str = "ابو", said: str = "ويقال",
              comma: str = "،") -> Column:
    """Kunya prefixes (two tokens and more) a person carries in the own name or introduction."""
    body = rf"{word}\s+[{letters}]+(?:\s+[{letters}]+){{0,2}}"
    own = F.slice(F.regexp_extract_all(_col(name), F.lit(rf"{lx.WORD_START}({body})"), F.lit(1)), 1, 1)
    told = F.regexp_extract_all(_col(intro), F.lit(rf"(?:^|{comma})\s*(?:{said}:?\s*)?({body})"), F.lit(1))
    each = F.transform(F.concat(own, told), lambda k: prefixes(tokens(k), 2, 8))
    return F.array_distinct(F.transform(F.flatten(each), lambda p: p["key"]))
