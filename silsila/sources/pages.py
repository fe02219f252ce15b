"""Page scan: HTML to marked text, numbered segments, side layers, entries across pages."""

from __future__ import annotations

from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silsila import lexicon as lx
from silsila.functions.text import HEADINGS, _col, collapse, normalize, stable_id, trim_chars
from silsila.operators.scans import scan_before

USUAL = (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("nbsp", " "), ("amp", "&"))
_NAMES = "\x1e".join(f"{name}\x1f{chr(point)}" for name, point in sorted(name2codepoint.items()))
_UNUSUAL = r"&(?!(?:lt|gt|quot|apos|nbsp|amp);)[#A-Za-z]"
OPEN, CLOSE = "\x01", "\x02"   # around the number or title of a marker in marked text


#: Elements that hold no element of their own tag: the first close tag ends them.
FLAT = ("p", "script", "style", "title")


@dataclass(frozen=True)
class Element:
    """Elements of a tag whose open tag matches ``inside``; elements of the same tag may stand inside, to any depth."""
    tag: str
    inside: str

    @property
    def opens(self) -> str:
        return rf"(?is)<{self.tag}\b{self.inside}>"

    @property
    def flat(self) -> str:
        """The element up to the first close tag, content in group 1."""
        return rf"(?is)<{self.tag}\b{self.inside}>(.*?)</{self.tag}\s*>"


def element(tag: str, cls: str | None = None, attr: str | None = None) -> Element:
    """Elements of a tag, with a class or with an attribute."""
    if cls:
        return Element(tag, rf'[^>]*\bclass\s*=\s*["\'][^"\']*(?<![\w-]){cls}(?![\w-])[^"\']*["\'][^>]*')
    return Element(tag, rf"[^>]*{attr}[^>]*" if attr else r"(?:\s[^>]*)?")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _tag_pieces(html, e: Element) -> Column:
    """The text cut before every open and close tag of the element's tag name."""
    return F.split(_col(html), rf"(?i)(?=</?{e.tag}\b)")


def _spans(pieces: Column, e: Element) -> Column:
    """Array of (start, end, outer) of the elements: the piece of the open tag and that of its close tag (the number of
    pieces if it is never closed), and whether no other one is around it. One pass over the tags; the state holds the depth
    and the elements that are open."""
    spans, stack = "array<struct<start:int,end:int,outer:boolean>>", "array<struct<start:int,depth:int>>"
    none = F.struct(F.lit(0).alias("i"), F.lit(0).alias("depth"), F.array().cast(stack).alias("open"), F.array().cast(spans).alias("done"))

    def step(acc, p):
        opened, closed = p.rlike(rf"(?i)^<{e.tag}\b"), p.rlike(rf"(?i)^</{e.tag}\b") & (acc["depth"] > 0)
        hit = opened & p.rlike(e.opens.replace("(?is)", "(?is)^"))
        depth = F.when(opened & (hit | (acc["depth"] > 0)), acc["depth"] + 1).when(closed, acc["depth"] - 1).otherwise(acc["depth"])
        top = F.try_element_at(acc["open"], F.lit(-1))
        ends = closed & (top["depth"] == acc["depth"])
        left = F.slice(acc["open"], F.lit(1), F.greatest(F.size(acc["open"]) - 1, F.lit(0)))
        span = F.struct(top["start"].alias("start"), acc["i"].alias("end"), (F.size(acc["open"]) == 1).alias("outer"))
        return F.struct(
            (acc["i"] + 1).alias("i"), depth.alias("depth"),
            F.when(hit, F.array_append(acc["open"], F.struct(acc["i"].alias("start"), depth.alias("depth")))).when(ends, left).otherwise(acc["open"]).alias("open"),
            F.when(ends, F.array_append(acc["done"], span)).otherwise(acc["done"]).alias("done"))

    def finish(acc):
        unclosed = F.transform(acc["open"], lambda o, k: F.struct(o["start"].alias("start"), acc["i"].alias("end"), (k == 0).alias("outer")))
        return F.array_sort(F.concat(acc["done"], unclosed))

    return F.aggregate(pieces, none, step, finish)


def _content(pieces: Column, span: Column, e: Element) -> Column:
    head = F.regexp_replace(F.get(pieces, span["start"]), e.opens.replace("(?is)", "(?is)^"), "")
    return F.concat(head, F.array_join(F.slice(pieces, span["start"] + 2, span["end"] - span["start"] - 1), ""))


def element_contents(html, e: Element) -> Column:
    """Contents of all elements in the order of their open tags; one that stands inside another comes too."""
    if e.tag in FLAT:
        return F.regexp_extract_all(_col(html), F.lit(e.flat), F.lit(1))
    def contents(ps):
        return _let(_spans(ps, e), lambda spans: F.transform(spans, lambda s: _content(ps, s, e)))

    return _let(_col(html), lambda h: F.when(h.rlike(e.opens), _let(_tag_pieces(h, e), contents)).otherwise(F.array().cast("array<string>")))


def replace_elements(html, e: Element, before: str = " ", after: str | None = None) -> Column:
    """The text with every outermost element replaced by ``before``, or by its content between ``before`` and ``after``."""
    if e.tag in FLAT:
        return F.regexp_replace(_col(html), e.flat, before if after is None else f"{before}$1{after}")

    def after_span(ps, span):       # what follows an element up to the next tag of its name
        return F.coalesce(F.regexp_replace(F.get(ps, span["end"]), rf"(?is)^</{e.tag}\b[^>]*>", ""), F.lit(""))

    def rebuilt(ps, spans):
        def one(s, k):
            last = F.get(spans, k - 1)
            since = F.when(k > 0, last["end"] + 1).otherwise(F.lit(0))
            gap = F.array_join(F.slice(ps, since + 1, F.greatest(s["start"] - since, F.lit(0))), "")
            lead = F.when(k > 0, after_span(ps, last)).otherwise(F.lit(""))
            return F.concat(lead, gap, F.lit(before)) if after is None else F.concat(lead, gap, F.lit(before), _content(ps, s, e), F.lit(after))

        last = F.try_element_at(spans, F.lit(-1))
        rest = F.array_join(F.slice(ps, last["end"] + 2, F.greatest(F.size(ps) - last["end"] - 1, F.lit(0))), "")
        return F.concat(F.array_join(F.transform(spans, one), ""), after_span(ps, last), rest)

    def replaced(ps):
        return _let(F.filter(_spans(ps, e), lambda s: s["outer"]), lambda spans: rebuilt(ps, spans))

    return _let(_col(html), lambda h: F.when(h.rlike(e.opens), _let(_tag_pieces(h, e), replaced)).otherwise(h))


def without_elements(html, patterns) -> Column:
    """Patterns and elements become a space, one after another."""
    out = _col(html)
    for p in patterns:
        out = replace_elements(out, p) if isinstance(p, Element) else F.regexp_replace(out, p, " ")
    return out


@dataclass(frozen=True)
class PageLayout:
    """Which elements of a page are noise, side layers or markers.

    ``noise`` are patterns and elements, ``layers`` elements. ``markers`` are elements whose text, when it matches ``marker_text``, opens a record;
    ``marker_tags`` are bare opening tags that open a record with a running number. The text of
    a marker element that does not match is dropped unless ``keep_unmarked``.
    """

    page: str | None = r'(?i)(?=<div\b[^>]*class\s*=\s*["\'][^"\']*\bPageText\b)'
    label: str = element("(?:span|div)", "PageNumber").flat
    noise: tuple = (
        r"(?s)<!--.*?-->", element("script"), element("style"), element("sup"), element("div", "PageHead"),
        element("span", "PageHead"),
    )
    layers: tuple = (("footnote", element("div", "footnote")), ("footnote", element("p", "footnote")),
                     ("footnote", element("span", "footnote")))
    markers: tuple = (element("span", "punct"),)
    marker_text: str = lx.RECORD_MARKER
    marker_tags: str | None = None
    keep_unmarked: bool = False


SHELF_PAGES = PageLayout()
#: Biographical entries keep the text of marker elements that are no marker (their colons).
ENTRY_PAGES = PageLayout(keep_unmarked=True)
#: Titled entries: a title element opens the entry, its text is the marker.
TITLED_PAGES = PageLayout(
    markers=(element("span", attr=r'data-type\s*=\s*["\']title["\']'), element("span", "title")),
    marker_text=r"(?s)^\s*(.+?)\s*$",
)


def code_point(n) -> Column:
    """The character of a code point; U+FFFD where there is none and for control characters other than white space."""
    ok = (n.between(32, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)) | n.isin(9, 10, 12, 13)
    safe = F.when(ok, n).otherwise(F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")


def resolve_references(c) -> Column:
    """Character references become characters: numbers by code point, names by the standard HTML table. A non-breaking
    space becomes a space; what is no reference stays as it is. One pass, so ``&amp;lt;`` gives ``&lt;``."""
    names = F.str_to_map(F.lit(_NAMES), F.lit("\x1e"), F.lit("\x1f"))                  # one literal, folded to a map

    def resolved(p):
        ref = F.regexp_extract(p, r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        rest = F.substring(p, F.length(ref) + 2, F.length(p))
        point = F.when(ref.rlike("^#[xX]"), F.conv(F.substring(ref, F.lit(3), F.length(ref)), 16, 10)).when(
            ref.startswith("#"), F.substring(ref, F.lit(2), F.length(ref))).cast("long")
        char = F.when(ref == "apos", F.lit("'")).when(point.isNotNull(), code_point(point)).otherwise(F.try_element_at(names, ref))
        return F.when((ref != "") & char.isNotNull(), F.concat(char, rest)).otherwise(F.concat(F.lit("&"), p))

    def written(t):
        parts = F.split(t, "&")
        joined = F.array_join(F.concat(F.slice(parts, 1, 1), F.transform(F.slice(parts, F.lit(2), F.size(parts)), resolved)), "")
        usual = t                                         # most texts have the usual names only; the ampersand itself comes last
        for name, char in USUAL:
            usual = F.replace(usual, F.lit(f"&{name};"), F.lit(char))
        return F.when(~F.contains(t, F.lit("&")), t).otherwise(
            F.replace(F.when(t.rlike(_UNUSUAL), joined).otherwise(usual), F.lit("\u00a0"), F.lit(" ")))

    return _let(_col(c), written)


def plain_text(c) -> Column:
    """Tags become spaces, character references are resolved, space is collapsed."""
    return F.trim(collapse(resolve_references(F.regexp_replace(_col(c), r"(?s)<[^>]*>", " "))))


def split_pages(files: DataFrame, html: str = "html", layout: PageLayout = SHELF_PAGES) -> DataFrame:
    """One row per page of a file: ``page_no`` from 1, ``page_label``, ``page_html``."""
    if layout.page is None:
        return files.withColumn("page_no", F.lit(1)).withColumn("page_label", F.lit("")).withColumnRenamed(html, "page_html")
    opens = layout.page.replace("(?=", "^(?:")
    found = F.filter(F.split(html, layout.page), lambda p: p.rlike(opens))
    pages = files.select("*", F.posexplode(found).alias("page_no", "page_html")).drop(html)
    pages = pages.withColumn("page_no", F.col("page_no") + 1)
    return pages.withColumn("page_label", plain_text(F.regexp_extract("page_html", layout.label, 1)))


def side_layers(pages: DataFrame, keys: list[str], html: str = "page_html",
                layout: PageLayout = SHELF_PAGES) -> DataFrame:
    """Side layers (footnotes, ads) as rows of their own, apart from the body text. A layer element inside another one is
    part of its text and a row too."""
    base = F.col("__base")

    def layer(name, e):
        return F.transform(element_contents(base, e), lambda t: F.struct(F.lit(name).alias("layer"), plain_text(t).alias("text")))

    found = F.concat(*[layer(name, e) for name, e in layout.layers])
    cleared = pages.select(*keys, F.explode(F.array(without_elements(html, layout.noise[:3]))).alias("__base"))
    rows = cleared.select(*keys, F.posexplode(F.filter(found, lambda r: r["text"] != "")).alias("pos", "r"))
    return rows.select(*keys, (F.col("pos") + 1).alias("layer_no"), "r.layer", "r.text",
                       F.sha2("r.text", 256).alias("text_sha256"))


def marked_text(html, layout: PageLayout = SHELF_PAGES) -> Column:
    """Body text with record markers written as OPEN number CLOSE; noise and layers removed."""
    out = F.translate(_col(html), OPEN + CLOSE, "\ufffd\ufffd")
    out = without_elements(out, (*layout.noise, *[e for _, e in layout.layers]))
    # marker elements keep their text between sentinels, tags inside them are dropped later
    for e in layout.markers:
        out = replace_elements(out, e, OPEN, CLOSE)
    if layout.marker_tags:
        out = F.regexp_replace(out, layout.marker_tags, OPEN + CLOSE)
    return plain_text(out)


def marked_segments(marked, layout: PageLayout = SHELF_PAGES) -> Column:
    """Array of (number, text): text from one marker to the next.

    Element 0 has a NULL number and holds the text before the first marker.
    """
    return _let(F.split(_col(marked), OPEN), lambda pieces: _segments_of(pieces, layout))


def _segments_of(pieces: Column, layout: PageLayout) -> Column:
    head = F.array(F.struct(F.lit(None).cast("string").alias("number"), F.trim(pieces[0]).alias("text")))
    rest = F.transform(
        F.slice(pieces, F.lit(2), F.size(pieces)),
        lambda p: F.struct(F.get(F.split(p, CLOSE, 2), F.lit(0)).alias("m"), F.coalesce(F.get(F.split(p, CLOSE, 2), F.lit(1)), F.lit("")).alias("text")),
    )
    if layout.marker_tags:
        found = F.transform(rest, lambda r, i: F.struct((i + 1).cast("string").alias("number"), F.trim(r["text"]).alias("text")))
        return F.concat(head, found)
    number = lambda r: F.nullif(F.regexp_extract(r["m"], layout.marker_text, 1), F.lit(""))
    kept = (lambda r: F.concat_ws(" ", r["m"], r["text"])) if layout.keep_unmarked else (lambda r: r["text"])
    found = F.transform(rest, lambda r: F.struct(
        number(r).alias("number"), F.trim(F.when(number(r).isNull(), kept(r)).otherwise(r["text"])).alias("text")))
    # text after a non-marker belongs to the segment before it: glue runs without a number
    glued = F.split(
        F.array_join(
            F.transform(F.concat(head, found),
                        lambda s: F.when(s["number"].isNull(), F.concat(F.lit(" "), s["text"]))
                        .otherwise(F.concat(F.lit(OPEN), s["number"], F.lit(CLOSE), s["text"]))),
            ""),
        OPEN)
    return F.transform(
        glued,
        lambda p: F.when(
            p.contains(CLOSE),
            F.struct(F.split(p, CLOSE, 2)[0].alias("number"), F.trim(collapse(F.split(p, CLOSE, 2)[1])).alias("text")),
        ).otherwise(F.struct(F.lit(None).cast("string").alias("number"), F.trim(collapse(p)).alias("text"))),
    )


def page_records(pages: DataFrame, keys: list[str], html: str = "page_html",
                 layout: PageLayout = SHELF_PAGES) -> DataFrame:
    """Numbered records of each page; text before the first marker of a page is not a record.

    No shuffle: a page is one row and its records are exploded from it.
    """
    segs = marked_segments(marked_text(html, layout), layout)
    rows = pages.select(*keys, F.posexplode(segs).alias("segment_no", "s"))
    return rows.filter(F.col("s.number").isNotNull()).select(
        *keys, "segment_no", F.col("s.number").alias("marker"), F.col("s.text").alias("text"))


def entry_parts(pages: DataFrame, source: str, order: str, html: str = "page_html",
                layout: PageLayout = SHELF_PAGES, keep: str | None = None,
                block: int = 4096) -> DataFrame:
    """Parts of numbered or titled entries that run on across pages and files.

    One row per (entry, page): the opening page (``entry_order``, ``entry_segment``) names the
    entry, (``part_order``, ``part_segment``) orders its parts. Text on a page before its first
    marker goes to the entry still open from earlier pages of the source. ``keep`` is a pattern
    that markers which open an entry match.
    """
    segs = pages.select(source, F.col(order).cast("long").alias("part_order"),
                        marked_segments(marked_text(html, layout), layout).alias("segs"))
    return carry_parts(segs, source, "part_order", "segs", keep, block)


def carry_parts(segs: DataFrame, source: str, order: str, segments: str,
                keep: str | None = None, block: int = 4096) -> DataFrame:
    """Give every segment of every page its entry; see ``entry_parts``.

    Only page-level facts (does the page open an entry, and which is its last one) are scanned
    across pages; the texts stay where they are.
    """
    opens = F.transform(
        F.col(segments),
        lambda s, i: F.struct(i.alias("i"), s["number"].alias("number"), s["text"].alias("text"),
                              (s["number"].isNotNull() if keep is None else s["number"].isNotNull() & s["number"].rlike(keep)).alias("opens")))
    pages = segs.select(source, F.col(order).alias("part_order"), opens.alias("segs"))
    last = F.element_at(F.filter("segs", lambda s: s["opens"]), -1)
    pages = pages.withColumn(
        "__last", F.when(F.exists("segs", lambda s: s["opens"]),
                         F.struct(F.col("part_order").alias("entry_order"), last["i"].alias("entry_segment"),
                                  last["number"].alias("number"))))
    facts = scan_before(pages.select(source, "part_order", "__last"), [source], "part_order", "__last", "__open", block=block)
    pages = pages.drop("__last").join(facts.select(source, "part_order", "__open"), [source, "part_order"])
    # the entry of a segment: the last opening segment up to it on this page, else the carried one
    owners = F.aggregate("segs", F.array().cast("array<int>"), lambda acc, s: F.array_append(
        acc, F.when(s["opens"], s["i"]).otherwise(F.get(acc, F.size(acc) - 1))))
    rows = pages.select(source, "part_order", "__open", "segs", owners.alias("owners"))
    rows = rows.select(source, "part_order", "__open", "segs", F.explode(F.arrays_zip(F.col("segs").alias("s"), F.col("owners").alias("o"))).alias("z"))
    own = F.col("z.o").isNotNull()
    return rows.select(
        source,
        F.when(own, F.col("part_order")).otherwise(F.col("__open.entry_order")).alias("entry_order"),
        F.when(own, F.col("z.o")).otherwise(F.col("__open.entry_segment")).alias("entry_segment"),
        F.when(own, F.get("segs", F.col("z.o"))["number"]).otherwise(F.col("__open.number")).alias("number"),
        "part_order", F.col("z.s.i").alias("part_segment"), F.col("z.s.text").alias("text"),
    ).filter(F.col("entry_order").isNotNull() & (F.col("text") != ""))


def entry_bodies(parts: DataFrame, source: str) -> DataFrame:
    """Entry with its parts joined in order. The body is one value, as every reader needs it."""
    ordered = F.array_sort(F.collect_list(F.struct("part_order", "part_segment", "text")))
    return parts.groupBy(source, "entry_order", "entry_segment", "number").agg(
        F.array_join(F.transform(ordered, lambda p: p["text"]), " ").alias("body"))


# -- titled entries -----------------------------------------------------------------------

def title_entry(title, grammar: str) -> tuple[Column, Column]:
    """(entry number, name) of a title under a per-source grammar; name NULL = no entry."""
    t = trim_chars(collapse(title), " " + lx.ZERO_WIDTH + "،؛;:.")
    if grammar == "bracketed":
        pattern = r"^\[(\d+)\]\s*(.+)$"
        return F.nullif(F.regexp_extract(t, pattern, 1), F.lit("")).try_cast("int"), F.nullif(F.trim(F.regexp_extract(t, pattern, 2)), F.lit(""))
    if grammar == "numbered":
        pattern = r"^(\d+)\s*(?:ز\s*)?-?\s*(.+)$"
        return F.nullif(F.regexp_extract(t, pattern, 1), F.lit("")).try_cast("int"), F.nullif(F.trim(F.regexp_extract(t, pattern, 2)), F.lit(""))
    return F.lit(None).cast("int"), F.when(heading_allowed(t, 5, 220), t)


def heading_allowed(heading, lo: int, hi: int, exclusions=lx.HEADING_EXCLUSIONS, lineage: str = "بن",
                    kunya=("ابو ", "ابي ", "ام "), ready: bool = False) -> Column:
    """A heading opens an entry when it carries a lineage or kunya and no section word. ``ready``: it is normalised already."""
    plain = [e.translate({ord(c): "ا" for c in lx.ALEF_FORMS} | {ord("ى"): "ي"}) for e in exclusions]

    def allowed(h):
        excluded = F.lit(False)
        for word in plain:
            excluded = excluded | h.startswith(word)
        named = F.concat(F.lit(" "), h, F.lit(" ")).contains(f" {lineage} ")
        for word in kunya:
            named = named | h.startswith(word)
        return F.length(h).between(lo, hi) & ~excluded & named

    if ready:
        return allowed(F.col(heading) if isinstance(heading, str) else heading)
    # bound to a lambda variable the heading is normalised once, not for every test
    return F.exists(F.array(normalize(heading, HEADINGS)), allowed)


def secondary_entries(bodies: DataFrame, source: str, grammar: str | None = None) -> DataFrame:
    """Entries of one secondary source: titled (``grammar``) or numbered (heading = first clause)."""
    if grammar:
        no, name = title_entry("number", grammar)
        rows = bodies.withColumn("entry_no", no).withColumn("heading", name).filter(F.col("heading").isNotNull())
        rows = rows.withColumn("body", F.concat_ws(" ", "heading", "body"))
    else:
        rows = bodies.withColumn("entry_no", F.col("number").try_cast("int"))
        rows = rows.withColumn("heading", F.trim(F.split("body", r"[،,:؛;.]", 2)[0]))
        rows = rows.filter(heading_allowed("heading", 4, 220))
    return rows.select(
        stable_id("SE_", source, "entry_order", "entry_no", "heading").alias("entry_id"),
        F.col(source).alias("source"), F.col("entry_order").alias("page_order"), "entry_no", "heading",
        normalize("heading", HEADINGS).alias("heading_norm"), "body")


