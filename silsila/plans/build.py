"""The whole job: library pages -> occurrences -> identities -> analysed links -> reader mart.

Every function takes and returns DataFrames (grouped in plain dicts). The resolution stages
follow each other, so the map of resolved occurrences is checkpointed after each of them;
each stage keeps its own output, and the union by precedence can be rebuilt from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silsila import lexicon as lx
from silsila.functions import keys as K
from silsila.functions import rules as R
from silsila.functions import text as T
from silsila.operators import analyze as AN
from silsila.operators import blocking as B
from silsila.operators import cards as CD
from silsila.operators import chains as C
from silsila.operators import evidence as EV
from silsila.operators import extract as E
from silsila.operators import kinship as KIN
from silsila.operators import relations as RL
from silsila.operators import resolve as RS
from silsila.operators.scans import scan_before
from silsila.plans import mart as M
from silsila.plans.session import checkpointed
from silsila.sources import manifest as MF
from silsila.sources import pages as PG

FILE = ["source", "file_name"]


def read_library(spark: SparkSession, path: str) -> DataFrame:
    """HTML files of ``path/<source>/<file>.htm``: source, file_name, html, and the size and SHA-256 of the bytes.

    A file is one value, so it must stay below 2 GB; broken bytes show as U+FFFD.
    """
    files = MF.read_files(spark, path)
    return files.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("source"), F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("file_name"),
                        F.make_valid_utf8(F.col("content").cast("string")).alias("html"), "sha256", "size_bytes")


def distinct_files(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files without copies, one row per copy with ``duplicate_of``). Of equal contents a standalone file stays, else
    the first by source and name. Files without a digest get that of their text."""
    if "sha256" not in files.columns:
        files = files.withColumn("sha256", F.sha2("html", 256)).withColumn("size_bytes", F.octet_length("html").cast("long"))
    named = files.withColumn("__name", F.concat_ws("/", *FILE)).withColumn(
        "__alone", (MF.parse_name("file_name")["kind"] == "standalone").cast("int"))
    marked = MF.dedup_content(named.drop("html"), "sha256", "__name", "__name", "__alone")
    copies = marked.filter("duplicate_of <> ''").select(*FILE, "sha256", "duplicate_of")
    return files.join(copies.select(*FILE), FILE, "left_anti"), copies


def file_ranks(files: DataFrame) -> DataFrame:
    """Number the files of each source by name, from 0.

    The names are sorted globally and get increasing ids; a checkpoint fixes them, a blocked
    scan makes them contiguous per source.
    """
    ids = files.select(*FILE).distinct().orderBy(*FILE).withColumn("id", F.monotonically_increasing_id())
    ids = checkpointed(ids).withColumn("one", F.lit(1))
    return scan_before(ids, ["source"], "id", "one", "rank", how="sum").select(*FILE, "rank")


def ordered_pages(files: DataFrame, layout: PG.PageLayout = PG.SHELF_PAGES) -> DataFrame:
    """Pages with an integer order over all files of a source, by (file, page): as many numbers are set aside for each
    file as the longest file has pages."""
    pages = PG.split_pages(files, "html", layout)
    longest = pages.agg(F.coalesce(F.max("page_no"), F.lit(0)).alias("__longest"))
    room = int(longest.first()["__longest"]) + 1
    return pages.join(file_ranks(files), FILE).withColumn("page_order", F.col("rank") * F.lit(room).cast("long") + F.col("page_no"))


# -- corpus -------------------------------------------------------------------------------------


def build_corpus(files: DataFrame, g: lx.ChainGrammar = lx.ARABIC) -> dict[str, DataFrame]:
    """Source files, their copies (left out of all that follows), footnotes, records, chains, mentions, occurrences and
    observed edges."""
    kept, copies = distinct_files(files)
    source_files = kept.withColumn("source_file_id", T.stable_id("SF_", "sha256"))
    named = source_files.withColumn("n", MF.parse_name("file_name"))
    meta = named.select("source_file_id", F.col("n.book").alias("book"), F.col("n.volume").alias("volume"), F.col("n.kind").alias("kind"),
                        "file_name", "sha256", "size_bytes")
    pages = PG.split_pages(source_files.select("source_file_id", "html"), "html")
    keys = ["source_file_id", "page_no", "page_label"]
    footnotes = PG.side_layers(pages, keys).withColumn("footnote_id", T.stable_id("FN_", "source_file_id", "page_no", "layer_no", "text_sha256"))
    records = E.typed_records(PG.page_records(pages, keys), "text", g)
    records = records.withColumn("record_id", T.stable_id("H_", "source_file_id", "page_no", "segment_no", "marker", "text"))
    bodies = records.filter(F.col("record_type").isin("hadith", "report"))
    chains = E.extract_chains(bodies, "text", g).withColumn("chain_id", T.stable_id("S_", "record_id", "chain_raw"))
    mentions = E.extract_mentions(chains, "chain_id", "chain_raw", g)
    carried = ["mention_id", "chain_id", "sequence_index", "branch_hint", "transmission_term"]
    occ = checkpointed(E.atomic_occurrences(mentions, carried, g=g))   # read by every later stage
    edges = C.observed_edges(C.position_edges(occ), chains)
    return {"source_files": meta, "file_copies": copies, "footnotes": footnotes, "records": records, "chains": chains, "mentions": mentions, "occurrences": occ,
            "observed_edges": edges}


def build_entries(files: DataFrame) -> DataFrame:
    """Numbered biographical entries over all pages and files, with anchor ids and lists."""
    parts = PG.entry_parts(ordered_pages(distinct_files(files)[0]), "source", "page_order", layout=PG.ENTRY_PAGES)
    bodies = PG.entry_bodies(parts, "source")
    rows = CD.entry_index(bodies, "body")
    rows = rows.withColumn("entry_id", T.stable_id("TK_", "source", "entry_order", "entry_segment", "heading"))
    rows = rows.withColumn("anchor", T.stable_id("A_", "entry_id")).withColumn("locator", F.concat_ws(" | ", "source", "entry_order"))
    return checkpointed(rows)   # read by every later stage


def build_summaries(files: DataFrame) -> DataFrame:
    """Numbered short entries: summary_no, summary_page, summary_text."""
    bodies = PG.entry_bodies(PG.entry_parts(ordered_pages(distinct_files(files)[0]), "source", "page_order", layout=PG.ENTRY_PAGES), "source")
    return checkpointed(bodies.select(F.col("number").try_cast("int").alias("summary_no"), F.col("entry_order").cast("string").alias("summary_page"),
                                      F.col("body").alias("summary_text")))


def build_secondary(files: DataFrame, grammars: dict[str, str | None]) -> DataFrame:
    """Entries of the secondary sources; a grammar for titled ones, None for numbered ones."""
    out = None
    for source, grammar in grammars.items():
        layout = PG.TITLED_PAGES if grammar else PG.SHELF_PAGES
        pages = ordered_pages(distinct_files(files.filter(F.col("source") == source))[0], layout)
        keep = {"bracketed": r"^\[\d+\]", "numbered": r"^\d+"}.get(grammar)
        bodies = PG.entry_bodies(PG.entry_parts(pages, "source", "page_order", layout=layout, keep=keep), "source")
        rows = PG.secondary_entries(bodies, "source", grammar)
        out = rows if out is None else out.unionByName(rows)
    return checkpointed(out)


# -- identities ---------------------------------------------------------------------------------


def with_entities(occ: DataFrame, resolved: DataFrame) -> DataFrame:
    """Occurrences with the entity resolved so far, the plain name, and the named flag."""
    rows = occ.join(resolved.select("occurrence_id", "entity"), "occurrence_id", "left")
    return rows.select(*C.POSITION, "occurrence_id", F.col("normalized_name").alias("name"), "entity", "transmission_term", "occurrence_type",
                       (F.col("occurrence_type") == "named_candidate").cast("int").alias("is_named"))


#: What a stage can tell about a resolution. All stages share this one type; it becomes text in the mart only.
EVIDENCE = {
    "name": "string", "method": "string", "status": "string", "score": "double", "runner_up": "double", "candidate_count": "long", "gov": "string",
    "token": "string", "label": "string", "prev": "string", "next": "string", "prev_weight": "int", "next_weight": "int", "prev_relation": "int",
    "next_relation": "int", "prev_in_students": "int", "next_in_teachers": "int", "support": "int", "pass_no": "int",
}


def _resolution(news: DataFrame, layer) -> DataFrame:
    """Columns of the resolved map: occurrence, entity, score, layer, and the evidence of the stage (NULL what it does not tell)."""
    def told(c, kind):
        return (F.col(c) if c in news.columns else F.lit(None)).cast(kind).alias(c)

    return news.select("occurrence_id", "entity", told("score", "double"), (F.lit(layer) if isinstance(layer, str) else layer).alias("layer"),
                       F.struct(*[told(c, kind) for c, kind in EVIDENCE.items()]).alias("evidence"))


def _add(resolved: DataFrame, label, news: DataFrame) -> DataFrame:
    """Resolved map with the news of one stage; what was resolved before stays. ``label``: a text or a column."""
    fresh = _resolution(news, label)
    return checkpointed(resolved.unionByName(fresh.join(resolved.select("occurrence_id"), "occurrence_id", "left_anti")))


def _rename(opened: DataFrame, profile: T.Profile) -> DataFrame:
    return opened.withColumn("name", T.normalize("name", profile))


def list_edges(cards: DataFrame, card: str, students: str, teachers: str, node_keys: DataFrame, profile: T.Profile,
               weight: int = 1, kinds=("prev", "next")) -> tuple[DataFrame, DataFrame]:
    """Support edges from list texts: the previous node among the students, the next among the teachers."""
    def edges(text, kind):
        lists = cards.select(F.col(card).alias("card"), T.normalize(text, profile).alias("text")).filter("text <> ''")
        return RL.listed_nodes(lists, "card", "text", node_keys).select(
            F.lit(kind).alias("node_kind"), "node", F.col("card").alias("candidate"), F.lit(weight).alias("weight"))

    return edges(students, kinds[0]), edges(teachers, kinds[1])


def resolve_anchors(occ: DataFrame, entries: DataFrame) -> DataFrame:
    """R-01 and R-02: unique full names, then the teacher and student lists of the candidates."""
    strong = entries.filter("confidence >= 0.8")
    named = occ.filter("occurrence_type = 'named_candidate'").select("occurrence_id", F.col("normalized_name").alias("name"))
    index = B.prefix_index(strong, "anchor", "canonical_norm", 3, None).select("key", "entity")
    first = RS.resolve_unique_names(named.filter(K.lineage_eligible("name")), index)
    resolved = checkpointed(_resolution(first, "provisional_anchor"))
    met = C.guarded_neighbours(with_entities(occ, resolved), ["occurrence_id", "name", "entity", "is_named"])
    met = met.filter("entity IS NULL AND is_named = 1")
    opened = met.select(*C.POSITION, "occurrence_id", "name", F.col("prev_entity").alias("prev"), F.col("next_entity").alias("next"),
                        *[F.when(F.col(f"{s}_entity").isNotNull(), F.col(f"{s}_name")).alias(f"{s}_raw") for s in ("prev", "next")])
    opened = opened.filter("prev IS NOT NULL OR next IS NOT NULL")
    names = opened.select(F.explode(F.array_compact(F.array("prev_raw", "next_raw"))).alias("node")).distinct()
    raw = names.select("node", F.col("node").alias("key"))
    canon = entries.select(F.col("anchor").alias("node"), F.substring_index("canonical_norm", " ", 3).alias("key"))
    p3, x3 = list_edges(strong, "anchor", "students_raw", "teachers_raw", raw, T.PLAIN, 3, ("prev_raw", "next_raw"))
    p2, x2 = list_edges(strong, "anchor", "students_raw", "teachers_raw", canon, T.PLAIN, 2)
    blocks = RS.plain_index(B.prefix_index(strong, "anchor", "canonical_norm", 1, 5))
    second = RS.resolve_list_context(opened, blocks, p3.unionByName(p2), x3.unionByName(x2), ("prev", "prev_raw"), ("next", "next_raw"), ("prev", "next"))
    return _add(resolved, "strong_context", second)


def build_cards(resolved: DataFrame, entries: DataFrame, summaries: DataFrame) -> dict[str, DataFrame]:
    """Cards of the anchors in use: texts, lists, summary, structured facts, statements, relations."""
    anchors = entries.join(resolved.select(F.col("entity").alias("anchor")).distinct(), "anchor", "left_semi").select(
        "anchor", "entry_id", "canonical_name")
    cards = CD.summary_cards(anchors, entries.select("entry_id", "locator", "body", "teachers_raw", "students_raw"), summaries)
    cards = checkpointed(cards)
    segs = {c: E.list_segments(c) for c in ("teachers_raw", "students_raw")}
    names = anchors.withColumn("n", T.normalize("canonical_name", T.LISTS))
    evidence = RL.reported_evidence(cards, "anchor", segs["teachers_raw"], segs["students_raw"], names, "anchor", "n")
    dates = cards.select(F.col("anchor").alias("entity"), F.posexplode(EV.word_dates(R.light_text("body"))).alias("pos", "d"))
    dates = dates.select("entity", "pos", "d.event", "d.year", "d.text", "d.confidence")
    structured = EV.structured_cards(cards, "anchor", "summary_text", EV.best_years(dates))
    statements = EV.critic_rows(cards, "anchor", "body", R.statement_judgment)
    return {"anchors": checkpointed(anchors), "cards": cards, "relation_evidence": evidence, "relations": checkpointed(RL.reconcile(evidence)),
            "date_evidence": dates, "structured": checkpointed(structured), "statements": statements,
            "traits": EV.trait_rows(structured, "anchor", [f"has_{t}" for t, _ in lx.TRAITS], "summary_text")}


def build_second_evidence(anchors: DataFrame, secondary: DataFrame) -> dict[str, DataFrame]:
    """C-07: the entry of each anchor in each secondary source (its longest unique heading prefix), and the attributed
    statements, dates in digits and source grades of these entries."""
    named = anchors.select("anchor", T.normalize("canonical_name", T.HEADINGS).alias("name_norm"))
    matched = checkpointed(EV.match_secondary(named, secondary))
    entries = matched.join(secondary.select("source", "entry_id", "body"), ["source", "entry_id"])
    keys = ["anchor", "source", "entry_id"]
    statements = EV.critic_rows(entries, "anchor", "body", R.secondary_grade, ("source", "entry_id"), words=lx.SECONDARY_STATEMENT_WORDS,
                                excluded=lx.SECONDARY_EXCLUDED_ATTRIBUTIONS, max_critic=90)
    dates = entries.select(*keys, F.explode(EV.digit_dates("body")).alias("d")).select(*keys, "d.event", "d.year", "d.text", "d.confidence").distinct()
    grades = EV.source_grades(entries, "source", "body").select(*keys, "critic", "exact_text", "judgment", "confidence")
    return {
        "matches": matched.select(*keys, F.lit("unique_heading_prefix").alias("method"), F.lit(0.92).alias("score")),
        "statements": statements.withColumn("confidence", F.lit(0.88)),
        "dates": dates.withColumn("evidence_id", T.stable_id("S4D_", *keys, "event", "text")),
        "grades": grades.withColumn("evidence_id", T.stable_id("S4G_", *keys, "exact_text")),
    }


def anchor_aliases(anchors: DataFrame, secondary: DataFrame | None) -> DataFrame:
    """Alias table of the anchors, with the headings of their secondary entries."""
    headings = None
    if secondary is not None:
        named = anchors.select("anchor", T.normalize("canonical_name", T.HEADINGS).alias("name_norm"))
        match = EV.match_secondary(named, secondary)
        headings = match.join(secondary.select("entry_id", "heading"), "entry_id").select("anchor", "source", "entry_id", "heading")
    return CD.alias_table(anchors, headings)


def resolve_more(occ: DataFrame, resolved: DataFrame, entries: DataFrame, made: dict[str, DataFrame],
                 secondary: DataFrame | None = None, kept: dict[str, DataFrame] | None = None) -> DataFrame:
    """R-03, R-06, R-07, R-08 on top of the anchors resolved so far.

    ``kept`` takes a further table of the stages: ``kinship``, every judged kin node, the unresolved ones with their best
    candidates.
    """
    anchors, relations = made["anchors"], made["relations"]
    lineage = anchors.withColumn("n", T.normalize("canonical_name", T.LINEAGE))
    opened = _rename(RS.open_positions(with_entities(occ, resolved)), T.LINEAGE)
    graph = RS.judge_graph(RS.plain_index(B.prefix_index(lineage, "anchor", "n", 1, 5)), relations)
    resolved = _add(resolved, "strong_graph", RS.neighbour_passes(opened, graph))

    people = entries.select(F.col("anchor").alias("entry"), T.normalize("canonical_name", T.KINSHIP).alias("name_norm"),
                            T.kunya_normalize(F.split(T.normalize("heading", T.KINSHIP), r"(?:روى|يروي)\s+عن", 2)[0]).alias("intro"))
    kunyas = people.select(F.col("entry"), F.explode(K.own_kunya("name_norm", "intro")).alias("key"))
    token, label = KIN.kin_tokens(T.normalize("name", T.KINSHIP), "occurrence_type")
    kin = with_entities(occ, resolved).withColumn("token", token).withColumn("label", F.when(token.isNotNull(), label).otherwise(""))
    kin = checkpointed(kin)
    labels = kin.filter("label <> ''").select("label").distinct()
    found = checkpointed(KIN.resolve_kinship(kin, people, KIN.label_matches(labels, people, kunyas)))
    if kept is not None:
        kept["kinship"] = found
    named_kin = F.when(F.col("label") != "", "strong_relational_named").otherwise("strong_relational")
    resolved = _add(resolved, named_kin, found.filter("status = 'resolved'"))

    aliases = anchor_aliases(anchors, secondary).filter(F.size(K.tokens("alias_norm")) >= 2).select(F.col("alias_norm").alias("name"), F.col("anchor").alias("entity")).distinct()
    # both rules are held to the listed statuses; for aliases these are all there are so far
    for label_, unique, profile, names in (
        ("strong_secondary_alias", B.unique_keys(aliases, "name"), T.HEADINGS, ("strong_alias_two_sided", "strong_alias_one_sided")),
        ("strong_unique_prefix", B.unique_keys(B.prefix_index(lineage, "anchor", "n", 3, 7)).select(F.col("key").alias("name"), "entity"),
         T.LINEAGE, ("strong_prefix_two_sided", "strong_prefix_one_sided")),
    ):
        opened = _rename(RS.open_positions(with_entities(occ, RS.trusted(resolved, lx.TRUSTED_STATUSES))), profile)
        news = RS.resolve_with_support(opened, unique, relations, *names)
        resolved = _add(resolved, label_, news)
    return resolved


def candidate_queue(occ: DataFrame, resolved: DataFrame, made: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Non-destructive queue for the occurrences still open."""
    names = made["anchors"].withColumn("n", T.normalize("canonical_name", T.LINEAGE))
    index = B.prefix_index(names, "anchor", "n", 1, 6)
    opened = checkpointed(_rename(RS.open_positions(with_entities(occ, resolved)), T.LINEAGE))
    years = made["structured"].select(F.col("anchor").alias("entity"), "birth_year", "death_year")
    rows = checkpointed(RS.queue_candidates(opened, index, made["relations"], years))
    return {"candidates": rows, "blocks": RS.candidate_blocks(opened, index), "summary": RS.queue_summary(opened, rows, index, years)}


def _referred(found: DataFrame, refs: DataFrame) -> DataFrame:
    """Resolutions to cards as resolutions to the references of these cards."""
    return found.withColumnRenamed("entity", "card_id").join(refs, "card_id").drop("card_id").withColumnRenamed("ref", "entity")


# -- cards first ---------------------------------------------------------------------------------


def resolve_cards(occ: DataFrame, resolved: DataFrame, made: dict[str, DataFrame], summaries: DataFrame,
                  secondary: DataFrame) -> dict[str, DataFrame]:
    """R-09 to R-17: source cards, seeds, specific context, signatures, provisional cards."""
    cards = checkpointed(CD.source_cards(summaries.select(F.col("summary_no").alias("entry_no"), F.col("summary_page").alias("page"),
                                                          F.col("summary_text").alias("text"))))
    staged_no = made["cards"].select("anchor", F.col("summary_no").alias("entry_no"))
    links = checkpointed(CD.anchor_links(staged_no, cards))
    second = CD.secondary_links(cards, secondary)
    texts = checkpointed(CD.relationship_text(second, secondary))
    aliases = CD.source_card_aliases(cards).select(F.col("alias").alias("key"), F.col("card_id").alias("entity")).distinct()
    ref = F.when(F.col("anchor").isNotNull(), F.concat(F.lit("A:"), "anchor")).otherwise(F.concat(F.lit("P:"), T.stable_id("P_", "card_id")))
    refs = checkpointed(cards.select("card_id").join(links, "card_id", "left").select("card_id", ref.alias("ref")))

    # R-09, R-10: neighbours are anchors, their keys are name prefixes and aliases of three characters and more
    names = made["anchors"].select(F.col("anchor").alias("node"), T.normalize("canonical_name", T.CARDS).alias("n"))
    node_keys = names.select("node", F.explode(K.prefixes(K.tokens(F.substring_index("n", " ", 6)), 2, 6)).alias("p")).select("node", "p.key")
    known = checkpointed(anchor_aliases(made["anchors"], secondary).select("anchor", T.normalize("alias_norm", T.CARDS).alias("name")).distinct())
    node_keys = node_keys.unionByName(known.select(F.col("anchor").alias("node"), F.col("name").alias("key"))).filter(F.length("key") >= 3).distinct()
    prev, nxt = list_edges(texts, "card_id", "students_raw", "teachers_raw", node_keys, T.CARDS)
    opened = checkpointed(_rename(RS.open_positions(with_entities(occ, resolved)), T.CARDS))
    alias_open = opened
    candidates = checkpointed(RS.source_card_candidates(opened, RS.plain_index(aliases), prev, nxt))
    by_card = _referred(RS.resolve_source_cards(opened, candidates), refs)

    # the card map speaks of references: A: anchors, P: provisional cards
    base = resolved.select("occurrence_id", F.concat(F.lit("A:"), "entity").alias("entity"), "score", F.lit("existing").alias("layer"), "evidence")
    mapped = checkpointed(base.unionByName(_resolution(by_card, "source_card_context")))

    # R-11: names of three tokens that open exactly one card
    index = B.prefix_index(cards, "card_id", "identity_norm", 3, 8).select("key", "entity")
    free = occ.filter("occurrence_type = 'named_candidate'").join(mapped.select("occurrence_id"), "occurrence_id", "left_anti")
    free = free.select("occurrence_id", T.normalize("normalized_name", T.CARDS).alias("name")).filter(F.size(K.tokens("name")) >= 3)
    seeds = _referred(RS.resolve_unique_names(free, index), refs)
    mapped = checkpointed(mapped.unionByName(_resolution(seeds, "unique_source_card_prefix")))

    # R-12: specific context in passes; nodes and results are references
    headed = cards.join(second.join(secondary.select("entry_id", "heading"), "entry_id").select("card_id", T.normalize("heading", T.CARDS).alias("sec")),
                        "card_id", "left").withColumn("sec", F.coalesce("sec", F.lit("")))
    own = headed.select("card_id", F.explode(F.array_union(K.specific_keys("identity_norm"), K.specific_keys("sec"))).alias("key")).join(refs, "card_id")
    anchor_keys = made["anchors"].select(F.concat(F.lit("A:"), "anchor").alias("node"), F.explode(K.specific_keys(T.normalize("canonical_name", T.CARDS))).alias("key"))
    keys = own.select(F.col("ref").alias("node"), "key").unionByName(anchor_keys).distinct()
    prev6, next6 = list_edges(texts.join(refs, "card_id"), "ref", "students_raw", "teachers_raw", keys, T.CARDS)
    opened = _rename(RS.open_positions(with_entities(occ, mapped)), T.CARDS)
    named = headed.join(refs, "card_id")
    # aliases of two words and more stand for the card of their anchor
    carded = known.withColumn("entity", F.concat(F.lit("A:"), "anchor")).join(refs.select(F.col("ref").alias("entity")).distinct(), "entity", "left_semi")
    carded = carded.filter(F.size(K.tokens("name")) >= 2).select("name", "entity").distinct()
    index6 = B.name_index(named, opened, entity="ref", texts=("identity_norm", "sec"), aliases=carded).withColumnRenamed("entity", "candidate")
    found = RS.neighbour_passes(opened, RS.judge_specific(index6, prev6, next6))
    mapped = checkpointed(mapped.unionByName(_resolution(found, F.col("method"))))

    # R-13: strict fathers; R-14: signatures
    token, label = KIN.kin_tokens(T.normalize("name", T.KINSHIP), "occurrence_type")
    met = C.guarded_neighbours(with_entities(occ, mapped).withColumn("token", F.when(label == "", token)), ["occurrence_id", "name", "entity", "token"])
    met = checkpointed(met.withColumnRenamed("prev_entity", "prev").withColumnRenamed("next_entity", "next"))
    lines = cards.join(refs, "card_id").select(F.col("ref").alias("card"), "identity_norm")
    fathers = KIN.resolve_strict_father(met.filter("entity IS NULL AND token IS NOT NULL").drop("entity"), lines, next6)
    mapped = mapped.unionByName(_resolution(fathers, "strict_father"))
    same = RS.propagate_signatures(met.select(*C.POSITION, "occurrence_id", "name", "entity", "prev", "next"))
    same = same.join(mapped.select("occurrence_id"), "occurrence_id", "left_anti")
    mapped = checkpointed(mapped.unionByName(_resolution(same, "signature")))

    used = mapped.join(refs, mapped["entity"] == refs["ref"]).select("occurrence_id", "card_id")
    provisional = CD.provisional_cards(used, cards, links, texts, secondary.select("entry_id", "body"))
    return {"source_cards": cards, "links": links, "texts": texts, "card_candidates": candidates,
            "alias_candidates": RS.candidate_blocks(alias_open, aliases, "alias_only"), "card_map": mapped, "provisional": provisional,
            "prev_edges": prev6, "next_edges": next6}


# -- analysis and mart ------------------------------------------------------------------------------


def analyze(occ: DataFrame, resolved: DataFrame, made: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Analysed links between anchors and their roll-up per chain."""
    rows = with_entities(occ, resolved).withColumnRenamed("transmission_term", "term").withColumn("resolved", F.col("entity").isNotNull().cast("int"))
    rows = checkpointed(rows)
    facts = made["structured"].withColumnRenamed("anchor", "entity")
    links = checkpointed(AN.analyze_links(rows, made["relations"], C.resolved_pairs(rows), facts))
    return {"links": links, "branches": AN.branch_summary(rows, links)}


def build_mart(corpus: dict[str, DataFrame], made: dict[str, DataFrame], first: dict[str, DataFrame],
               second: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The seven reader tables. ``second``: evidence of the secondary sources, see :func:`build_second_evidence`."""
    occ, mapped = corpus["occurrences"], first["card_map"]
    anchored = made["cards"].join(made["structured"].drop("summary_text"), "anchor", "left").select(
        F.col("anchor").alias("card_id"), F.col("canonical_name").alias("display_name"), F.col("locator").alias("source_locator"), "grade",
        F.col("summary_text").alias("exact_grade_text"), "tabaqa", "birth_year", "death_year", F.col("body").alias("biography"), "teachers_raw", "students_raw")
    provisional = first["provisional"].select(
        F.col("provisional_id").alias("card_id"), F.col("identity_text").alias("display_name"), F.col("page").alias("source_locator"), "grade",
        F.col("full_text").alias("exact_grade_text"), "tabaqa", "biography", "teachers_raw", "students_raw")
    kind = F.when(F.col("entity").startswith("A:"), "existing_anchor").otherwise("provisional_source_card")
    refs = mapped.select("occurrence_id", kind.alias("card_type"), F.expr("substring(entity, 3)").alias("card_id"), F.col("layer").alias("status"),
                         F.to_json("evidence").alias("evidence"))
    nodes = M.mart_nodes(occ, refs)
    rows = occ.join(mapped.select("occurrence_id", F.col("entity").alias("card_ref")), "occurrence_id", "left").withColumn("term", F.col("transmission_term"))
    rows = rows.withColumn("resolved", F.col("card_ref").isNotNull().cast("int"))
    graph = made["relations"].select(F.concat(F.lit("A:"), "student").alias("student"), F.concat(F.lit("A:"), "teacher").alias("teacher"))
    listed = first["prev_edges"].select(F.col("node").alias("student"), F.col("candidate").alias("teacher"), F.lit("student_list").alias("direction")).unionByName(
        first["next_edges"].select(F.col("candidate").alias("student"), F.col("node").alias("teacher"), F.lit("teacher_list").alias("direction")))
    edges = checkpointed(AN.card_edges(rows, graph, listed))
    supported = F.when(F.col("relationship_support") != "needs_relationship_evidence", "supported_reported_and_observed").otherwise("needs_evidence")
    branches = AN.branch_summary(rows, edges.withColumn("continuity_status", supported)).withColumnRenamed("warning_links", "unsupported_links")
    repairs = E.repair_terminals(occ.filter("occurrence_type = 'prophet_terminal'").select(*C.POSITION, "occurrence_id", "raw_atomic_name"))
    hidden = hidden_terminals(rows, repairs, first)
    return {
        "cards": M.mart_cards(anchored, provisional),
        "critic_statements": M.mart_statements(made["statements"], second["statements"] if second else None),
        "sanads": M.mart_chains(corpus["chains"].select("chain_id", "record_id", "source_file_id", "chain_raw", "boundary_method", "confidence", "needs_review"),
                                corpus["source_files"].select("source_file_id", "book", "volume"), corpus["records"].select("record_id", "marker", "page_label")),
        "sanad_nodes": nodes, "sanad_edges": edges, "branch_summary": branches,
        "terminal_repairs": M.mart_repairs(repairs.select("occurrence_id", "repair_kind", "hidden_name", "needs_terminal", "needs_review"), hidden),
    }


def hidden_terminals(rows: DataFrame, repairs: DataFrame, first: dict[str, DataFrame]) -> DataFrame:
    """R-16: the hidden name of a repaired terminal, by the card rule with its previous node."""
    met = C.guarded_neighbours(rows.withColumnRenamed("card_ref", "entity"), ["occurrence_id", "entity"], sides=("prev",))
    hidden = repairs.filter("repair_kind = 'narrator_plus_prophet'").select("occurrence_id", T.normalize("hidden_name", T.CARDS).alias("name"))
    opened = met.join(hidden, "occurrence_id").select(*C.POSITION, "occurrence_id", "name", F.col("prev_entity").alias("prev"), F.lit(None).cast("string").alias("next"))
    ref = F.when(F.col("anchor").isNotNull(), F.concat(F.lit("A:"), "anchor")).otherwise(F.concat(F.lit("P:"), T.stable_id("P_", "card_id")))
    refs = first["source_cards"].select("card_id").join(first["links"], "card_id", "left").select("card_id", ref.alias("ref"))
    aliases = CD.source_card_aliases(first["source_cards"]).join(refs, "card_id").select(F.col("alias").alias("key"), F.col("ref").alias("entity")).distinct()
    found = RS.resolve_source_cards(opened, RS.source_card_candidates(opened, RS.plain_index(aliases), first["prev_edges"], first["next_edges"]))
    kind = F.when(F.col("entity").startswith("A:"), "existing_anchor").otherwise("provisional_source_card")
    return found.select("occurrence_id", kind.alias("card_type"), F.expr("substring(entity, 3)").alias("card_id"),
                        F.to_json(F.struct("prev", "score")).alias("evidence"))
