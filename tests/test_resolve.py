from __future__ import annotations

import random

from pyspark.sql import functions as F

from silsila import lexicon as lx
from silsila.operators import analyze as AN
from silsila.operators import blocking as B
from silsila.operators import kinship as KIN
from silsila.operators import relations as RL
from silsila.operators import resolve as RS
from tests.conftest import rows


def chain(spark, *nodes):
    """(chain, seq, name, entity or None)."""
    data = [(c, 0, q, f"{c}-{q}-{i}", n, e, 1) for i, (c, q, n, e) in enumerate(nodes)]
    return spark.createDataFrame(data, "chain_id int, branch_hint int, sequence_index int, occurrence_id string, name string, entity string, is_named int")


def index(spark, *pairs):
    return spark.createDataFrame(list(pairs), "key string, entity string")


def relations(spark, *pairs):
    return spark.createDataFrame(list(pairs), "student string, teacher string")


def graph(spark, occ, idx, rel):
    found = RS.neighbour_passes(RS.open_positions(occ), RS.judge_graph(RS.plain_index(idx), rel))
    return rows(found, "chain_id", "sequence_index", "entity", "score", "pass_no")


def test_graph_rule(spark):
    idx = index(spark, ("x", "x1"), ("x", "x2"))
    occ = chain(spark, (1, 1, "a", "A"), (1, 2, "x", None), (1, 3, "b", "B"))
    assert graph(spark, occ, idx, relations(spark, ("A", "x1"), ("x1", "B"), ("A", "x2"))) == [(1, 2, "x1", 7, 1)]
    both = relations(spark, ("A", "x1"), ("x1", "B"), ("A", "x2"), ("x2", "B"))
    assert graph(spark, occ, idx, both) == []                                     # a tie stays open
    gap = chain(spark, (1, 1, "a", "A"), (1, 3, "x", None), (1, 4, "b", "B"))
    assert graph(spark, gap, idx, relations(spark, ("A", "x1"), ("x1", "B"))) == []


def test_signature_rule(spark):
    data = [(1, 0, 2, "a", "x", "E", "P", "N"), (2, 0, 2, "b", "x", "E", "P", "N"), (3, 0, 2, "c", "x", None, "P", "N"), (4, 0, 2, "d", "x", None, "Q", "N")]
    df = spark.createDataFrame(data, "chain_id int, branch_hint int, sequence_index int, occurrence_id string, name string, entity string, prev string, next string")
    assert rows(RS.propagate_signatures(df), "occurrence_id", "entity", "support") == [("c", "E", 2)]


def specific_state(spark, n=9):
    """Names resolve one after the other: each pass proves the next position."""
    nodes = [(1, 1, "n1", "e1")] + [(1, q, f"n{q}", None) for q in range(2, n + 1)]
    rel = [(f"e{q - 1}", f"e{q}") for q in range(2, n + 1)]
    return chain(spark, *nodes), rel


def test_passes_feed_each_other_and_stop(spark):
    occ, rel = specific_state(spark)
    idx = spark.createDataFrame([(f"n{q}", f"e{q}", 10) for q in range(1, 10)], "name string, candidate string, name_score int")
    prev, nxt = RS.relation_edges(relations(spark, *rel))
    judge = RS.judge_specific(idx, prev, nxt)
    found = RS.neighbour_passes(RS.open_positions(occ), judge)
    assert rows(found, "sequence_index", "entity", "pass_no") == [(q, f"e{q}", q - 1) for q in range(2, 10)]   # as many passes as there is news
    assert found.select("method").distinct().count() == 1


def test_passes_write_their_news_only(spark, monkeypatch):
    """Many positions that nothing is told to are written once; a pass writes its news and the positions beside them."""
    occ, rel = specific_state(spark)
    idle = spark.range(500).select(F.col("id").cast("int").alias("chain_id") + 10, F.lit(0).alias("branch_hint"), F.lit(1).alias("sequence_index"),
                                   F.concat(F.lit("idle"), "id").alias("occurrence_id"), F.lit("n5").alias("name"), F.lit(None).cast("string").alias("entity"), F.lit(1).alias("is_named"))
    idle = idle.toDF(*occ.columns)
    idx = spark.createDataFrame([(f"n{q}", f"e{q}", 10) for q in range(1, 10)], "name string, candidate string, name_score int")
    prev, nxt = RS.relation_edges(relations(spark, *rel))
    judge = RS.judge_specific(idx, prev, nxt)
    opened, written, real = RS.open_positions(occ.unionByName(idle)), [], RS.checkpointed
    monkeypatch.setattr(RS, "checkpointed", lambda df: written.append(real(df)) or written[-1])
    for limit in (RS.FRONTIER, 0):                                                # broadcast and shuffled frontiers
        monkeypatch.setattr(RS, "FRONTIER", limit)
        written.clear()
        assert RS.neighbour_passes(opened, judge).count() == 8
        sizes = [w.count() for w in written]
        assert sizes[0] == 508 and sum(sizes[1:]) <= 3 * 8


def test_only_trusted_statuses_count(spark):
    found = spark.createDataFrame([("a", "strong_graph"), ("b", "guess"), ("c", None)], "occurrence_id string, layer string")
    assert rows(RS.trusted(found, lx.TRUSTED_STATUSES), "occurrence_id") == [("a",)]


def test_specific_rules(spark):
    occ = chain(spark, (1, 1, "a", "A"), (1, 2, "x", None), (1, 3, "b", "B"), (2, 1, "a", "A"), (2, 2, "y", None), (3, 1, "a", "A"), (3, 2, "z", None), (4, 1, "a", "A"), (4, 2, "w", None))
    idx = spark.createDataFrame([("x", "x1", 7), ("x", "x2", 10), ("y", "y1", 8), ("y", "y2", 8), ("z", "z1", 7), ("w", "w1", 9), ("w", "w2", 9)], "name string, candidate string, name_score int")
    prev, nxt = RS.relation_edges(relations(spark, ("A", "x1"), ("x1", "B"), ("A", "y1"), ("A", "z1"), ("A", "w1"), ("A", "w2")))
    found = RS.neighbour_passes(RS.open_positions(occ), RS.judge_specific(idx, prev, nxt))
    assert rows(found, "chain_id", "entity", "method", "score") == [
        (1, "x1", "two_sided_specific_context", 17), (2, "y1", "strong_name_specific_context", 13)]


def test_block_size_is_no_limit(spark):
    idx = spark.createDataFrame([("x", f"x{i}", 9) for i in range(5)], "name string, candidate string, name_score int")
    occ = chain(spark, (1, 1, "a", "A"), (1, 2, "x", None))
    prev, nxt = RS.relation_edges(relations(spark, ("A", "x1")))
    assert RS.neighbour_passes(RS.open_positions(occ), RS.judge_specific(idx, prev, nxt)).count() == 1
    sizes = B.block_sizes(idx.select(F.col("name").alias("key"), F.col("candidate").alias("entity")))
    assert rows(sizes) == [("x", 5)]


def test_recommendation(spark):
    data = [(1, 5.0, None), (2, 6.0, 4.0), (2, 4.0, 3.0), (2, 4.0, 4.0)]
    df = spark.createDataFrame(data, "candidate_count int, top_score double, runner_up_score double")
    got = [r["recommendation"] for r in RS.recommend(df).collect()]
    assert got == ["unique_candidate_high", "unique_top_strong", "unique_top_review", "ambiguous"]


def test_queue_summary_is_exact(spark):
    """The profile of a block gives what listing every candidate would."""
    rnd = random.Random(5)
    ents = [f"e{i:02d}" for i in range(40)]
    names = {e: rnd.choice(["x", "y z"]) for e in ents}
    years = {e: (rnd.choice([None, 0, 100, 110, 120]), rnd.choice([None, 105, 115, 125])) for e in ents}
    rel = {(rnd.choice(ents), rnd.choice(ents)) for _ in range(300)}
    nodes, ctx = [], {}
    for c in range(80):
        p, x, n = rnd.choice([None, *ents]), rnd.choice([None, *ents]), rnd.choice(["x", "y z"])
        nodes += [(c, 1, "k", p), (c, 2, n, None), (c, 3, "k", x)]
        ctx[c] = (n, p, x)
    opened = RS.open_positions(chain(spark, *nodes)).filter("sequence_index = 2")
    idx = index(spark, *[(n, e) for e, n in names.items()])
    yr = spark.createDataFrame([(e, *v) for e, v in years.items()], "entity string, birth_year int, death_year int")
    cand = RS.queue_candidates(opened, idx, relations(spark, *rel), yr)
    got = {r["chain_id"]: (r["candidate_count"], r["top_entity"], r["top_score"], r["runner_up_score"], r["top_is_unique"]) for r in RS.queue_summary(opened, cand, idx, yr).collect()}
    for c, (n, p, x) in ctx.items():
        scored = []
        for e in (e for e in ents if names[e] == n):
            s = min(3.0, 0.5 + 0.5 * len(n.split())) + 3 * ((p, e) in rel) + 3 * ((e, x) in rel)
            cb, cd = years[e]
            pd = years[p][1] if p else None
            nb = years[x][0] if x else None
            s -= 4 * bool(cb and pd and cb > pd) + 4 * bool(nb and cd and nb > cd)
            scored.append((-s, e))
        scored.sort()
        run = -scored[1][0]
        assert got[c] == (len(scored), scored[0][1], -scored[0][0], run, int(-scored[0][0] > run)), c


def test_penalty_classes_count_quadrants(spark):
    """One name with thousands of year pairs, against counting every candidate; unknown years and years of 0 never speak."""
    rnd = random.Random(9)
    year = lambda: rnd.choice([None, 0, *range(1, 400)])
    people = [(f"{i:05d}", year(), year()) for i in range(3000)]
    data = spark.createDataFrame([("x", b, d, e) for e, b, d in people], "name string, cb int, cd int, candidate string")
    profile = data.groupBy("name", "cb", "cd").agg(F.count("*").alias("n"), F.min("candidate").alias("first"))
    asked = [(year(), year()) for _ in range(40)] + [(None, None), (399, 1), (1, 399), (100_000, None), (None, 100_000)]
    limits = spark.createDataFrame([(n, p, x) for n in ("x", "absent") for p, x in asked], "name string, prev_death int, next_birth int")
    got = {(r.prev_death, r.next_birth): tuple(r[c] for c in ("n0", "n4", "n8", "first0", "first4", "first8")) for r in RS.penalty_classes(limits, profile).collect()}
    assert len(got) == len(set(asked))
    for p, x in asked:
        group = {0: [], 4: [], 8: []}
        for e, b, d in people:
            group[4 * bool(b and p and b > p) + 4 * bool(x and d and x > d)].append(e)
        assert got[p, x] == tuple(len(g) for g in group.values()) + tuple(min(g, default=None) for g in group.values()), (p, x)


def test_penalty_classes_without_years(spark):
    profile = spark.createDataFrame([("x", None, None, 3, "a")], "name string, cb int, cd int, n long, first string")
    limits = spark.createDataFrame([("x", None, 7)], "name string, prev_death int, next_birth int")
    assert rows(RS.penalty_classes(limits, profile), "n0", "n4", "n8", "first0") == [(3, 0, 0, "a")]
    assert RS.penalty_classes(limits, profile.limit(0)).count() == 0


def test_support_needs_a_relation(spark):
    occ = chain(spark, (1, 1, "a", "A"), (1, 2, "x", None), (1, 3, "b", "B"), (2, 1, "a", "A"), (2, 2, "x", None))
    unique = spark.createDataFrame([("x", "x1")], "name string, entity string")
    rel = relations(spark, ("A", "x1"), ("x1", "B"))
    full = rows(RS.resolve_with_support(RS.open_positions(occ), unique, rel, "two", "one"), "chain_id", "status", "score")
    assert full == [(1, "two", 6), (2, "one", 5)]
    fewer = rows(RS.resolve_with_support(RS.open_positions(occ), unique, relations(spark, ("x1", "B")), "two", "one"), "chain_id", "status", "score")
    assert fewer == [(1, "one", 5)]                                              # fewer relations never add a resolution


def test_name_index_scores(spark):
    cards = spark.createDataFrame([("c1", "مالك بن انس"), ("c2", "مالك بن انس الاصبحي"), ("c3", "محمد بن شهاب الزهري"), ("c4", "علي بن زيد مالك")], "entity string, identity_norm string")
    names = spark.createDataFrame([("مالك بن انس",), ("بن شهاب",), ("الزهري",), ("مالك",), ("زيد مالك",)], "name string")
    got = {(r["name"], r["entity"]): r["name_score"] for r in B.name_index(cards, names).collect()}
    assert got == {("مالك بن انس", "c1"): 10, ("مالك بن انس", "c2"): 9, ("بن شهاب", "c3"): 8, ("الزهري", "c3"): 5, ("مالك", "c1"): 9, ("مالك", "c2"): 9, ("مالك", "c4"): 5}
    short = {(r["name"], r["entity"]): r["name_score"] for r in B.name_index(cards, names, max_tokens=2).collect()}
    assert short == got                                                          # long names are compared in full
    more = B.name_index(cards, names, aliases=spark.createDataFrame([("الزهري", "c4")], "name string, entity string"))
    assert more.filter("entity = 'c4' AND name_score = 9").count() == 1


def test_a_card_is_pooled_by_any_of_its_texts(spark):
    cards = spark.createDataFrame([("c1", "مالك بن انس", "ابو زيد مالك الاصبحي")], "entity string, identity_norm string, sec string")
    names = spark.createDataFrame([("مالك الاصبحي",), ("زيد مالك",)], "name string")
    got = B.name_index(cards, names, texts=("identity_norm", "sec"))
    assert rows(got, "name", "entity", "name_score") == [("مالك الاصبحي", "c1", 5)]


def test_listed_nodes_need_whole_tokens(spark):
    lists = spark.createDataFrame([("c1", "نافع بن سالم ومالك"), ("c2", "نافعة بن سالمة")], "card string, text string")
    keys = spark.createDataFrame([("n1", "نافع بن سالم"), ("n2", "نافع بن")], "node string, key string")
    for size in (8, 2, 1):
        assert rows(RL.listed_nodes(lists, "card", "text", keys, size)) == [("c1", "n1"), ("c1", "n2")]


def test_reconcile(spark):
    ev = spark.createDataFrame([("a", "b", "teacher_list"), ("a", "b", "student_list"), ("a", "c", "teacher_list"), ("d", "a", "student_list")], "student string, teacher string, direction string")
    assert rows(RL.reconcile(ev), "student", "teacher", "status") == [("a", "b", "bilateral_reported"), ("a", "c", "teacher_list_only"), ("d", "a", "student_list_only")]


# -- kinship ------------------------------------------------------------------------------------


def kin(spark, names, nodes):
    entries = spark.createDataFrame([(f"E{i}", n) for i, n in enumerate(names)], "entry string, name_norm string")
    data = [(1, 0, q, f"o{q}", e, t, lab) for q, e, t, lab in nodes]
    occ = spark.createDataFrame(data, "chain_id int, branch_hint int, sequence_index int, occurrence_id string, entity string, token string, label string")
    return entries, occ


def test_father(spark):
    entries, occ = kin(spark, ["هشام بن عروة بن الزبير بن العوام", "عروة بن الزبير بن العوام"], [(1, "E0", None, ""), (2, None, "ابيه", "")])
    assert rows(KIN.resolve_kinship(occ, entries), "entity", "score", "status") == [("E1", 7, "resolved")]


def test_twelve_fathers_in_a_row(spark):
    names = [" بن ".join(f"n{i}" for i in range(k, 16)) for k in range(13)]
    entries, occ = kin(spark, names, [(1, "E0", None, "")] + [(q, None, "ابيه", "") for q in range(2, 14)])
    got = sorted(rows(KIN.resolve_kinship(occ, entries), "sequence_index", "entity", "pass_no"))
    assert got == [(q, f"E{q - 1}", q - 1) for q in range(2, 14)]


def test_kin_nodes_in_a_group(spark):
    entries, occ = kin(spark, ["هشام بن عروة بن الزبير بن العوام", "عروة بن الزبير بن العوام بن خويلد", "الزبير بن العوام بن خويلد"],
                       [(1, "E0", None, ""), (2, None, "ابيه", ""), (2, None, "جده", ""), (3, None, "ابيه", "")])
    # both nodes of the group are judged, yet a group governs nothing
    assert rows(KIN.resolve_kinship(occ, entries), "sequence_index", "token", "entity", "status") == [
        (2, "ابيه", "E1", "resolved"), (2, "جده", None, "unresolved")]


def test_father_then_grandfather(spark):
    entries, occ = kin(spark, ["بهز بن حكيم بن معاوية بن حيدة بن قشير", "حكيم بن معاوية بن حيدة بن قشير", "معاوية بن حيدة بن قشير"],
                       [(1, "E0", None, ""), (2, None, "ابيه", ""), (3, None, "جده", "")])
    assert rows(KIN.resolve_kinship(occ, entries), "sequence_index", "entity", "score", "pass_no") == [(2, "E1", 7, 1), (3, "E2", 8, 2)]


def test_short_lineage_and_ties_stay_open(spark):
    entries, occ = kin(spark, ["زيد بن اسلم", "اسلم"], [(1, "E0", None, ""), (2, None, "ابيه", "")])
    assert rows(KIN.resolve_kinship(occ, entries), "entity", "score", "status") == [(None, 0, "unresolved")]
    entries, occ = kin(spark, ["علي بن زيد بن عمر بن سعد", "زيد بن عمر بن سعد", "زيد بن عمر بن سعد القرشي"], [(1, "E0", None, ""), (2, None, "ابيه", "")])
    assert rows(KIN.resolve_kinship(occ, entries), "entity", "score", "status") == [(None, 7, "unresolved")]


def test_explicit_relative(spark):
    entries, occ = kin(spark, ["عباية بن رفاعة", "رافع بن خديج بن رافع"], [(1, "E0", None, ""), (2, None, "جده", "رافع بن خديج بن رافع")])
    people = entries.withColumn("intro", F.lit(""))
    kunyas = spark.createDataFrame([("ابو جحيفة", "E0")], "key string, entry string")
    found = KIN.label_matches(occ.filter("label <> ''").select("label"), people, kunyas)
    assert rows(KIN.resolve_kinship(occ, entries, found), "entity", "score", "status") == [("E1", 9, "resolved")]


def test_unresolved_kin_nodes_keep_their_best_candidates(spark):
    names = ["علي بن زيد بن عمر بن سعد"] + ["زيد بن عمر بن سعد"] * 7
    entries, occ = kin(spark, names, [(1, "E0", None, ""), (2, None, "ابيه", "")])
    got = KIN.resolve_kinship(occ, entries).first()
    assert (got.status, got.candidate_count) == ("unresolved", 7) and [tuple(c) for c in got.top] == [(f"E{i}", 7) for i in range(1, 6)]
    entries, occ = kin(spark, ["عباية بن رفاعة", "رافع بن خديج بن رافع", "رافع بن خديج بن رافع"], [(1, "E0", None, ""), (2, None, "جده", "رافع بن خديج"), (3, "E0", None, ""), (4, None, "جده", "x y")])
    found = KIN.label_matches(occ.filter("label <> ''").select("label"), entries.withColumn("intro", F.lit("")), spark.createDataFrame([], "key string, entry string"))
    got = sorted(KIN.resolve_kinship(occ, entries, found).collect(), key=lambda r: r.sequence_index)
    assert [(r.status, r.candidate_count, [tuple(c) for c in r.top]) for r in got] == [("unresolved", 2, [("E1", 9), ("E2", 9)]), ("unresolved", 0, [])]
    entries, occ = kin(spark, ["هشام بن عروة بن الزبير بن العوام", "عروة بن الزبير بن العوام"], [(1, "E0", None, ""), (2, None, "ابيه", "")])
    assert rows(KIN.resolve_kinship(occ, entries), "entity", "candidate_count", "top") == [("E1", None, None)]


def test_kin_tokens(spark):
    df = spark.createDataFrame([("ابيه", "relational_or_unknown"), ("جده رافع بن خديج قال", "named_candidate"), ("ابيه", "named_candidate"), ("علي", "named_candidate")], "n string, k string")
    token, label = KIN.kin_tokens("n", "k")
    assert [tuple(r) for r in df.select(token, label).collect()] == [("ابيه", ""), ("جده", "رافع بن خديج"), (None, ""), (None, "")]


# -- link status ----------------------------------------------------------------------------------


def test_chronology_and_status(spark):
    cards = spark.createDataFrame([("s", "thiqa", 7, 150, None, 0), ("t", "weak", 5, None, 120, 0), ("u", "thiqa", 3, 90, 0, 1), ("v", "thiqa", 9, None, None, 0)],
                                  "entity string, grade string, tabaqa int, birth_year int, death_year int, has_tadlis int")
    pairs = spark.createDataFrame([("s", "t", "حدثنا"), ("u", "s", "عن"), ("u", "t", "حدثنا"), ("u", "v", "عن"), ("t", "u", "عن"), ("v", "t", "عن")], "student string, teacher string, term string")
    reported = spark.createDataFrame([("u", "s", "bilateral_reported"), ("t", "u", "teacher_list_only")], "student string, teacher string, status string")
    observed = spark.createDataFrame([("u", "t", 2), ("v", "t", 1)], "student string, teacher string, evidence_count int")
    got = {(r["student"], r["teacher"]): r for r in AN.judge_pairs(pairs, reported, observed, cards).withColumn("doc", AN.evidence_json()).collect()}
    status = {k: r["continuity_status"] for k, r in got.items()}
    assert status == {("s", "t"): "chronology_conflict", ("u", "s"): "reported_but_tadlis_review", ("u", "t"): "observed_repeated_needs_reported_source",
                      ("u", "v"): "tadlis_review", ("t", "u"): "supported_reported_and_observed", ("v", "t"): "observed_only_needs_review"}
    assert got[("s", "t")]["chronology_status"] == "conflict_student_born_after_teacher_death"
    assert got[("u", "s")]["chronology_status"] == "possible_generation_reversal"          # a year of 0 is no year
    assert got[("v", "t")]["chronology_status"] == "unknown" and got[("v", "t")]["weakness"] == "teacher:weak"
    assert '"observed_count":2' in got[("u", "t")]["doc"]



def test_list_context_against_brute_force(spark, monkeypatch):
    draw = random.Random(5)
    cards, raws, canons = [f"k{i:02d}" for i in range(40)], [f"r{i}" for i in range(12)], ["c0", "c1", "c2"]
    canon_of = {r: draw.choice(canons) for r in raws}
    idx = [(draw.choice(["x", "x", "y"]), c) for c in cards] + [("alone", "k00")]
    lists = {(side, c): set(draw.sample(raws, draw.choice([0, 1, 2]))) for side in ("prev", "next") for c in cards}
    spelled = {(side, c): {canon_of[r] for r in names} | ({draw.choice(canons)} if draw.random() < 0.3 else set()) for (side, c), names in lists.items()}
    opened = []
    for i in range(400):
        p, n = (draw.choice([*raws, None]) for _ in range(2))
        opened.append((i, 0, 1, f"o{i}", draw.choice(["x", "y", "alone"]), p, canon_of.get(p), n, canon_of.get(n) if draw.random() < 0.9 else None))

    def weight(side, card, r, c):
        return 3 if r in lists[side, card] else 2 if c in spelled[side, card] else 0

    want = []
    for i, _, _, _, name, p, pc, n, nc in opened:
        block = {c for key, c in idx if key == name}
        scores = sorted(((weight("prev", c, p, pc) + weight("next", c, n, nc), c) for c in block), key=lambda x: (-x[0], x[1]))
        if len(block) > 1 and scores[0][0] >= 5 and scores[0][0] > scores[1][0]:
            want.append((i, scores[0][1], scores[0][0], scores[1][0], len(block)))
    edges = [spark.createDataFrame([(f"{side}_raw", r, c, 3) for (s, c), names in lists.items() if s == side for r in names]
                                   + [(f"{side}_canon", k, c, 2) for (s, c), names in spelled.items() if s == side for k in names],
                                   "node_kind string, node string, candidate string, weight int") for side in ("prev", "next")]
    occ = spark.createDataFrame(opened, "chain_id int, branch_hint int, sequence_index int, occurrence_id string, name string, "
                                        "prev_raw string, prev_canon string, next_raw string, next_canon string")
    kinds, listed = set(), RS.supported_candidates
    monkeypatch.setattr(RS, "supported_candidates", lambda contexts, index, prev, nxt, *rest: [
        kinds.update(r[0] for r in e.select("node_kind").distinct().collect()) for e in (prev, nxt)] and listed(contexts, index, prev, nxt, *rest))
    found = RS.resolve_list_context(occ, RS.plain_index(index(spark, *idx)), *edges, ("prev_raw", "prev_canon"), ("next_raw", "next_canon"),
                                    ("prev_canon", "next_canon"))
    assert rows(found, "chain_id", "entity", "score", "runner_up", "candidate_count") == sorted(want, key=repr) and len(want) > 20
    assert {w[3] for w in want} >= {2, 3, 4} and kinds == {"prev_raw", "next_raw"}        # a common canonical name lists no candidates


def test_kunya_labels_meet_distinct_texts_by_trigrams(spark):
    draw = random.Random(7)
    words = ["الكوفي", "كوفي", "البصري", "بصر", "\U0001d400\U0001d401\U0001d402", "x\U0001d400yz", "aab", "aaab", "ab", "م"]
    people = [(f"p{i}", draw.choice(["ابو زيد", "ابو علي"]), draw.choice(["", " "]).join(draw.choices(words, k=draw.choice([0, 2, 4])))) for i in range(200)]
    labels = {" ".join([draw.choice(["ابي", "ابو"]), draw.choice(["زيد", "علي", "بكر"]), *draw.choices(words, k=draw.choice([0, 1, 2]))]) for _ in range(150)}
    want = []
    for label in labels:
        t = label.split(" ")
        extras = [x for x in t[2:] if len(x) > 2]
        want += [(label, p, 9 if extras else 6) for p, key, text in people if key == "ابو " + t[1] and all(x in text for x in extras)]
    entries = spark.createDataFrame([(p, "", text) for p, _, text in people], "entry string, name_norm string, intro string")
    keys = spark.createDataFrame([(key, p) for p, key, _ in people], "key string, entry string")
    texts = spark.createDataFrame([(x,) for x in labels], "label string")
    assert rows(KIN.label_matches(texts, entries, keys)) == sorted(want, key=repr) and {w[2] for w in want} == {6, 9}
    # a text shared by many entries is judged once, and a label meets only texts with its rarest trigram
    judged = KIN._texts_with_all(spark.createDataFrame([("l", "k", ["abcd"])], "label string, key string, extras array<string>"),
                                 spark.createDataFrame([("k", "1", "x abcde"), ("k", "2", "abc"), ("j", "3", "abcd")], "key string, text_id string, intro string"))
    assert rows(judged) == [("l", "k", "1")]
