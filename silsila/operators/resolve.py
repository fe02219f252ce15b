"""Resolution rules. A rule resolves an occurrence to one entity or leaves it alone.

Every rule here needs evidence from a neighbour, so candidates come out of the evidence
(relation edges joined on name and neighbour together) and the block of a common name is
never enumerated. Contexts (name, previous, next) are judged once and joined back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from silsila.operators.blocking import block_sizes, unique_keys
from silsila.operators.chains import POSITION, guarded_neighbours
from silsila.plans.session import checkpointed

CONTEXT = ["name", "prev", "next"]


def open_positions(occ: DataFrame, named: str = "is_named") -> DataFrame:
    """Unresolved named singletons with the entities of their guarded neighbours.

    ``occ``: chain_id, branch_hint, sequence_index, occurrence_id, name, entity (NULL when
    unresolved) and a 0/1 column ``named``.
    """
    met = guarded_neighbours(occ, ["occurrence_id", "name", "entity", named])
    return met.filter(F.col("entity").isNull() & (F.col(named) == 1)).select(
        *POSITION, "occurrence_id", "name", F.col("prev_entity").alias("prev"), F.col("next_entity").alias("next"))


def supported_candidates(contexts: DataFrame, index: DataFrame, prev_edges: DataFrame, next_edges: DataFrame,
                         context: list[str] = CONTEXT, prev_keys=("prev",), next_keys=("next",)) -> DataFrame:
    """Candidates of each context that at least one neighbour supports.

    ``index``: name, candidate, name_score. ``prev_edges``: node_kind, node, candidate, weight;
    ``node_kind`` names the context column the node is looked up in (``prev_keys``). Result:
    context columns, candidate, name_score, prev_weight, next_weight (0 = no support).
    """
    used = index.join(contexts.select("name").distinct(), "name", "left_semi")
    found = None
    for side, edges, keys in (("prev", prev_edges, prev_keys), ("next", next_edges, next_keys)):
        named = edges.join(used, "candidate")
        for key in keys:
            rows = contexts.filter(F.col(key).isNotNull()).join(
                named.filter(F.col("node_kind") == key).select("name", F.col("node").alias(key), "candidate", "name_score", "weight"),
                ["name", key]).select(
                *context, "candidate", "name_score",
                (F.col("weight") if side == "prev" else F.lit(0)).alias("prev_weight"),
                (F.col("weight") if side == "next" else F.lit(0)).alias("next_weight"))
            found = rows if found is None else found.unionByName(rows)
    return found.groupBy(*context, "candidate").agg(
        F.max("name_score").alias("name_score"), F.max("prev_weight").alias("prev_weight"), F.max("next_weight").alias("next_weight"))


def relation_edges(relations: DataFrame, weight: int = 1) -> tuple[DataFrame, DataFrame]:
    """Edges for :func:`supported_candidates` from (student, teacher) relations.

    The previous chain node must be a student of the candidate, the next one a teacher.
    """
    prev = relations.select(F.lit("prev").alias("node_kind"), F.col("student").alias("node"), F.col("teacher").alias("candidate"), F.lit(weight).alias("weight"))
    nxt = relations.select(F.lit("next").alias("node_kind"), F.col("teacher").alias("node"), F.col("student").alias("candidate"), F.lit(weight).alias("weight"))
    return prev, nxt


def plain_index(index: DataFrame) -> DataFrame:
    """Blocking index (key, entity) as a candidate index with no name score."""
    return index.select(F.col("key").alias("name"), F.col("entity").alias("candidate")).distinct().withColumn("name_score", F.lit(0))


def best_two(scored: DataFrame, context: list[str], score: str, carry: list[str]) -> DataFrame:
    """Best row per context with the runner-up score (NULL when alone).

    The rank filter runs below the shuffle too (window group limit), so a context with very
    many candidates sends at most two rows per task.
    """
    w = W.partitionBy(*context).orderBy(F.col(score).desc(), F.col("candidate"))
    top = scored.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= 2)
    first = F.col("__rn") == 1
    return top.groupBy(*context).agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ["candidate", score, *carry]],
        F.max(F.when(~first, F.col(score))).alias("runner_up"))


def top_k(scored: DataFrame, context: list[str], score: str, k: int = 5) -> DataFrame:
    """(context, top): the ``k`` best candidates of each context as (candidate, score), best first, ties by candidate.

    Like in :func:`best_two` the rank filter runs below the shuffle, so at most ``k`` rows per context and task are sent.
    """
    w = W.partitionBy(*context).orderBy(F.col(score).desc(), F.col("candidate"))
    best = scored.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)
    ordered = F.array_sort(F.collect_list(F.struct("__rn", "candidate", F.col(score).cast("int").alias("score"))))
    return best.groupBy(*context).agg(F.transform(ordered, lambda r: F.struct(r["candidate"].alias("candidate"), r["score"].alias("score"))).alias("top"))


def trusted(resolved: DataFrame, statuses, status: str = "layer") -> DataFrame:
    """Resolutions whose status is on the list; others are no evidence and count as open."""
    return resolved.filter(F.col(status).isin(*statuses))


# -- R-01 and R-11: unique names need no neighbour ----------------------------------------

def resolve_unique_names(occ: DataFrame, index: DataFrame, name: str = "name") -> DataFrame:
    """Occurrences whose name is a key of exactly one entity; score 1."""
    return occ.join(unique_keys(index.withColumnRenamed("key", name), name), name).withColumn("score", F.lit(1.0))


# -- R-02: teacher and student lists of the candidates -------------------------------------

def resolve_list_context(open_pos: DataFrame, index: DataFrame, prev_edges: DataFrame, next_edges: DataFrame,
                         prev_keys: tuple, next_keys: tuple, canonical: tuple[str, str]) -> DataFrame:
    """Ambiguous names: raw neighbour name in a list counts 3, its canonical name 2; promote at
    five and more when strictly best.

    ``canonical``: the key of each side that holds the canonical name. Five needs a raw name on one side and some name on the
    other, so candidates are listed only where a raw name meets them. All others reach four at most: they are counted per
    (name, canonical names), and only for contexts that they could still spoil.
    """
    context = ["name", *prev_keys, *next_keys]
    sizes = block_sizes(index.select(F.col("name").alias("key"), F.col("candidate").alias("entity")))
    sizes = sizes.filter(F.col("block_size") > 1).select(F.col("key").alias("name"), F.col("block_size").alias("candidate_count"))
    told = [F.greatest(*[F.col(k).isNotNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNotNull() for keys in (prev_keys, next_keys)]
    contexts = open_pos.select(*context).filter(told[0] & told[1]).distinct().join(sizes, "name", "left_semi")
    # the evidence is read for the raw names, for the canonical ones and for the counts
    edges = [checkpointed(e) for e in (prev_edges, next_edges)]
    raw = [e.filter(F.col("node_kind") != key) for e, key in zip(edges, canonical)]
    canon = [e.filter(F.col("node_kind") == key).groupBy(F.col("node").alias(key), "candidate").agg(F.max("weight").alias("__weight"))
             for e, key in zip(edges, canonical)]
    rows = supported_candidates(contexts, index, *raw, context, *[tuple(k for k in keys if k not in canonical) for keys in (prev_keys, next_keys)])
    for side, known, key in zip(("prev", "next"), canon, canonical):
        rows = rows.join(known, [key, "candidate"], "left").withColumn(f"by_{side}", F.col("__weight").isNotNull().cast("int"))
        rows = rows.withColumn(f"{side}_weight", F.greatest(f"{side}_weight", "__weight")).drop("__weight")
    scored = checkpointed(rows.withColumn("score", F.col("prev_weight") + F.col("next_weight")))
    best = best_two(scored, context, "score", ["prev_weight", "next_weight"])
    best = best.filter((F.col("score") >= 5) & (F.col("score") > F.coalesce("runner_up", F.lit(0))))
    listed = scored.groupBy(*context).agg(F.sum(F.col("by_prev") * F.col("by_next")).alias("in_both"), F.sum(F.greatest("by_prev", "by_next")).alias("in_one"))
    best = checkpointed(_same(best, listed, context).select("l.*", "r.in_both", "r.in_one"))
    best = _same(best, _canonical_counts(best, index, canon, canonical), ["name", *canonical]).select("l.*", "r.with_both", "r.with_one")
    rest = F.when(F.col("with_both") > F.col("in_both"), 4).when(F.col("with_one") > F.col("in_one"), 2).otherwise(0)
    won = best.withColumn("runner_up", F.greatest(F.coalesce("runner_up", F.lit(0)), rest)).join(sizes, "name")
    return _same(open_pos, won, context).select("l.*", F.col("r.candidate").alias("entity"), "r.score", "r.runner_up", "r.candidate_count",
                                                "r.prev_weight", "r.next_weight")


def _same(left: DataFrame, right: DataFrame, context: list[str]) -> DataFrame:
    """Rows ``l`` and ``r`` of the same context; NULL is a neighbour name like any other."""
    return left.alias("l").join(right.alias("r"), [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in context])


def _canonical_counts(contexts: DataFrame, index: DataFrame, canon: list[DataFrame], keys: tuple[str, str]) -> DataFrame:
    """Per (name, canonical names) of the contexts: candidates with both names in their lists, and with one or both."""
    asked = contexts.select("name", *keys).distinct()
    used = index.select("name", "candidate").join(asked.select("name").distinct(), "name", "left_semi")
    held = [known.join(used, "candidate").select("name", key, "candidate") for known, key in zip(canon, keys)]
    each = [h.groupBy("name", key).agg(F.count(F.lit(1)).alias(f"with_{key}")) for h, key in zip(held, keys)]
    both = asked.join(held[0], ["name", keys[0]]).join(held[1], ["name", keys[1], "candidate"]).groupBy("name", *keys).agg(F.count(F.lit(1)).alias("with_both"))
    counts = asked.join(each[0], ["name", keys[0]], "left").join(each[1], ["name", keys[1]], "left").join(both, ["name", *keys], "left")
    n = {c: F.coalesce(c, F.lit(0)) for c in ("with_both", *[f"with_{key}" for key in keys])}
    return counts.select("name", *keys, n["with_both"].alias("with_both"),
                         (n[f"with_{keys[0]}"] + n[f"with_{keys[1]}"] - n["with_both"]).alias("with_one"))


# -- R-03, R-12: repeated passes over neighbours ------------------------------------------

def judge_graph(index: DataFrame, relations: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """R-03: both neighbours resolved and exactly one candidate fits both relations; score 7."""
    used = index.join(relations.select(F.col("teacher").alias("candidate")).distinct(), "candidate", "left_semi")
    # the evidence is the same in every pass, so it is computed once
    by_prev = checkpointed(relations.select(F.col("student").alias("prev"), F.col("teacher").alias("candidate")).distinct().join(
        used.select("name", "candidate"), "candidate"))
    by_next = checkpointed(relations.select(F.col("student").alias("candidate"), F.col("teacher").alias("next")).distinct())

    def judge(contexts: DataFrame) -> DataFrame:
        both = contexts.filter(F.col("prev").isNotNull() & F.col("next").isNotNull())
        hits = both.join(by_prev, ["name", "prev"]).join(by_next, ["candidate", "next"])
        fit = hits.groupBy(*CONTEXT).agg(F.min("candidate").alias("entity"), F.max("candidate").alias("__last"))
        return fit.filter(F.col("entity") == F.col("__last")).drop("__last").withColumn(
            "method", F.lit("reported_graph_two_sided")).withColumn("score", F.lit(7))

    return judge


def judge_specific(index: DataFrame, prev_edges: DataFrame, next_edges: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """R-12: name score plus 5 per supporting side, promoted by three rules.

    Unsupported candidates reach ten at most, so they never spoil a margin of a promoted one;
    only the number of candidates of the name is needed from the whole block.
    """
    sizes = block_sizes(index.select(F.col("name").alias("key"), F.col("candidate").alias("entity")))
    sizes = sizes.select(F.col("key").alias("name"), "block_size")
    # the evidence is the same in every pass, so it is computed once
    index, sizes = checkpointed(index), checkpointed(sizes)
    prev_edges, next_edges = checkpointed(prev_edges), checkpointed(next_edges)

    def judge(contexts: DataFrame) -> DataFrame:
        some = contexts.filter(F.col("prev").isNotNull() | F.col("next").isNotNull())
        scored = supported_candidates(some, index, prev_edges, next_edges)
        scored = scored.withColumn("sides", (F.col("prev_weight") > 0).cast("int") + (F.col("next_weight") > 0).cast("int"))
        scored = scored.withColumn("score", F.col("name_score") + 5 * F.col("sides"))
        w = W.partitionBy(*CONTEXT).orderBy(F.col("score").desc(), F.col("sides").desc(), F.col("name_score").desc(), F.col("candidate").desc())
        top = scored.withColumn("__rn", F.row_number().over(w)).filter("__rn <= 2")
        first = F.col("__rn") == 1
        best = top.groupBy(*CONTEXT).agg(
            *[F.max(F.when(first, F.col(c))).alias(c) for c in ("candidate", "score", "sides", "name_score")],
            F.coalesce(F.max(F.when(~first, F.col("score"))), F.lit(-99)).alias("runner_up")).join(sizes, "name")
        two = (F.col("sides") >= 2) & (F.col("score") >= 17) & (F.col("score") >= F.col("runner_up") + 2)
        strong = (F.col("sides") >= 1) & (F.col("name_score") >= 8) & (F.col("score") >= 13) & (F.col("score") >= F.col("runner_up") + 3)
        alone = (F.col("block_size") == 1) & (F.col("name_score") >= 9) & (F.col("sides") >= 1)
        best = best.withColumn("method", F.when(two, "two_sided_specific_context").when(strong, "strong_name_specific_context")
                               .when(alone, "unique_card_specific_context"))
        return best.filter(F.col("method").isNotNull()).select(*CONTEXT, F.col("candidate").alias("entity"), "method", "score")

    return judge


#: Positions told in one pass, up to which they are broadcast: the open positions are then scanned and not shuffled.
FRONTIER = 100_000


def one_pass(positions: DataFrame, judge: Callable[[DataFrame], DataFrame], number: int = 1) -> DataFrame:
    """Positions that the judge resolves from what they know now."""
    verdicts = judge(positions.select(*CONTEXT).distinct())
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"v.{c}")) for c in CONTEXT]
    return positions.alias("s").join(verdicts.alias("v"), same).select(
        *[F.col(f"s.{c}") for c in [*POSITION, "occurrence_id", *CONTEXT]], "v.entity", "v.method", "v.score", F.lit(number).alias("pass_no"))


def _told(news: DataFrame) -> DataFrame:
    """What resolved positions tell the ones beside them: position, new_prev, new_next."""
    side = F.explode(F.array(F.struct((F.col("sequence_index") + 1).alias("at"), F.lit(True).alias("as_prev")),
                             F.struct((F.col("sequence_index") - 1).alias("at"), F.lit(False).alias("as_prev"))))
    return news.select("chain_id", "branch_hint", "entity", side.alias("t")).select(
        "chain_id", "branch_hint", F.col("t.at").alias("sequence_index"),
        F.when(F.col("t.as_prev"), F.col("entity")).alias("new_prev"), F.when(~F.col("t.as_prev"), F.col("entity")).alias("new_next"))


def neighbour_passes(open_pos: DataFrame, judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a judge in passes: what a pass resolves becomes evidence for the next one.

    Each pass sees the state at its start. The open positions are written once; a pass judges only the frontier, which are
    the positions beside the last news, with all that was told to them so far, and writes only its news and the next
    frontier (reliable checkpoints). The loop ends with the first pass without news, and ``pass_no`` tells in which pass a
    position was resolved.
    """
    base = checkpointed(open_pos)
    frontier, done, number = base, None, 0
    while True:
        number += 1
        news = checkpointed(one_pass(frontier, judge, number))
        count = news.count()
        if not count:
            return news if done is None else done
        done = news if done is None else done.unionByName(news)
        small = F.broadcast if 2 * count <= FRONTIER else (lambda df: df)
        beside = small(_told(news).select(*POSITION).distinct())
        known = _told(done).join(beside, POSITION, "left_semi").groupBy(*POSITION).agg(
            F.max("new_prev").alias("new_prev"), F.max("new_next").alias("new_next"))
        known = known.join(done.select(*POSITION).join(beside, POSITION, "left_semi"), POSITION, "left_anti")
        frontier = checkpointed(base.join(small(known), POSITION).select(
            *POSITION, "occurrence_id", "name", F.coalesce("new_prev", "prev").alias("prev"), F.coalesce("new_next", "next").alias("next")))


# -- R-04, R-05: candidate queue ----------------------------------------------------------

def queue_candidates(open_pos: DataFrame, index: DataFrame, relations: DataFrame, years: DataFrame) -> DataFrame:
    """Evidence-bearing candidate rows per context with the four partial scores.

    Candidates without a reported relation all score the same but for the chronology penalty;
    :func:`queue_summary` counts them exactly without listing them.
    """
    prev_edges, next_edges = relation_edges(relations)
    contexts = open_pos.select(*CONTEXT).distinct()
    rows = supported_candidates(contexts, plain_index(index), prev_edges, next_edges)
    born = years.select("entity", "birth_year", "death_year")
    rows = rows.join(born.select(F.col("entity").alias("candidate"), F.col("birth_year").alias("cb"), F.col("death_year").alias("cd")), "candidate", "left")
    rows = _with_limits(rows, born)
    name_score = F.least(F.lit(3.0), 0.5 + 0.5 * F.size(F.split("name", " ")))
    rows = rows.select(
        *CONTEXT, "candidate", name_score.alias("name_score"), (3.0 * F.col("prev_weight")).alias("prev_score"),
        (3.0 * F.col("next_weight")).alias("next_score"), _penalty().alias("penalty"))
    return rows.withColumn("total_score", F.col("name_score") + F.col("prev_score") + F.col("next_score") + F.col("penalty"))


def candidate_blocks(open_pos: DataFrame, index: DataFrame, status: str = "candidate") -> DataFrame:
    """(name, candidate, status) for every open name: the candidates that the supported rows leave out are exactly these,
    in every context of the name. One row per name and candidate, whatever the number of contexts."""
    names = open_pos.select("name").distinct()
    return plain_index(index).join(names, "name", "left_semi").select("name", "candidate", F.lit(status).alias("status"))


def candidate_coverage(open_pos: DataFrame, blocks: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per open name: contexts, block size, rows a full enumeration has, rows with a relation, rows told by the block alone."""
    contexts = open_pos.select(*CONTEXT).distinct().groupBy("name").agg(F.count(F.lit(1)).alias("contexts"))
    sizes = blocks.groupBy("name").agg(F.count(F.lit(1)).alias("block_size"))
    held = candidates.groupBy("name").agg(F.count(F.lit(1)).alias("supported"))
    rows = contexts.join(sizes, "name").join(held, "name", "left").withColumn("supported", F.coalesce("supported", F.lit(0)))
    rows = rows.withColumn("enumerated", F.col("contexts") * F.col("block_size"))
    return rows.withColumn("by_block", F.col("enumerated") - F.col("supported"))


def _with_limits(rows: DataFrame, born: DataFrame) -> DataFrame:
    """Add the death year of the previous and the birth year of the next entity."""
    rows = rows.join(born.select(F.col("entity").alias("prev"), F.col("death_year").alias("prev_death")), "prev", "left")
    return rows.join(born.select(F.col("entity").alias("next"), F.col("birth_year").alias("next_birth")), "next", "left")


def _penalty():
    """-4 if the candidate was born after the student died, -4 if the teacher was born after
    the candidate died. A year of 0 is no year."""
    late = (F.col("cb") > 0) & (F.col("prev_death") > 0) & (F.col("cb") > F.col("prev_death"))
    early = (F.col("next_birth") > 0) & (F.col("cd") > 0) & (F.col("next_birth") > F.col("cd"))
    return F.when(F.coalesce(late, F.lit(False)), -4.0).otherwise(0.0) + F.when(F.coalesce(early, F.lit(False)), -4.0).otherwise(0.0)


def penalty_classes(limits: DataFrame, profile: DataFrame) -> DataFrame:
    """Per (name, prev_death, next_birth): how many candidates of the name have no penalty, one, and both (n0, n4, n8), and
    the smallest id of each class (first0, first4, first8). Names without candidates have no row.

    ``profile``: name, cb, cd, n, first. A candidate is late if born after ``prev_death`` and early if dead before
    ``next_birth``, so each class is a quadrant of its years. Birth years lie in the nodes of a binary tree, one per level,
    and each side of a limit is at most one node per level. Within a node, running counts and running smallest ids along
    the death years answer every ``next_birth``. So name and node are met by equality, and a window holds the distinct
    years of a node, never candidates or pairs of years.
    """
    never = 2**31 - 1
    high = max(profile.agg(F.max("cb")).first()[0] or 0, 0)
    levels = f"sequence(0, {max(high.bit_length(), 1) - 1})"

    def year(c, missing):
        return F.when(F.col(c) > 0, F.col(c)).otherwise(missing).cast("long")

    points = profile.select("name", year("cb", 0).alias("cb"), year("cd", never).alias("at"), "n", "first")
    points = points.select("name", "at", "n", "first", F.explode(F.expr(
        f"transform({levels}, i -> named_struct('level', i, 'place', shiftright(cb, i)))")).alias("k"))
    points = points.groupBy("name", F.col("k.level").alias("level"), F.col("k.place").alias("place"), "at").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"))
    asked = limits.select("name", "prev_death", "next_birth").distinct().withColumn(
        "pd", F.least(year("prev_death", high), F.lit(high).cast("long"))).withColumn("at", year("next_birth", 0))
    sides = F.expr(f"""concat(array(named_struct('level', 0, 'place', pd, 'late', false)), transform({levels}, i -> named_struct(
        'level', i, 'place', shiftright(pd, i) + if(bit_get(pd, i) = 1, -1L, 1L), 'late', bit_get(pd, i) = 0)))""")
    asked = asked.select("name", "prev_death", "next_birth", "at", F.explode(sides).alias("k")).select(
        "name", "prev_death", "next_birth", "at", "k.level", "k.place", "k.late")
    node = ["name", "level", "place"]
    slots = asked.select(*node, "at").distinct()
    rows = points.withColumn("known", F.lit(1)).unionByName(slots.withColumn("known", F.lit(0)), allowMissingColumns=True)
    up = W.partitionBy(*node).orderBy("at", "known").rowsBetween(W.unboundedPreceding, W.currentRow)
    down = W.partitionBy(*node).orderBy(F.desc("at"), F.desc("known")).rowsBetween(W.unboundedPreceding, W.currentRow)
    told = rows.select(*node, "at", "known", F.sum("n").over(up).alias("early"), F.min("first").over(up).alias("early_first"),
                       F.sum("n").over(down).alias("rest"), F.min("first").over(down).alias("rest_first")).filter("known = 0")
    met = asked.join(told.drop("known"), [*node, "at"])
    late = F.col("late")
    parts = {0: (F.when(~late, F.col("rest")), F.when(~late, F.col("rest_first"))),
             4: (F.when(late, F.col("rest")).otherwise(F.col("early")), F.when(late, F.col("rest_first")).otherwise(F.col("early_first"))),
             8: (F.when(late, F.col("early")), F.when(late, F.col("early_first")))}
    out = met.groupBy("name", "prev_death", "next_birth").agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(f"n{k}") for k, (n, _) in parts.items()], *[F.min(f).alias(f"first{k}") for k, (_, f) in parts.items()])
    return out.filter("n0 + n4 + n8 > 0")


def queue_summary(open_pos: DataFrame, candidates: DataFrame, index: DataFrame, years: DataFrame) -> DataFrame:
    """Candidate count, best, runner-up and recommendation per open position, over whole blocks.

    A block enters as its profile: how many candidates share a (birth, death) year pair and the
    smallest of their ids. The penalty classes of the unsupported candidates follow from it exactly
    (:func:`penalty_classes`). Classes never tie with supported scores, so the smallest id of a
    class is the right one.
    """
    born = years.select("entity", "birth_year", "death_year")
    blocks = plain_index(index).join(born.select(F.col("entity").alias("candidate"), F.col("birth_year").alias("cb"), F.col("death_year").alias("cd")), "candidate", "left")
    profile = checkpointed(blocks.groupBy("name", "cb", "cd").agg(F.count(F.lit(1)).alias("n"), F.min("candidate").alias("first")))
    contexts = open_pos.select(*CONTEXT).distinct()
    limits = checkpointed(_with_limits(contexts, born))
    kinds = penalty_classes(limits, profile)
    steps = (0, -4, -8)
    null_safe = [F.col(f"l.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("name", "prev_death", "next_birth")]
    base = limits.alias("l").join(kinds.alias("k"), null_safe).select(
        *[f"l.{c}" for c in CONTEXT], *[f"k.n{-s}" for s in steps], *[f"k.first{-s}" for s in steps])
    held = candidates.groupBy(*CONTEXT).agg(*[F.sum((F.col("penalty") == s).cast("int")).alias(f"held{-s}") for s in steps])
    best = best_two(candidates, CONTEXT, "total_score", [])
    both = [F.col(f"b.{c}").eqNullSafe(F.col(f"h.{c}")) for c in CONTEXT]
    supported = best.alias("b").join(held.alias("h"), both).select("b.*", *[f"h.held{-s}" for s in steps])
    joined = base.alias("a").join(supported.alias("s"), [F.col(f"a.{c}").eqNullSafe(F.col(f"s.{c}")) for c in CONTEXT], "left")
    score = F.least(F.lit(3.0), 0.5 + 0.5 * F.size(F.split("a.name", " ")))
    rest = [F.col(f"a.n{-s}") - F.coalesce(F.col(f"s.held{-s}"), F.lit(0)) for s in steps]
    ranked = F.array(
        F.struct(F.col("s.total_score").alias("score"), F.col("s.candidate").alias("id")),
        F.struct(F.col("s.runner_up").alias("score"), F.col("s.candidate").alias("id")),
        *[F.struct(F.when(r > k, score + s).alias("score"), F.col(f"a.first{-s}").alias("id")) for s, r in zip(steps, rest) for k in (0, 1)])
    ranked = F.array_sort(F.filter(ranked, lambda x: x["score"].isNotNull()),
                          lambda x, y: F.when(x["score"] > y["score"], -1).when(x["score"] < y["score"], 1).otherwise(0))
    summary = joined.select(
        *[F.col(f"a.{c}").alias(c) for c in CONTEXT], (F.col("a.n0") + F.col("a.n4") + F.col("a.n8")).alias("candidate_count"),
        ranked.alias("ranked"))
    summary = summary.select(
        *CONTEXT, "candidate_count", F.get("ranked", F.lit(0))["id"].alias("top_entity"),
        F.get("ranked", F.lit(0))["score"].alias("top_score"), F.get("ranked", F.lit(1))["score"].alias("runner_up_score"))
    out = open_pos.alias("o").join(summary.alias("m"), [F.col(f"o.{c}").eqNullSafe(F.col(f"m.{c}")) for c in CONTEXT]).select(
        "o.*", "m.candidate_count", "m.top_entity", "m.top_score", "m.runner_up_score")
    return recommend(out)


def recommend(summary: DataFrame) -> DataFrame:
    """Margin rules over (candidate_count, top_score, runner_up_score)."""
    top, run = F.col("top_score"), F.col("runner_up_score")
    ahead = run.isNull() | (top > run)
    status = (F.when((F.col("candidate_count") == 1) & (top >= 5), "unique_candidate_high")
              .when((top >= 6) & (run.isNull() | (top >= run + 2)), "unique_top_strong")
              .when((top >= 4) & ahead, "unique_top_review").otherwise("ambiguous"))
    unique = (F.col("candidate_count") == 1) | (run.isNotNull() & (top > run))
    return summary.withColumn("top_is_unique", unique.cast("int")).withColumn("recommendation", status)


# -- R-07, R-08: unique alias or prefix plus one relation -----------------------------------

def resolve_with_support(open_pos: DataFrame, unique: DataFrame, relations: DataFrame, two_sided: str, one_sided: str) -> DataFrame:
    """Names that point to one entity and have a neighbour relation; 6 two-sided, 5 one-sided.

    ``unique``: name, entity.
    """
    rel = relations.select("student", "teacher").distinct()
    rows = open_pos.join(unique.select("name", "entity"), "name")
    rows = rows.join(rel.select(F.col("student").alias("prev"), F.col("teacher").alias("entity"), F.lit(1).alias("p")), ["prev", "entity"], "left")
    rows = rows.join(rel.select(F.col("student").alias("entity"), F.col("teacher").alias("next"), F.lit(1).alias("x")), ["entity", "next"], "left")
    rows = rows.withColumn("support", F.coalesce("p", F.lit(0)) + F.coalesce("x", F.lit(0))).filter("support >= 1")
    return rows.select(
        *POSITION, "occurrence_id", *CONTEXT, "entity", F.coalesce("p", F.lit(0)).alias("prev_relation"),
        F.coalesce("x", F.lit(0)).alias("next_relation"), "support",
        F.when(F.col("support") == 2, two_sided).otherwise(one_sided).alias("status"),
        F.when(F.col("support") == 2, 6).otherwise(5).alias("score"))


# -- R-09, R-10: source cards --------------------------------------------------------------

def source_card_candidates(open_pos: DataFrame, index: DataFrame, prev_edges: DataFrame, next_edges: DataFrame) -> DataFrame:
    """Cards of the alias with support from a side: 2 + 3 previous in students + 3 next in teachers.

    Cards with the alias alone score 2 and can never win; their number is in the block sizes.
    """
    contexts = open_pos.filter(F.col("prev").isNotNull() | F.col("next").isNotNull()).select(*CONTEXT).distinct()
    rows = supported_candidates(contexts, index, prev_edges, next_edges)
    prev_in = (F.col("prev_weight") > 0).cast("int")
    next_in = (F.col("next_weight") > 0).cast("int")
    return rows.select(
        *CONTEXT, "candidate", prev_in.alias("prev_in_students"), next_in.alias("next_in_teachers"),
        (2 + 3 * prev_in + 3 * next_in).alias("score"),
        F.when(prev_in + next_in == 2, "two_sided").otherwise("one_sided").alias("status"))


def resolve_source_cards(open_pos: DataFrame, candidates: DataFrame) -> DataFrame:
    """The card with the highest score, if no other card reaches it."""
    best = best_two(candidates, CONTEXT, "score", ["prev_in_students", "next_in_teachers"])
    best = best.filter(F.col("runner_up").isNull() | (F.col("score") > F.col("runner_up")))
    return open_pos.alias("o").join(best.alias("b"), [F.col(f"o.{c}").eqNullSafe(F.col(f"b.{c}")) for c in CONTEXT]).select(
        "o.*", F.col("b.candidate").alias("entity"), "b.score", "b.prev_in_students", "b.next_in_teachers")


# -- R-14: signatures ----------------------------------------------------------------------

def propagate_signatures(neighbours: DataFrame, min_support: int = 2) -> DataFrame:
    """Give an unresolved (previous, raw name, next) the entity this signature always had.

    ``neighbours``: position columns, occurrence_id, name, entity, prev, next (both resolved).
    """
    full = neighbours.filter(F.col("prev").isNotNull() & F.col("next").isNotNull())
    known = full.filter(F.col("entity").isNotNull()).groupBy(*CONTEXT).agg(
        F.min("entity").alias("__a"), F.max("entity").alias("__b"), F.count(F.lit(1)).alias("support"))
    known = known.filter((F.col("__a") == F.col("__b")) & (F.col("support") >= min_support))
    known = known.select(*CONTEXT, F.col("__a").alias("propagated"), "support")
    return full.filter(F.col("entity").isNull()).drop("entity").join(known, CONTEXT).withColumnRenamed("propagated", "entity")


# -- R-15: precedence ------------------------------------------------------------------------

def precedence_union(layers: list[tuple[str, DataFrame]], key: str = "occurrence_id", keep=("entity", "score")) -> DataFrame:
    """One row per occurrence from the first layer (in the given order) that resolves it."""
    union = None
    for rank, (label, df) in enumerate(layers):
        rows = df.select(key, *keep, F.lit(label).alias("layer"), F.lit(rank).alias("__rank"))
        union = rows if union is None else union.unionByName(rows)
    picked = union.groupBy(key).agg(F.min_by(F.struct(*keep, "layer"), F.col("__rank")).alias("r"))
    return picked.select(key, *[f"r.{c}" for c in keep], "r.layer")
