"""MinHash near-duplicates by tensored banding, links confirmed on whole shingle sets.

A text is hashed into ``COLLECTIONS`` small collections of ``WIDTH`` smallest hashes each. A table key is a pair of
collections, so 14 collections of three (42 hashes) make 91 tables of six hashes, which would need 546 hashes of their own.
Two sets at similarity 0.8 share at least two of the 14 collections in 0.9993 of all cases, more similar ones more often.

Equal sets are one node. A collection that only one node has can make no shared key, so keys are formed of shared
collections alone. Within a bucket every node meets the bucket's leader, in rounds with another leader each while rounds
find links; a bucket is through when what its leaders have not met lies in one component. The nodes of buckets that are
not through then are put into buckets by their rarest shingles instead: two sets at the threshold share one among the first
``n - ceil(0.8 n) + 1``. Leaders meet these in rounds too; what is left is joined by shingle, where a common one at places
p and q leaves at most ``min(n - p, m - q)`` further ones. That finds every link between them, so no bucket is capped and
the members of a component are never paired among themselves.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silsila.llm.common import cut, join_classes, map_rows, stage_table, texts_of
from silsila.llm.graph import components, look_up

SHINGLE = 4
LEAST, OF = 80, 100                     # links from 80 of 100 on
COLLECTIONS, WIDTH = 14, 3
#: A round of leaders follows while at least one in this many compared pairs was a link.
NEWS = 5
#: Members that one task compares with a leader before the leader is told to a further one.
STAR = 2000
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_CHUNK = 8192
_SEEDS = np.random.default_rng(20).integers(1, 2**63, COLLECTIONS * WIDTH, dtype=np.uint64)


def _mix(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    return (state ^ (state >> np.uint64(29))) * _P + value


class WordHashes(dict):
    """Hash of a word, remembered; forgets when there are very many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, 11)
        return found


def shingle_set(text: str, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text; fewer than four words are one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=n)
    k = min(SHINGLE, n)
    state = np.full(n - k + 1, k, dtype=np.uint64)
    for j in range(k):
        state = _mix(state, codes[j:n - k + 1 + j])
    return np.unique((state ^ (state >> np.uint64(31))) * _Q)


def collections(shingles: np.ndarray) -> list[int]:
    """One signed number per collection of smallest hashes; the number tells the collection too."""
    least = np.full(len(_SEEDS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for low in range(0, len(shingles), _CHUNK):
        y = (shingles[None, low:low + _CHUNK] ^ _SEEDS[:, None]) * _P
        y ^= y >> np.uint64(32)
        y *= _Q
        least = np.minimum(least, y.min(axis=1))
    state = np.arange(COLLECTIONS, dtype=np.uint64)
    for column in least.reshape(COLLECTIONS, WIDTH).T:
        state = _mix(state, column)
    return state.view(np.int64).tolist()


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, digest, collections, mark) per row: size and digest of the shingle set (null without words), and two
    hashes that tell the text."""
    hashes = WordHashes()

    def one(batch):
        sets = [shingle_set(t, hashes) for t in texts_of(batch)]
        return {"doc_id": batch.column("doc_id"), "n": [len(s) for s in sets],
                "digest": [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets],
                "collections": [collections(s) if len(s) else [] for s in sets], "m1": batch.column("m1"), "m2": batch.column("m2")}

    return map_rows(docs.select("doc_id", "text", *_marks()), one,
                    "doc_id bigint, n bigint, digest string, collections array<bigint>, m1 bigint, m2 bigint")


def _marks():
    return F.xxhash64("text").alias("m1"), F.xxhash64(F.lit("other"), F.col("text")).alias("m2")


def _table_keys(shared: DataFrame) -> DataFrame:
    """(key, node) for every pair of a node's shared collections."""
    def pairs(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                listed = part.column("cs")
                flat, size = listed.flatten().to_numpy().view(np.uint64), np.diff(listed.offsets.to_numpy())
                start, nodes = np.cumsum(size) - size, part.column("node").to_numpy()
                for i, j in combinations(range(COLLECTIONS), 2):
                    some = np.flatnonzero(size > j)
                    state = _mix(_mix(np.full(len(some), 91, dtype=np.uint64), flat[start[some] + i]), flat[start[some] + j])
                    if len(some):
                        yield pa.RecordBatch.from_pydict({"key": state.view(np.int64), "node": nodes[some]})

    return shared.mapInArrow(pairs, "key bigint, node bigint")


def buckets(nodes: DataFrame) -> DataFrame:
    """(key, node) of all table keys that several nodes have."""
    single = nodes.select("node", F.explode("collections").alias("c"))
    several = stage_table(single.groupBy("c").agg(F.count("*").alias("many")).filter("many > 1"), "tensored-collections")
    shared = join_classes(single, several, "c", "many", "inner")
    shared = shared.groupBy("node").agg(F.array_sort(F.collect_list("c")).alias("cs")).filter(F.size("cs") > 1)
    keys = stage_table(_table_keys(shared), "tensored-keys")
    several = stage_table(keys.groupBy("key").agg(F.count("*").alias("many")).filter("many > 1"), "tensored-shared")
    return stage_table(join_classes(keys, several, "key", "many", "inner").select("key", "node"), "tensored-buckets")


def node_texts(docs: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(node, n, text) of the nodes that are in a bucket, one text for each."""
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "n", "m1", "m2")
    once = docs.select(*_marks(), "text").groupBy("m1", "m2").agg(F.first("text").alias("text"))     # copies combine on the map side
    return stage_table(once.join(wanted, ["m1", "m2"]).select("node", "n", "text"), "tensored-texts")


def similar(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether two sorted sets are at the threshold."""
    n, m = len(one), len(two)
    if OF * min(n, m) < LEAST * max(n, m):
        return False
    small, large = (one, two) if n <= m else (two, one)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return OF * both >= LEAST * (n + m - both)


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (lead, node) whose whole shingle sets are at the threshold, as edges (a, b).

    Each node's text goes to its leader's task; a leader of more than ``STAR`` nodes is told to as many tasks as needed.
    """
    spread = stage_table(pairs.groupBy("lead").agg(F.ceil(F.count("*") / STAR).alias("tasks")), "tensored-spread")
    sized = join_classes(pairs, spread.select("lead", "tasks"), "lead", "tasks", "inner")
    members = sized.withColumn("task", F.pmod(F.xxhash64("node"), F.col("tasks"))).join(texts, "node").select(
        "lead", "task", F.col("node").alias("b"), "n", "text")
    leaders = spread.join(texts, spread["lead"] == texts["node"]).select(
        "lead", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"), F.lit(None).cast("long").alias("b"), "n", "text")
    rows = leaders.union(members).repartition("lead", "task").sortWithinPartitions("lead", "task", F.col("b").asc_nulls_first())

    def compare(batches):
        hashes, lead, held, size = WordHashes(), None, None, 0
        for batch in batches:
            a, b = [], []
            for of, node, n, text in zip(*(batch.column(c).to_pylist() for c in ("lead", "b", "n")), batch.column("text")):
                if node is None:
                    lead, held, size = of, shingle_set(text.as_py(), hashes), n
                elif OF * min(n, size) >= LEAST * max(n, size) and similar(held, shingle_set(text.as_py(), hashes)):
                    a.append(lead)
                    b.append(node)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.mapInArrow(compare, "a bigint, b bigint")


def _placed(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots.select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))


def meet_leaders(members: DataFrame, texts: DataFrame, turn: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round over the buckets (key, node, root): (members still to be met, links found, pairs compared).

    In every round the nodes have an order of their own; the first of a bucket leads it and meets the members of other
    components. Still to be met are all but the leaders, in buckets where these lie in several components.
    """
    first = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("place"), "node", "root")).alias("l")
    lead = stage_table(members.groupBy("key").agg(first, F.count("*").alias("many")).select(
        "key", F.col("l.node").alias("lead"), F.col("l.root").alias("of"), "many"), "tensored-leaders")
    met = stage_table(join_classes(members, lead, "key", "many", "inner").filter("node <> lead").drop("many"), "tensored-met")
    pairs = stage_table(met.filter("root <> of").select("lead", "node", "of", "root").distinct(), "tensored-pairs")
    found = stage_table(confirm(pairs.select("lead", "node"), texts), "tensored-links")
    merged = components(found.join(pairs, (pairs["lead"] == found["a"]) & (pairs["node"] == found["b"])).select(
        F.col("of").alias("a"), F.col("root").alias("b")))
    step = merged.select(F.col("node").alias("root"), F.col("root").alias("to"))
    rest = stage_table(look_up(met.select("key", "node", "root"), step, "root").select("key", "node", F.coalesce("to", "root").alias("root")),
                       "tensored-rest")
    mixed = stage_table(rest.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("many")).filter(
        "low <> high").select("key", "many"), "tensored-mixed")
    return stage_table(join_classes(rest, mixed, "key", "many", "inner").select("key", "node", "root"), "tensored-open"), found, pairs


def rare_places(texts: DataFrame, roots: DataFrame) -> DataFrame:
    """(token, node, n, root, place): the rarest shingles of each set that others have too, with their places in the order
    of the set from rare to frequent, as far as two sets at the threshold must share one."""
    hashes = WordHashes()

    def shingles(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                found = shingle_set(batch.column("text")[i].as_py(), hashes).view(np.int64)
                yield pa.RecordBatch.from_pydict({"token": found, "node": np.full(len(found), batch.column("node")[i].as_py())})

    tokens = texts.select("node", "text").mapInArrow(shingles, "token bigint, node bigint")
    often = stage_table(tokens.groupBy("token").agg(F.count("*").alias("often")).filter("often > 1"), "tensored-often")
    shared = join_classes(tokens, often, "token", "often", "inner")
    sets = shared.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("ts")).join(texts.select("node", "n"), "node")
    sets = _placed(sets, roots)
    alone = F.col("n") - F.size("ts")                                    # shingles that no other text has come first
    within = F.col("n") - F.ceil(F.col("n") * LEAST / OF) + 1 - alone
    first = sets.select("node", "n", "root", alone.alias("alone"), F.slice("ts", F.lit(1), F.greatest(within, F.lit(0)).cast("int")).alias("ts"))
    return stage_table(first.select("node", "n", "root", "alone", F.posexplode("ts").alias("i", "t")).select(
        F.col("t.token").alias("token"), "node", "n", "root", (F.col("alone") + F.col("i")).alias("place")), "tensored-places")


def rare_first_pairs(places: DataFrame) -> DataFrame:
    """(lead, node): all pairs of different components that may be at the threshold, by their rarest shingles.

    Of a shingle's group the rows outside the group's largest component meet the whole group, so the members of one
    component are never paired among themselves.
    """
    of_root = places.groupBy("token", "root").agg(F.count("*").alias("many"))
    groups = of_root.groupBy("token").agg(F.max(F.struct("many", "root")).alias("most"), F.sum("many").alias("many"), F.count("*").alias("roots"))
    mixed = stage_table(groups.filter("roots > 1"), "tensored-groups")
    mixed = stage_table(join_classes(places, mixed, "token", "many", "inner").drop("roots"), "tensored-mixed")
    outer = mixed.filter("root <> most.root").select("token", *[F.col(c).alias(f"{c}_a") for c in ("node", "n", "root", "place")])
    left = F.least(F.col("n") - F.col("place"), F.col("n_a") - F.col("place_a"))          # at most this many in common
    met = outer.join(mixed.select("token", "node", "n", "root", "place"), "token").filter(
        (F.col("root") != F.col("root_a")) & (OF * F.least("n", "n_a") >= LEAST * F.greatest("n", "n_a"))
        & ((OF + LEAST) * left >= LEAST * (F.col("n") + F.col("n_a"))))
    return met.select(F.least("node", "node_a").alias("lead"), F.greatest("node", "node_a").alias("node")).distinct()


def _rounds(members: DataFrame, texts: DataFrame, links: list[DataFrame], turn: int) -> DataFrame:
    """Rounds of leaders while they find links; adds to ``links`` and returns the members still to be met."""
    while not members.isEmpty():
        members, found, pairs = meet_leaders(members, texts, turn + len(links))
        links.append(found)
        if found.count() * NEWS < pairs.count():
            break
    return members


def node_components(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root) for the nodes that are linked to others."""
    members, links = buckets(nodes), []
    texts = node_texts(docs, nodes, members)
    members = _rounds(members.withColumn("root", F.col("node")), texts, links, 0)
    if not links:
        return nodes.select("node", F.col("node").alias("root")).limit(0)
    if not members.isEmpty():
        rest = texts.join(members.select("node").distinct(), "node", "left_semi")
        places = rare_places(rest, members.select("node", "root").distinct())
        members = _rounds(places.select(F.col("token").alias("key"), "node", "root"), texts, links, 1)
        left = members.withColumnRenamed("key", "token").join(places.drop("root"), ["token", "node"])
        if not members.isEmpty():
            pairs = stage_table(rare_first_pairs(left), "tensored-rare")
            links.append(stage_table(confirm(pairs, texts), "tensored-links"))
    return components(reduce(DataFrame.union, links))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row; component_id is the smallest doc_id reachable over links.

    Null and wordless texts have no shingles and stand alone; fewer than four words make one shingle. Links are confirmed
    on the sets of 64-bit shingle hashes of whole texts. Null ids take part but never name a component unless it has no
    other id. Repeated rows repeat; empty input gives no rows; very long texts are a step of their own; columns besides
    doc_id and text are not read.
    """
    rows = stage_table(sketches(docs), "tensored-rows")
    nodes = rows.filter("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("owner"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("collections").alias("collections"),
        F.min(F.struct("m1", "m2")).alias("mark")).select("digest", "owner", "copies", "n", "collections", "mark.m1", "mark.m2")
    nodes = stage_table(nodes.withColumn("node", F.monotonically_increasing_id()), "tensored-nodes")
    roots = node_components(docs, nodes)
    placed = _placed(nodes.select("node", "digest", "owner", "copies"), roots)
    named = stage_table(placed.groupBy("root").agg(F.min("owner").alias("name"), F.count("*").alias("many")), "tensored-names")
    placed = cut(join_classes(placed, named, "root", "many", "inner").select("digest", "name", "copies"))
    alone = rows.filter("digest is null").select("doc_id", "n", F.col("doc_id").alias("name"))
    linked = join_classes(rows.filter("digest is not null").select("doc_id", "n", "digest"), placed, "digest", "copies", "inner")
    return linked.select("doc_id", "n", "name").union(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("name").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("name")).alias("kept"))
