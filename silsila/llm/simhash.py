"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits, each a word of the perfect Golay code (23, 12, 7)
(the last padded with zeros). ``nearest`` is the index of the one codeword within three bits; ``near`` is that index
and, where the codeword is three bits away, the five indices of codewords four bits away. Two facts hold for words of
one segment (checked over all cosets in the tests): at one bit apart, the nearest of one is in the near list of the
other; at two bits apart, the near lists meet.

Pigeonhole for up to four differing bits over three segments: the two cleaner segments have (0|1, 0|1) errors, or
(0, 2). The first gives the keys (nearest i, near j) and (near i, nearest j) per pair of segments, the second the keys
(exact i, near i+1). Every pair within four bits shares a key, about 48 keys a fingerprint.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silsila.llm.common import cut, join_classes, map_rows, texts_of, without
from silsila.llm.graph import components

MOST_BITS = 4
SHINGLE = 4
SEED = 42
_G = 0xAE3                                     # generator polynomial of the Golay code
SEGMENTS = ((0, 23), (23, 23), (46, 18))       # (lowest bit, width)
#: Buckets up to this many fingerprints are compared directly, larger ones by balls (about the break-even point).
DIRECT = 1024
_BLOCK = 100_000


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= _G << (bit - 11)
    return word


def golay_tables():
    """(syndrome per byte position [3, 256], error patterns per syndrome [2048, 6], how many of them apply [2048])."""
    unit = [_remainder(1 << b) for b in range(24)]
    by_byte = np.zeros((3, 256), dtype=np.int64)
    for p in range(3):
        for v in range(256):
            for b in range(8):
                if v >> b & 1:
                    by_byte[p, v] ^= unit[8 * p + b]
    patterns, count = np.zeros((2048, 6), dtype=np.int64), np.zeros(2048, dtype=np.int64)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            s = 0
            for b in bits:
                s ^= unit[b]
            if weight < 4 or count[s] == 0 or np.bitwise_count(patterns[s, 0]) == 3:
                patterns[s, count[s]] = sum(1 << b for b in bits)
                count[s] += 1
    return by_byte, patterns, count


def near_codewords(words: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices [n, 6], the nearest first, and how many of the six apply."""
    by_byte, patterns, count = tables
    s = by_byte[0][words & 255] ^ by_byte[1][words >> 8 & 255] ^ by_byte[2][words >> 16 & 255]
    return (words[:, None] ^ patterns[s]) >> 11, count[s]


def golay_keys(prints: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray]:
    """(key, position of the fingerprint) rows; a fingerprint never has one key twice."""
    n = len(prints)
    unsigned = prints.view(np.uint64)
    words = [(unsigned >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
    near, many = zip(*(near_codewords(w, tables) for w in words))
    at = np.arange(n)
    keys, rows = [], []

    def add(kind, left, right, mask):
        keys.append(((kind << 40) | (left << 12) | right)[mask])
        rows.append(at[mask])

    for kind, (i, j) in enumerate(combinations(range(3), 2)):
        for c in range(6):
            add(kind, near[i][:, 0], near[j][:, c], many[j] > c)
        for c in range(1, 6):
            add(kind, near[i][:, c], near[j][:, 0], many[i] > c)
    for i in range(3):
        for c in range(6):
            add(3 + i, words[i], near[(i + 1) % 3][:, c], many[(i + 1) % 3] > c)
    return np.concatenate(keys), np.concatenate(rows)


def simhash(text: str) -> int:
    """64-bit fingerprint, signed: a bit is set where it is set in over half of the shingle hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) < SHINGLE:
        hashed = xxhash.xxh64_intdigest(flat, SEED)
        return hashed - (1 << 64) if hashed >> 63 else hashed
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    start = np.cumsum(size + 1) - size - 1
    begin, end = start[:len(words) - SHINGLE + 1].tolist(), (start + size)[SHINGLE - 1:].tolist()
    votes, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for low in range(0, len(begin), _BLOCK):
        h = np.array([digest(flat[a:b], SEED) for a, b in zip(begin[low:low + _BLOCK], end[low:low + _BLOCK])],
                     dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(begin), bitorder="little").view("<i8")[0])


def _text_mark():
    """SHA-256 of a row's text as an expression."""
    return F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, print) per row; null and wordless texts have print 0. The mark tells rows with one id apart."""
    return map_rows(docs.select("doc_id", "text", _text_mark().alias("mark")), lambda batch: {
        "doc_id": batch.column("doc_id"), "mark": batch.column("mark"), "print": [simhash(t) for t in texts_of(batch)]},
        "doc_id bigint, mark string, print bigint")


def _bits_apart(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))         # the count of a signed number ignores its sign


def _spanning(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges of the components of one bucket: breadth first, each visited print meets the unvisited ones."""
    a, b = [], []
    rest = prints
    while len(rest) > 1:
        root, todo, rest = rest[0], [rest[0]], rest[1:]
        while todo and len(rest):
            close = _bits_apart(rest, todo.pop()) <= MOST_BITS
            if close.any():
                found, rest = rest[close], rest[~close]
                todo.extend(found)
                a.append(np.full(len(found), root))
                b.append(found)
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _link_batches(batches, direct: int):
    """Rows (key, print) sorted by key, in; edges (a, b, wide=false) and members of large buckets (a, a, wide=true), out."""
    def emit(a, b, wide):
        return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
                                           "wide": pa.array(np.full(len(a), wide), pa.bool_())})

    def work(keys, prints):
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        size = np.diff(edge)
        small = int(min(size.max(initial=0), 8))
        for o in range(1, small):                            # buckets of up to eight: all pairs by shifts
            same = np.flatnonzero((keys[o:] == keys[:-o]))
            close = same[_bits_apart(prints[same + o], prints[same]) <= MOST_BITS]
            bucket = np.searchsorted(edge, close, "right") - 1
            close = close[size[bucket] <= 8]
            yield prints[close], prints[close + o]
        for k in np.flatnonzero((size > 8) & (size <= direct)):
            yield _spanning(prints[edge[k]:edge[k + 1]])

    held_key, held, wide = None, np.zeros(0, dtype=np.int64), False
    for batch in batches:
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        prints = batch.column("print").to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        if held_key is not None:
            if wide and keys[0] == held_key:                 # a large bucket goes on: pass its members through
                n = int(np.searchsorted(keys, held_key, "right"))
                yield emit(prints[:n], prints[:n], True)
                keys, prints = keys[n:], prints[n:]
                if not len(keys):
                    continue
            elif not wide:
                keys = np.concatenate([np.full(len(held), held_key), keys])
                prints = np.concatenate([held, prints])
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        last = int(edge[-2])                                 # the last bucket may go on in the next batch
        for k in np.flatnonzero(np.diff(edge)[:-1] > direct):
            part = prints[edge[k]:edge[k + 1]]
            yield emit(part, part, True)
        done = list(work(keys[:last], prints[:last])) if last else []
        if done:
            yield emit(np.concatenate([x for x, _ in done]), np.concatenate([y for _, y in done]), False)
        held_key, held, wide = keys[-1], prints[last:], False
        if len(held) > direct:
            yield emit(held, held, True)
            held, wide = held[:0], True
    if len(held) > 1:
        done = list(work(np.full(len(held), held_key), held))
        if done:
            yield emit(np.concatenate([x for x, _ in done]), np.concatenate([y for _, y in done]), False)


def _balls(prints: DataFrame) -> DataFrame:
    """Edges among prints of large buckets: two prints are within four bits exactly if balls of radius two meet.

    A point belongs to at most 2,081 balls, so no group is large whatever the bucket was.
    """
    one = np.array([1 << b if b < 63 else -(1 << 63) for b in range(64)], dtype=np.int64)
    ball = np.concatenate([[0], one, [x ^ y for x, y in combinations(one, 2)]]).astype(np.int64)

    def around(batches):
        for batch in batches:
            p = batch.column("print").to_numpy(zero_copy_only=False)
            for low in range(0, len(p), 64):
                part = p[low:low + 64]
                yield pa.RecordBatch.from_pydict({"point": (part[:, None] ^ ball[None, :]).ravel(),
                                                  "print": np.repeat(part, len(ball))})

    points = prints.mapInArrow(around, "point bigint, print bigint")
    shared = points.groupBy("point").agg(F.collect_set("print").alias("p")).filter(F.size("p") > 1)
    return shared.select(F.array_min("p").alias("a"), F.explode("p").alias("b")).filter("a <> b").distinct()


def links(prints: DataFrame, direct: int = DIRECT) -> DataFrame:
    """Edges (a, b) between distinct prints (column ``print``) that span the components at four bits or fewer."""
    tables = golay_tables()

    def keyed(batches):
        for batch in batches:
            p = batch.column("print").to_numpy(zero_copy_only=False)
            for low in range(0, len(p), 20_000):
                part = np.ascontiguousarray(p[low:low + 20_000])
                keys, rows = golay_keys(part, tables)
                yield pa.RecordBatch.from_pydict({"key": keys, "print": part[rows]})

    rows = prints.mapInArrow(keyed, "key bigint, print bigint").repartition("key").sortWithinPartitions("key")
    found = cut(rows.mapInArrow(lambda b: _link_batches(b, direct), "a bigint, b bigint, wide boolean").distinct())
    return found.filter(~F.col("wide")).select("a", "b").union(
        _balls(found.filter("wide").select(F.col("a").alias("print")).distinct()))


def _members(docs: DataFrame, direct: int) -> DataFrame:
    """(doc_id, mark, print, copies, owner) per row; owner is the (unknown, doc_id, mark) that comes first in the row's
    component, ids before null, null for a row alone."""
    rows = cut(fingerprints(docs))
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "mark")
    classes = rows.groupBy("print").agg(F.min(first).alias("first"), F.count("*").alias("copies"))
    roots = components(links(classes.select("print"), direct))
    placed = classes.join(roots.select(F.col("node").alias("print"), "root"), "print", "left").filter(
        F.col("root").isNotNull() | (F.col("copies") > 1)).withColumn("root", F.coalesce("root", "print"))
    placed = cut(placed)
    named = placed.groupBy("root").agg(F.min("first").alias("owner"))
    known = placed.join(named, "root").select("print", "owner", "copies")
    return join_classes(rows, known, "print", "copies").select("doc_id", "mark", "print", "copies", "owner")


def near_duplicates(docs: DataFrame, direct: int = DIRECT) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row; component_id is the smallest doc_id reachable.

    Texts with one fingerprint meet before any search, so copies cost nothing there. Null and wordless texts have
    fingerprint zero and link like others; fewer than four words make one shingle. Null ids take part but never name a
    component unless it has no other id. Repeated rows repeat; empty input gives no rows; other columns are not read.
    """
    return _members(docs, direct).select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("owner.doc_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component stays, the one with the smallest id; columns unchanged.

    Of different texts with that id the one with the smallest SHA-256 stays. Rows that repeat an id and its text are one
    document.
    """
    stays = F.col("doc_id").eqNullSafe(F.col("owner.doc_id")) & (F.col("mark") == F.col("owner.mark"))
    return without(docs, _members(docs, DIRECT).filter(F.col("copies").isNotNull() & ~stays), _text_mark())
