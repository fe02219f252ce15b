"""Exact duplicates by Patricia tries: full byte strings are compared, terminal nodes hold the owner.

Texts are equal when their bytes are, after lower-casing A-Z. Each task first folds its own rows into a trie, so a
text leaves a task once however many copies it has; the rows are then dealt by (length, content hash) and folded
again. A trie over its budget hands out its largest subtree; such partial owners meet again by (length, SHA-256).
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from silsila.llm.common import cut, join_classes, map_rows, steps, texts_of, without

#: Bytes a trie may hold in one task.
TRIE_BYTES = 32_000_000
#: Rough size of a node besides its label.
NODE_BYTES = 400
_OUT_BYTES = 4_000_000


def normalised(text: str) -> bytes:
    """UTF-8 bytes with A-Z lower-cased; other characters stay as they are."""
    return text.encode("utf-8", "surrogatepass").lower()


class _Node:
    __slots__ = ("label", "children", "owner", "copies")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.copies = label, {}, None, 0


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``."""
    low, high = 0, min(len(a), len(b) - at)
    if b.startswith(a[:high], at):
        return high
    while low < high:
        mid = (low + high + 1) // 2
        if b.startswith(a[low:mid], at + low):
            low = mid
        else:
            high = mid - 1
    return low


class PatriciaTrie:
    """Compressed radix trie from byte strings to (owner id, number of copies).

    ``largest`` says which id owns a text: the largest (a null id loses to any other) or the smallest.
    """

    def __init__(self, largest: bool = True):
        self.root, self.size, self.largest = _Node(b""), 0, largest

    def insert(self, key: bytes, owner: int | None, copies: int = 1) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                leaf = _Node(key[at:])
                node.children[key[at]] = leaf
                self.size += len(leaf.label) + NODE_BYTES
                node = leaf
                break
            shared = _common(child.label, key, at)
            if shared < len(child.label):                      # split the edge
                upper = _Node(child.label[:shared])
                child.label = child.label[shared:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = upper
                self.size += NODE_BYTES
                child = upper
            node, at = child, at + shared
        if node.copies == 0 or node.owner is None or (
                owner is not None and (owner > node.owner if self.largest else owner < node.owner)):
            node.owner = owner if node.copies == 0 or owner is not None else node.owner
        node.copies += copies

    def _walk(self, node: _Node, prefix: bytes) -> Iterator[tuple[bytes, int | None, int]]:
        todo = [(node, prefix)]
        while todo:
            node, prefix = todo.pop()
            key = prefix + node.label
            if node.copies:
                yield key, node.owner, node.copies
            todo.extend((c, key) for c in node.children.values())

    def _weight(self, node: _Node) -> int:
        total, todo = 0, [node]
        while todo:
            node = todo.pop()
            total += len(node.label) + NODE_BYTES
            todo.extend(node.children.values())
        return total

    def items(self):
        return self._walk(self.root, b"")

    def spill(self) -> list[tuple[bytes, int | None, int]]:
        """Cut off the largest subtree below the first branch and return its texts."""
        node, prefix = self.root, b""
        while len(node.children) == 1 and not node.copies:
            (only,) = node.children.values()
            if not only.children:
                break
            prefix, node = prefix + node.label, only
        if not node.children:
            return []
        weight, first = max((self._weight(c), k) for k, c in node.children.items())
        out = list(self._walk(node.children.pop(first), prefix + node.label))
        self.size -= weight
        return out


def _fold(entries, largest: bool, limit: int, out) -> Iterator[pa.RecordBatch]:
    """Run (key, owner, copies) triples through a trie; ``out`` turns a list of triples into a batch."""
    trie = PatriciaTrie(largest)

    def chunks(items):
        some, size = [], 0
        for item in items:
            some.append(item)
            size += len(item[0]) + 64
            if size > _OUT_BYTES:
                yield out(some)
                some, size = [], 0
        if some:
            yield out(some)

    for key, owner, copies in entries:
        trie.insert(key, owner, copies)
        while trie.size > limit and (gone := trie.spill()):
            yield from chunks(gone)
    yield from chunks(trie.items())


def owners(docs: DataFrame, largest: bool = True, limit: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct text: n_bytes, digest (SHA-256), keep_id, group_size."""
    local = "n_bytes bigint, digest binary, content binary, owner bigint, copies bigint"
    schema = to_arrow_schema(StructType.fromDDL(local))

    def entries(batches):
        for batch in batches:
            for part in steps(batch):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts_of(part)):
                    yield normalised(text), doc_id, 1

    def with_content(some):
        return pa.RecordBatch.from_pydict({
            "n_bytes": [len(k) for k, _, _ in some], "digest": [hashlib.sha256(k).digest() for k, _, _ in some],
            "content": [k for k, _, _ in some], "owner": [o for _, o, _ in some], "copies": [c for _, _, c in some]},
            schema=schema)

    def again(batches):
        for batch in batches:
            for part in steps(batch, "content"):
                yield from zip(part.column("content").to_pylist(), part.column("owner").to_pylist(),
                               part.column("copies").to_pylist())

    def without_content(some):
        return pa.RecordBatch.from_pydict({
            "n_bytes": [len(k) for k, _, _ in some], "digest": [hashlib.sha256(k).digest() for k, _, _ in some],
            "owner": [o for _, o, _ in some], "copies": [c for _, _, c in some]}, schema=bare)

    partial = "n_bytes bigint, digest binary, owner bigint, copies bigint"
    bare = to_arrow_schema(StructType.fromDDL(partial))
    first = docs.select("doc_id", "text").mapInArrow(
        lambda batches: _fold(entries(batches), largest, limit, with_content), local)
    dealt = first.repartition("n_bytes", "digest").select("content", "owner", "copies")
    second = dealt.mapInArrow(lambda batches: _fold(again(batches), largest, limit, without_content), partial)
    best = F.max("owner") if largest else F.min("owner")
    return second.groupBy("n_bytes", "digest").agg(best.alias("keep_id"), F.sum("copies").alias("group_size"))


def exact_groups(docs: DataFrame, largest: bool = True, limit: int = TRIE_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (lowercase hex).

    Null text counts as empty. Rows that repeat a doc_id with the same text are copies of each other and share the
    verdict; a null doc_id owns a text only where no other id has it (all such rows are then kept). Empty input gives
    no rows; other columns are not read.
    """
    groups = cut(owners(docs, largest, limit).filter(F.col("group_size") > 1).drop("n_bytes"))

    def digests(batch):
        return {"doc_id": batch.column("doc_id"), "digest": [hashlib.sha256(normalised(t)).digest() for t in texts_of(batch)]}

    rows = map_rows(docs.select("doc_id", "text"), digests, "doc_id bigint, digest binary")
    return join_classes(rows, groups, "digest", "group_size").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def _content_mark():
    """``text_sha256`` of a row as an expression."""
    return F.sha2(F.translate(F.coalesce(F.col("text"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase).cast("binary"), 256)


def drop_copies(docs: DataFrame, one_row: bool = False) -> DataFrame:
    """Documents without the rows that ``exact_groups`` drops; columns unchanged.

    Rows that repeat a doc_id and its text share the verdict and stay together; with ``one_row`` only the least of them
    stays (by all columns in their order).
    """
    verdicts = cut(exact_groups(docs).filter("group_size > 1").select("doc_id", "kept", F.col("text_sha256").alias("mark")))
    left = without(docs, verdicts.filter(~F.col("kept")), _content_mark())
    repeated = verdicts.filter("kept").groupBy("doc_id", "mark").count().filter("count > 1")
    if not one_row or repeated.isEmpty():
        return left
    repeated = repeated.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__m"))
    marked = docs.withColumn("__mark", _content_mark())
    several = marked.join(repeated, marked["doc_id"].eqNullSafe(repeated["__id"]) & (marked["__mark"] == repeated["__m"]), "left_semi")
    least = several.groupBy("doc_id", "__mark").agg(F.min(F.struct(*[F.col(c) for c in docs.columns])).alias("__row"))
    others = without(left, repeated.select(F.col("__id").alias("doc_id"), F.col("__m").alias("mark")), _content_mark())
    return others.unionByName(least.select("__row.*"))
