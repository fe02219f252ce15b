"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Only the histogram of piece lengths (at most ``capacity`` numbers) is planned on the driver. The plan says for each
length which ranks go where, so bins are counted in runs and never listed; pieces find their run by an equi join on
(length, block of ranks).
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from silsila.llm.bpe import merge_table, merge_words
from silsila.llm.common import cut, map_rows, texts_of

CAPACITY = 4096
#: Ranks per join block of the plan, and pieces per block when ranks are given out.
RANKS, BLOCK_ROWS = 256, 20_000
#: Bytes by class for texts of plain letters: 0 white space, 1 letters, 2 digits, 3 other signs, 9 not plain.
_CLASS = np.full(256, 9, dtype=np.int8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[33:127] = 3
_CLASS[48:58] = 2
_CLASS[97:123] = 1
_CLASS[128:192] = 1                                  # continuation bytes, judged with their lead byte
_CLASS[[0xC3, 0xC4, 0xC5]] = 1                       # Latin letters with accents


class WordEncoder:
    """Byte-level BPE with word ends, as the tokenizer file says, for many texts at once.

    Texts of ASCII and accented Latin letters are cut into words by byte classes, and each distinct word is merged once.
    Other texts (also those with a special token) go through the library, each distinct blank-separated part once.
    """

    def __init__(self, spec: str, end_id: int):
        self.tokenizer, self.end_id = Tokenizer.from_str(spec), end_id
        model = json.loads(spec)["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.table = merge_table([vocabulary[a] for a, _ in merges], [vocabulary[b] for _, b in merges],
                                 [vocabulary[a + b] for a, b in merges], range(len(merges)))
        signs = byte_signs()
        self.inner = np.array([vocabulary[c] for c in signs], dtype=np.int32)
        self.last = np.array([vocabulary[c + suffix] for c in signs], dtype=np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text followed by the end id."""
        plain = [_is_plain(t) for t in texts]
        out: list = [None] * len(texts)
        for kind, encode in ((True, self._encode_plain), (False, self._encode_parts)):
            at = [i for i, p in enumerate(plain) if p == kind]
            for i, ids in zip(at, encode([texts[i] for i in at]) if at else ()):
                out[i] = ids
        return out

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        raw = [t.lower().encode() for t in texts]
        data = b" ".join(raw) + b" "
        signs = np.frombuffer(data, np.uint8)
        cls = _CLASS[signs]
        begins = np.ones(len(signs), dtype=bool)
        begins[1:] = (cls[1:] != cls[:-1]) | (cls[1:] == 2)
        quotes = np.flatnonzero((signs[:-1] == 39) & begins[:-1] & (cls[1:] == 1))
        for one, two in ((b"stmd", None), (b"r", b"e"), (b"v", b"e"), (b"l", b"l")):      # 's 't 'm 'd 're 've 'll
            at = quotes[np.isin(signs[quotes + 1], np.frombuffer(one, np.uint8))]
            if two:
                at = at[signs[np.minimum(at + 2, len(signs) - 1)] == two[0]]
            begins[at + 1] = False
            begins[at + (3 if two else 2)] = True
        start = np.flatnonzero(begins)
        words = pa.StringArray.from_buffers(len(start), pa.py_buffer(np.append(start, len(signs)).astype(np.int32)), pa.py_buffer(data))
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        size = np.diff(np.frombuffer(distinct.buffers()[1], np.int32)[:len(distinct) + 1]).astype(np.int64)
        flat = np.frombuffer(distinct.buffers()[2], np.uint8)[:int(size.sum())]
        blank = np.flatnonzero(_CLASS[flat[np.cumsum(size) - size]] == 0)               # white space is no word
        symbols = self.inner[flat]
        symbols[np.cumsum(size) - 1] = self.last[flat[np.cumsum(size) - 1]]
        symbols, size = merge_words(self.table, symbols, size)
        size_of = size.copy()
        size_of[blank] = 0
        before = np.cumsum(size) - size
        at = coded.indices.to_numpy(zero_copy_only=False)
        many = size_of[at]
        done = np.cumsum(many)
        ids = symbols[np.repeat(before[at] - (done - many), many) + np.arange(int(done[-1]))].astype("<u4")
        stops = np.cumsum([len(r) + 1 for r in raw])
        ends = done[np.searchsorted(start, stops, "left") - 1].tolist()
        end = np.array([self.end_id], dtype="<u4")
        return [np.concatenate([ids[a:b], end]) for a, b in zip([0, *ends[:-1]], ends)]

    def _encode_parts(self, texts: list[str]) -> list[np.ndarray]:
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        distinct = list(dict.fromkeys(p for some in parts for p in some))
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        ids = {}
        for low in range(0, len(distinct), 5000):
            some = distinct[low:low + 5000]
            ids.update((p, e.ids) for p, e in zip(some, encode(some, add_special_tokens=False)))
        return [np.array([i for p in some for i in ids[p]] + [self.end_id], dtype="<u4") for some in parts]


def byte_signs() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


_PLAIN = re.compile("[\\t-\\r -~À-ÖØ-öø-įı-ſ]*")


def _is_plain(text: str) -> bool:
    """White space, printable ASCII and accented Latin letters only (no dotted capital I), and no special token."""
    return "<|" not in text and _PLAIN.fullmatch(text) is not None


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a document's ids and the end id, cut every ``capacity`` ids.

    Null text counts as empty and gives the end id alone.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())       # a vocabulary file, 2 MB
    held = []

    def one(batch):
        if not held:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            held.append(WordEncoder(spec.value, end_id))
        out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), held[0].encode(texts_of(batch))):
            for p, start in enumerate(range(0, len(ids), capacity)):
                part = ids[start:start + capacity]
                for name, value in zip(out, (doc_id, p, start, len(part), zlib.crc32(part.tobytes()))):
                    out[name].append(value)
        return out

    return map_rows(docs.select("doc_id", "text"), one,
                    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def reduce_by_dominance(count: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Fix bins that dominate every alternative; returns ([(lengths of a bin, how many bins)], what is left).

    From the longest piece down, a bin of it is fixed alone when nothing fits beside it, with a partner that fills the bin
    exactly, and with the longest partner that fits when no two others fit, or when two at most fit and no two are longer
    than that partner (Martello and Toth 1990). Passes repeat until nothing can be fixed.
    """
    left = {s: c for s, c in count.items() if c}
    fixed: list[tuple[tuple[int, ...], int]] = []

    def take(lengths, bins):
        fixed.append((lengths, bins))
        for s in lengths:
            left[s] -= bins
            if not left[s]:
                del left[s]

    def smallest(n, without):
        """Sum of the n smallest pieces besides one of ``without``; None if there are not so many."""
        total = 0
        for s in sorted(left):
            have = min(left[s] - (s == without), n)
            total, n = total + s * have, n - have
            if n == 0:
                return total
        return None

    again = True
    while again:
        again = False
        for s in sorted(left, reverse=True):
            while s in left:
                room = capacity - s
                others = sorted(t for t in left if t <= room and (t != s or left[s] > 1))
                if not others:
                    take((s,), left[s])
                elif others[-1] == room:
                    take((s, room), left[s] // 2 if room == s else min(left[s], left[room]))
                else:
                    best, two, three = others[-1], smallest(2, s), smallest(3, s)
                    if two is None or two > room:
                        ok = True
                    elif three is None or three > room:
                        ok = best >= _best_pair(left, s, room)
                    else:
                        ok = False
                    if not ok:
                        break
                    # fewer pieces make the smallest sums larger and the best pair smaller, so the test holds for all these bins
                    take((s, best), left[s] // 2 if best == s else min(left[s], left[best]))
                again = True
    return fixed, left


def _best_pair(left: dict[int, int], s: int, room: int) -> int:
    """Largest sum of two pieces that fit beside s; 0 if none do."""
    sizes = sorted(t for t in left if t < room)
    have = {t: left[t] - (t == s) for t in sizes}
    best = 0
    for a in sizes:
        if not have[a]:
            continue
        i = bisect_left(sizes, room - a + 1) - 1
        while i >= 0 and (sizes[i] == a and have[a] < 2 or not have[sizes[i]]):
            i -= 1
        if i >= 0:
            best = max(best, a + sizes[i])
    return best


def plan_bins(count: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, first rank, end rank, first sequence, offset) and the number of sequences.

    Rank r of a length goes to sequence ``first sequence + r - first rank`` at ``offset``. Fixed bins come first, then
    best-fit decreasing over what is left, counted in runs of equal bins.
    """
    runs, rank, sequences = [], dict.fromkeys(count, 0), 0

    def put(length, bins, sequence, offset):
        runs.append((length, rank[length], rank[length] + bins, sequence, offset))
        rank[length] += bins

    fixed, left = reduce_by_dominance(count, capacity)
    for lengths, bins in fixed:
        offset = 0
        for s in lengths:
            put(s, bins, sequences, offset)
            offset += s
        sequences += bins
    room_of: dict[int, list[tuple[int, int]]] = {}               # room left -> runs of bins (first sequence, how many)
    rooms: list[int] = []

    def open_bins(room, first, bins):
        if room and bins:
            if room not in room_of:
                room_of[room] = []
                insort(rooms, room)
            room_of[room].append((first, bins))

    for s in sorted(left, reverse=True):
        todo = left[s]
        while todo:
            i = bisect_left(rooms, s)
            if i < len(rooms):                                   # the tightest bins with room for s
                room = rooms[i]
                first, bins = room_of[room].pop()
                if not room_of[room]:
                    del room_of[room], rooms[i]
                use = min(bins, todo)
                put(s, use, first, capacity - room)
                open_bins(room, first + use, bins - use)
                open_bins(room - s, first, use)
                todo -= use
            else:
                each = capacity // s
                bins, rest = divmod(todo, each)
                for bins, each in ((bins, each), (1, rest)):
                    if bins and each:
                        for k in range(each):
                            put(s, bins, sequences, k * s)
                        open_bins(capacity - each * s, sequences, bins)
                        sequences += bins
                todo = 0
    return runs, sequences


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows with ``doc_id, piece, start, length, ids_crc32``; lengths are 1 to ``capacity``.

    Pieces of one length are interchangeable, so ranks may be given out in any order: within (length, hash block), and
    blocks in turn. A length that a third of all pieces share is spread over all blocks.
    """
    spark = found.sparkSession
    found = cut(found)
    n = found.count()
    blocks = max(1, -(-n // BLOCK_ROWS))
    dealt = found.withColumn("__block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)))
    counts = cut(dealt.groupBy("length", "__block").agg(F.count("*").alias("__n")))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    runs, _ = plan_bins(histogram, capacity)
    table = pa.table({name: pa.array([r[i] for r in runs], pa.int64()) for i, name in enumerate(
        ("length", "__first", "__end", "__sequence", "offset"))})
    plan = spark.createDataFrame(table).withColumn("__run", F.explode(F.sequence(
        F.floor(F.col("__first") / RANKS), F.floor((F.col("__end") - 1) / RANKS))))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(
        Window.partitionBy("length").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    inside = Window.partitionBy("length", "__block").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("__place", F.row_number().over(inside)).join(before, ["length", "__block"])
    ranked = ranked.withColumn("__rank", F.col("__before") + F.col("__place") - 1).withColumn(
        "__run", F.floor(F.col("__rank") / RANKS))
    placed = ranked.join(plan, ["length", "__run"]).filter("__rank >= __first and __rank < __end")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("__sequence") + F.col("__rank") - F.col("__first")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document, with its sequence and place. Repeated rows are packed as often as they
    occur; empty input gives no rows; columns besides doc_id and text are not read."""
    return pack(pieces(docs, tokenizer_path, capacity), capacity)
