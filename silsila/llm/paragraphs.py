"""Substring dedup: paragraphs are found by MinHash banding, verified by exact Jaccard and clustered by components.

Units are the lines of a text and the sentences inside them, as runs of lower-cased words. Units of ``BANDED_WORDS``
words are banded; the shingle sets of shorter ones meet by their smallest hashes, which misses no pair at the threshold.
Equal units meet before any of these keys is compared.

What units can not see is found by runs of words over the whole text, whatever its lines: seeds are the runs of
``SEED_WORDS`` words whose hash is the least of ``SEED_WINDOW`` in a row, so two texts that share 20 words share a seed,
and what they share ends at most eight words beyond the last one. Where the repeated seeds of a text end, the last one is
extended by what the text shares there with the owner of the seed, over gaps of ``GAP_WORDS`` words and in runs of
``UNIT_WORDS`` words or more. Seeds inside a unit that goes already are left out. Per document, matched units and extended seeds next to each other join to passages, and passages
of at least ``PASSAGE_WORDS`` words are reported: the first one of a cluster is kept, the others go.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silsila.llm.common import cut, join_classes, map_rows, stage_table, steps, texts_of
from silsila.llm.graph import components

SHINGLE = 5
SIMILARITY = 0.8
#: Nine bands of three: a pair at the threshold collides in one of them with probability 0.998.
BANDS, ROWS = 9, 3
BANDED_WORDS, UNIT_WORDS, PASSAGE_WORDS, GAP_WORDS = 20, 8, 25, 8
#: Buckets up to this many units are searched in one go, larger ones through leaders first and then in parts.
EXACT_BUCKET = 20_000
#: Two texts that share SEED_WORDS + SEED_WINDOW - 1 words share a seed. What else a match holds beyond its last seed is
#: up to SIDE words away: the rest of its run, a gap, and a run that is too short to have a seed. These words are told by
#: 16 bits each, so one end in 2 ** 16 is a word too far.
SEED_WORDS, SEED_WINDOW, SIDE = 12, 9, 36
#: Bits of the filter of keys that are looked for. It spares rows; an exact join follows, so it changes no result.
FILTER_BITS = 27
_CHUNK_BITS = 18
#: Text per step where whole texts are hashed: the arrays of a step take some forty times its size.
STEP = 2_000_000
#: Numbers that a task gathers before it deals them out, and that one dealt piece holds at most.
PACK_ROWS, PIECE_ROWS = 1_000_000, 256


#: Words of up to this many bytes are hashed as arrays of eight bytes at a time, longer ones one by one.
ARRAY_BYTES = 64
#: White space below 128, as ``str.split`` has it, and the bytes that end a sentence.
_BLANK, _END = (np.isin(np.arange(256), np.frombuffer(of, dtype=np.uint8)) for of in (b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ", b".!?"))
#: The other white space of ``str.split``.
_FAR_BLANK = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class _WordHash(dict):
    """Hash per long word."""

    def __missing__(self, word):
        if len(self) > 10_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Words(NamedTuple):
    """Word hashes of all texts of a step in a row, words per text, words per line."""
    flat: np.ndarray
    size: np.ndarray
    lines: np.ndarray

    def left(self) -> np.ndarray:
        """Per word how many the text has from there on."""
        return np.repeat(np.cumsum(self.size), self.size) - np.arange(len(self.flat))

    def bounds(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, its first word, its end) of every place."""
        stop = np.cumsum(self.size)
        of = np.searchsorted(stop, places, "right")
        return of, (stop - self.size)[of], stop[of]


def _bytes(text: str) -> bytes:
    """A lower-cased text in UTF-8, its white space in ASCII."""
    text = text.lower()
    return text.encode() if text.isascii() else _FAR_BLANK.sub(" ", text).encode("utf-8", "surrogatepass")


def word_hashes(data: bytes, first: np.ndarray, end: np.ndarray, known: _WordHash) -> np.ndarray:
    """A hash for the bytes of each word; its lowest bit tells whether the word ends a sentence. ``data`` has eight bytes
    more than the words."""
    eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))       # from every byte on
    size = end - first
    masks = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
    h, at, rest, of = size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), first, size, slice(None)
    for _ in range(0, ARRAY_BYTES, 8):
        part = (h[of] ^ eight[at] & masks[np.minimum(rest, 8)]) * np.uint64(0x9E3779B97F4A7C15)
        part ^= part >> np.uint64(32)
        part *= np.uint64(0xBF58476D1CE4E5B9)
        part ^= part >> np.uint64(29)
        h[of] = part
        more = np.flatnonzero(rest > 8)
        if not len(more):
            break
        of = more if isinstance(of, slice) else of[more]
        at, rest = at[more] + 8, rest[more] - 8
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    for i in np.flatnonzero(size > ARRAY_BYTES).tolist():
        h[i] = known[data[first[i]:end[i]]]
    return h & ~np.uint64(1) | _END[np.frombuffer(data, dtype=np.uint8)[end - 1]]


def scan(texts: list[str], known: _WordHash) -> Words:
    rows = [_bytes(t) for t in texts]
    data = b"".join(x for row in rows for x in (row, b"\n")) + bytes(8)
    letters = np.frombuffer(data, dtype=np.uint8)
    blank = np.flatnonzero(_BLANK[letters])                                # words end here, the last one of a text too
    first = np.concatenate([np.zeros(1, dtype=np.int64), blank + 1])[:len(blank)]
    full = blank > first
    many = np.cumsum(full)
    lines = np.diff(many[letters[blank] == 10], prepend=0)
    stop = np.cumsum([len(row) + 1 for row in rows], dtype=np.int64) - 1
    size = np.diff(many[np.searchsorted(blank, stop)], prepend=0)
    return Words(word_hashes(data, first[full], blank[full], known), size, lines)


def unit_places(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(first word, end word) of the units of a step: lines, and the sentences inside them, of ``UNIT_WORDS`` words or more."""
    stop = np.cumsum(words.lines)
    start = stop - words.lines
    ends = (words.flat & np.uint64(1)).astype(bool)
    ends[stop[words.lines > 0] - 1] = True
    high = np.flatnonzero(ends) + 1
    low = np.concatenate([np.zeros(1, dtype=np.int64), high])[:len(high)]
    wide = high - low >= UNIT_WORDS
    low, high = low[wide], high[wide]
    line = words.lines >= UNIT_WORDS
    of = np.searchsorted(stop, low, "right")
    line[of[(start[of] == low) & (stop[of] == high)]] = False              # a line of one sentence is one unit
    return np.concatenate([start[line], low]), np.concatenate([stop[line], high])


_BASE = 0x9E3779B97F4A7C15


def span_ids(flat: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Ids of runs of words by their ends: differences of running sums over powers of an odd base."""
    n = len(flat)
    up = np.cumprod(np.full(n, _BASE, dtype=np.uint64))
    back = np.cumprod(np.concatenate([np.ones(1, dtype=np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)]))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(flat * up, dtype=np.uint64)])
    h = ((total[last] - total[first]) * back[first]) ^ (last - first).astype(np.uint64)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return (h * np.uint64(0x94D049BB133111EB)).view(np.int64)


def units(text: str):
    """(first word, end word, words) of the units of a text, words numbered over the whole text."""
    split = text.lower().split()
    for a, b in zip(*(x.tolist() for x in unit_places(scan([text], _WordHash())))):
        yield a, b, split[a:b]


def unit_id(words: list[str]) -> int:
    flat = scan([" ".join(words)], _WordHash()).flat
    return int(span_ids(flat, np.zeros(1, dtype=np.int64), np.array([len(flat)]))[0])


#: A text is told by its id and its digest: an id may have several texts, and many texts may have none.
TEXT = ("doc_id", "digest")


def runs(flat: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, put together from runs of 1, 2, 4, ... words."""
    many = max(len(flat) - n + 1, 0)
    h, done, wide, part = np.full(many, n, dtype=np.uint64), 0, 1, flat
    while wide <= n:
        if n & wide:
            h = (h ^ part[done:done + many]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            done += wide
        if wide * 2 <= n:
            part = (part[:-wide] * np.uint64(0xD6E8FEB86659FD93) ^ part[wide:]) * np.uint64(0x9E3779B97F4A7C15)
            part ^= part >> np.uint64(32)
        wide *= 2
    return h * np.uint64(0xBF58476D1CE4E5B9)


def _slide(x: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``n`` values in a row."""
    many, wide = len(x) - n + 1, 1
    while wide * 2 <= n:
        x, wide = pick(x[:-wide], x[wide:]), wide * 2
    return x[:many] if wide == n else pick(x[:many], x[n - wide:n - wide + many])


def seeds(flat: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the seeds of a step; ties are all taken."""
    h = runs(flat, SEED_WORDS)
    if len(h) < SEED_WINDOW:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    least = _slide(h, SEED_WINDOW, np.minimum)
    least[left[:len(least)] < SEED_WORDS + SEED_WINDOW - 1] = 0         # a window stays inside one text
    edge = np.zeros(SEED_WINDOW - 1, dtype=np.uint64)
    at = np.flatnonzero((_slide(np.concatenate([edge, least, edge]), SEED_WINDOW, np.maximum) == h) & (h > 0))
    return at, h[at].view(np.int64)


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """Bit set over the first ``FILTER_BITS`` bits of the keys, packed; 16 MB at any number of keys."""
    bit, chunk_bits, size = F.shiftrightunsigned(F.col(column), 64 - FILTER_BITS), min(_CHUNK_BITS, FILTER_BITS), 1 << FILTER_BITS - 3
    rows = keys.select(bit.alias("bit")).withColumn("chunk", F.shiftrightunsigned("bit", chunk_bits)).repartition("chunk")

    def pack(batches):
        chunks = {}
        for batch in batches:
            bits, of = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("bit", "chunk"))
            for c in np.unique(of):
                chunks.setdefault(int(c), np.zeros(1 << chunk_bits, dtype=bool))[bits[of == c] & ((1 << chunk_bits) - 1)] = True
        for c, flags in chunks.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([c], pa.int64()), "bits": [np.packbits(flags, bitorder="little").tobytes()]})

    out = np.zeros(size, dtype=np.uint8)
    for r in rows.mapInArrow(pack, "chunk bigint, bits binary").toLocalIterator():
        low = r.chunk << chunk_bits - 3
        out[low:low + len(r.bits)] = np.frombuffer(r.bits, dtype=np.uint8)
    return out


def passes(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which signed keys may be in the filter."""
    at = (keys.view(np.uint64) >> np.uint64(64 - (len(bits).bit_length() + 2))).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _twice(rows: np.ndarray) -> np.ndarray:
    """Sorted numbers, each at most twice."""
    rows = np.sort(rows, axis=0)
    return rows[np.concatenate([np.ones(2, dtype=bool), rows[2:, 0] != rows[:-2, 0]])[:len(rows)]]


def _once(rows: np.ndarray) -> np.ndarray:
    """Sorted pairs, each once."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    return rows[np.concatenate([np.ones(1, dtype=bool), (rows[1:] != rows[:-1]).any(axis=1)])[:len(rows)]]


def dealt(docs: DataFrame, of_step, width: int, sort, found, schema: str) -> DataFrame:
    """Rows of ``width`` 64-bit numbers met by the first of them: ``of_step`` gives those of a step of texts, ``sort``
    orders them and leaves out what is not needed twice, ``found`` makes the output from all that share leading bits.

    A task gathers ``PACK_ROWS`` rows, sorts them and gives them out as packed pieces of ``PIECE_ROWS`` rows or fewer, so
    Spark shuffles pieces, not numbers.
    """
    bits = (int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4).bit_length()

    def pieces(gathered):
        rows = sort(np.concatenate(gathered))
        bucket = (rows[:, 0] >> np.uint64(64 - bits)).astype(np.int64)
        start = np.flatnonzero(np.diff(bucket, prepend=-1))
        parts = -(-np.diff(start, append=len(rows)) // PIECE_ROWS)
        first = np.repeat(start, parts) + PIECE_ROWS * _spread(np.zeros(len(parts), dtype=np.int64), parts)
        ends = (np.append(first, len(rows)) * 8 * width).astype(np.int32)
        return pa.RecordBatch.from_pydict({"bucket": pa.array(bucket[first], pa.int64()), "piece": pa.Array.from_buffers(
            pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])})

    def give(batches):
        gathered, n = [], 0
        for batch in batches:
            for part in steps(batch, limit=STEP):
                gathered.append(of_step(part).reshape(-1, width))
                n += len(gathered[-1])
                if n >= PACK_ROWS:
                    yield pieces(gathered)
                    gathered, n = [], 0
        if n:
            yield pieces(gathered)

    def meet(batches):
        last, held = None, []
        for batch in batches:
            for bucket, piece in zip(batch.column("bucket").to_pylist(), batch.column("piece").to_pylist()):
                if bucket != last and held:
                    yield found(sort(np.frombuffer(b"".join(held), dtype=np.uint64).reshape(-1, width)))
                    held = []
                last = bucket
                held.append(piece)
        if held:
            yield found(sort(np.frombuffer(b"".join(held), dtype=np.uint64).reshape(-1, width)))

    return docs.select("text").mapInArrow(give, "bucket bigint, piece binary").repartition("bucket").sortWithinPartitions(
        "bucket").mapInArrow(meet, schema)


def repeated_keys(docs: DataFrame):
    """Broadcast filter of the ids of units and the seeds that occur twice or more."""
    known = _WordHash()

    def keys(batch):
        words = scan(texts_of(batch), known)
        return np.concatenate([span_ids(words.flat, *unit_places(words)), seeds(words.flat, words.left())[1]]).view(np.uint64)

    def found(rows):
        return pa.RecordBatch.from_pydict({"unit": np.unique(rows[1:][rows[1:] == rows[:-1]]).view(np.int64)})

    return docs.sparkSession.sparkContext.broadcast(key_filter(dealt(docs, keys, 1, _twice, found, "unit bigint"), "unit"))


PLACES = "unit bigint, doc_id bigint, digest bigint, first int, last int, seeds binary"


def places(docs: DataFrame, wanted) -> DataFrame:
    """Rows ``PLACES`` of the units and seeds that pass the filter ``wanted``: one per unit, and one per text with all its
    seeds as pairs (hash, first word) of 64-bit numbers."""
    known = _WordHash()

    def one(batch):
        words = scan(texts_of(batch), known)
        a, b = unit_places(words)
        ids = span_ids(words.flat, a, b)
        at, h = seeds(words.flat, words.left())
        keep, hit = passes(ids, wanted.value), passes(h, wanted.value)
        at, h = at[hit], h[hit]
        of, begin, _ = words.bounds(a[keep])
        text, start, _ = words.bounds(at)
        having, many = np.unique(text, return_counts=True)
        ends = (np.append(0, np.cumsum(many)) * 16).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(having), [None, pa.py_buffer(ends), pa.py_buffer(np.column_stack([h, at - start]))])
        of = pa.array(np.concatenate([of, having]), pa.int64())

        def column(values, kind):
            return pa.concat_arrays([pa.array(values, kind), pa.nulls(len(having), kind)])

        return {"unit": column(ids[keep], pa.int64()), **{c: batch.column(c).take(of) for c in TEXT},
                "first": column(a[keep] - begin, pa.int32()), "last": column(b[keep] - begin, pa.int32()),
                "seeds": pa.concat_arrays([pa.nulls(int(keep.sum()), pa.binary()), packed])}

    return map_rows(docs.select("doc_id", F.xxhash64("text").alias("digest"), "text"), one, PLACES, step=STEP)


def _beside(words: Words, first: np.ndarray, step: int) -> np.ndarray:
    """The ``SIDE`` words from places on, forwards or backwards, by 16 bits each; 0 beyond the text."""
    _, begin, end = words.bounds(first if step < 0 else first - 1)
    at = (first - 1 if step < 0 else first)[:, None] + step * np.arange(SIDE)
    inside = (at >= begin[:, None]) & (at < end[:, None])
    short = (words.flat >> np.uint64(48)).astype("<u2") | np.uint16(1)
    return np.where(inside, short[np.where(inside, at, 0)], np.uint16(0)) if len(first) else np.zeros((0, SIDE), dtype="<u2")


def sides(docs: DataFrame, wanted) -> DataFrame:
    """(unit, doc_id, digest, first, before, after) of the seeds that pass the filter ``wanted``."""
    known = _WordHash()

    def one(batch):
        words = scan(texts_of(batch), known)
        at, h = seeds(words.flat, words.left())
        hit = passes(h, wanted.value)
        at = at[hit]
        of, begin, _ = words.bounds(at)
        return {"unit": h[hit], **{c: batch.column(c).take(pa.array(of)) for c in TEXT}, "first": pa.array(at - begin, pa.int32()),
                "before": _binary(_beside(words, at, -1)), "after": _binary(_beside(words, at + SEED_WORDS, 1))}

    return map_rows(docs.select("doc_id", F.xxhash64("text").alias("digest"), "text"), one,
                    "unit bigint, doc_id bigint, digest bigint, first int, before binary, after binary", step=STEP)


def extension(mine: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far two texts go on alike, in words of either, from the words ``_beside`` of both [rows, SIDE].

    Alike are the words up to the first difference, and runs of ``UNIT_WORDS`` words or more that begin at most
    ``GAP_WORDS`` words of either text further on.
    """
    mine, other = np.ascontiguousarray(mine.T), np.ascontiguousarray(other.T)      # one row per distance
    there = mine > 0
    here = np.cumprod((mine == other) & there, axis=0, dtype=np.int8).sum(axis=0, dtype=np.int64)
    far, shifts = here.copy(), range(-GAP_WORDS, GAP_WORDS + 1)
    run = {d: np.zeros(mine.shape[1], dtype=np.int8) for d in shifts}
    for i in range(SIDE):
        for d in shifts:
            if not 0 <= i + d < SIDE:
                continue                                                   # a run of this shift ends here for good
            run[d] += 1
            run[d] *= (mine[i] == other[i + d]) & there[i]
            on = np.flatnonzero(run[d] >= UNIT_WORDS)
            begin = i + 1 - run[d][on]
            on = on[(begin <= here[on] + GAP_WORDS) & (begin + d <= far[on] + GAP_WORDS)]
            here[on] = np.maximum(here[on], i + 1)
            far[on] = np.maximum(far[on], i + 1 + d)
    return here, far


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix, without Python objects."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of ``_binary``."""
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:column.offset + len(column) + 1] if len(column) else [0, 0]
    return np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[ends[0]:ends[-1]].view("<u2").reshape(-1, SIDE)


def _extended(batches):
    """Rows with the words beside a seed and beside its owner to rows with the four lengths instead."""
    for batch in batches:
        (back, o_back), (on, o_on) = (extension(_matrix(batch.column(c)), _matrix(batch.column(f"o_{c}"))) for c in ("before", "after"))
        yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in (*TEXT, "first", "unit", "keep", "at", "known")}
                                         | {"back": back, "on": on, "o_back": o_back, "o_on": o_on})


def _open_seeds(batches):
    """Texts with their ``seeds`` and the ``spans`` of their units to the seeds outside removed units; ``known`` are those
    inside a unit. Places of all texts of a batch are on one line, text after text."""
    def reach(text, first, last, at):
        order = np.argsort(text << 32 | first, kind="stable")
        far = np.append(np.maximum.accumulate((text << 32 | last)[order]), -1)         # a text begins above the one before
        return far[np.searchsorted((text << 32 | first)[order], at, "right") - 1]

    for batch in batches:
        seeds_, spans = batch.column("seeds"), batch.column("spans")
        ends = np.frombuffer(seeds_.buffers()[1], dtype=np.int32)[seeds_.offset:seeds_.offset + len(seeds_) + 1].astype(np.int64)
        pairs = np.frombuffer(seeds_.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]].view(np.int64).reshape(-1, 2)
        of = np.repeat(np.arange(len(seeds_)), np.diff(ends) // 16)
        flat, many = spans.flatten(), pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
        text = np.repeat(np.arange(len(many)), many)
        first, last, removed = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("first", "last", "removed"))
        first, last, removed = first.astype(np.int64), last.astype(np.int64), removed.astype(bool)
        at, end = of << 32 | pairs[:, 1], of << 32 | pairs[:, 1] + SEED_WORDS
        keep = reach(text[removed], first[removed], last[removed], at) < end
        known = reach(text, first, last, at) >= end
        yield pa.RecordBatch.from_pydict({"unit": pairs[keep, 0], **{c: batch.column(c).take(pa.array(of[keep])) for c in TEXT},
                                          "first": pairs[keep, 1].astype(np.int32), "known": known[keep]})


def staged(df: DataFrame, name: str) -> DataFrame:
    """``stage_table``, after which the driver collects its garbage: the shuffle files of a finished step stay on the
    executors' disks until it does."""
    table = stage_table(df, name)
    df.sparkSession.sparkContext._jvm.System.gc()
    return table


def repeated_runs(docs: DataFrame, found: DataFrame, rows: DataFrame) -> DataFrame:
    """Repeated runs of words beside the verdicts ``rows`` on units, with the same columns, from the texts ``found`` with
    their seeds.

    A run inside a removed unit goes with it; a run that a matched unit repeats within its own text is left to it.
    """
    spans = rows.groupBy(*TEXT).agg(F.collect_set(F.struct("first", "last", "removed")).alias("spans")).alias("r")
    reach = found.alias("f").join(spans, F.col("f.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("f.digest") == F.col("r.digest")), "left")
    found = stage_table(reach.select("f.doc_id", "f.digest", "seeds", "spans").mapInArrow(
        _open_seeds, "unit bigint, doc_id bigint, digest bigint, first int, known boolean"), "seeds")
    classes = stage_table(found.groupBy("unit").agg(
        F.count("*").alias("copies"), F.min(F.struct(*TEXT, "first", "known")).alias("owner")).filter("copies > 1"), "seed_owners")
    text, place = F.struct("owner.doc_id", "owner.digest"), F.struct("owner.doc_id", "owner.digest", "owner.first")
    owns = F.struct(*TEXT, "first").eqNullSafe(place)
    matched = staged(join_classes(found, classes.hint("shuffle_hash"), "unit", "copies", "inner").filter(
        owns | ~(F.col("known") & F.struct(*TEXT).eqNullSafe(text))).select(
        *TEXT, "first", "unit", text.alias("keep"), F.col("owner.first").alias("at"), F.col("owner.known").alias("known"), owns.alias("owns")), "matched")
    ends = Window.partitionBy(*TEXT).orderBy("first")
    inner = (F.lag("first").over(ends) >= F.col("first") - SEED_WINDOW) & (F.lead("first").over(ends) <= F.col("first") + SEED_WINDOW)
    open_ = matched.withColumn("inner", F.coalesce(inner, F.lit(False))).filter(~F.col("inner")).select("unit").distinct()
    open_ = stage_table(open_, "open_seeds")
    wanted = docs.sparkSession.sparkContext.broadcast(key_filter(open_, "unit"))
    here = matched.join(open_.hint("shuffle_hash"), "unit", "left_semi").hint("shuffle_hash").alias("m")
    # dealt once by the keys of the join, which serves the distinct rows as well
    there = sides(docs, wanted).withColumn("no_id", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0).cast("long")))
    there = there.repartition("unit", "doc_id", "no_id", "digest", "first").distinct().alias("s")
    same = ((F.col("m.unit") == F.col("s.unit")) & (F.coalesce("m.doc_id", F.lit(0).cast("long")) == F.col("s.doc_id"))
            & (F.col("m.doc_id").isNull() == F.col("s.no_id"))
            & (F.col("m.digest") == F.col("s.digest")) & (F.col("m.first") == F.col("s.first")))
    beside = staged(here.join(there, same).select("m.*", "before", "after"), "sides")
    owners = stage_table(beside.filter("owns").select("unit", F.col("before").alias("o_before"), F.col("after").alias("o_after")).join(
        classes.select("unit", "copies"), "unit"), "owner_sides")
    longer = join_classes(beside.filter("not owns"), owners.hint("shuffle_hash"), "unit", "copies", "inner").drop("copies", "owns")
    order = [longer.schema[c] for c in (*TEXT, "first", "unit", "keep", "at", "known")]
    longer = staged(longer.mapInArrow(_extended, StructType(order).add("back", "long").add("on", "long").add(
        "o_back", "long").add("o_on", "long")), "longer")

    def rows_of(df, removed, back=F.lit(0), on=F.lit(0)):
        first = F.greatest(F.col("first") - back, F.lit(0))
        return df.select(*TEXT, first.cast("int").alias("first"), (F.col("first") + SEED_WORDS + on).cast("int").alias("last"),
                         F.col("unit").alias("cluster"), "keep", F.lit(removed).alias("removed"))

    wide = longer.filter(~F.col("known")).groupBy("unit", "keep", F.col("at").alias("first")).agg(
        F.max("o_back").alias("back"), F.max("o_on").alias("on")).select("unit", "keep", "keep.*", "first", "back", "on")
    return rows_of(matched.filter("not owns"), True).unionByName(rows_of(matched.filter("owns and not known"), False)).unionByName(
        rows_of(longer, True, F.col("back"), F.col("on"))).unionByName(rows_of(wide, False, F.col("back"), F.col("on")))


def _spread(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of runs of ``many`` places, one run after the other."""
    return np.repeat(first - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))


def _distinct(grams: np.ndarray, first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit << 40 | top 40 bits of the hash, sorted and distinct; how many per unit)."""
    order = np.sort(np.repeat(np.arange(len(many), dtype=np.uint64), many) << np.uint64(40) | grams[_spread(first, many)] >> np.uint64(24))
    order = order[np.concatenate([np.ones(min(len(order), 1), dtype=bool), order[1:] != order[:-1]])]
    return order, np.bincount((order >> np.uint64(40)).astype(np.int64), minlength=len(many))


def _sets(grams: np.ndarray, first: np.ndarray, many: np.ndarray) -> pa.Array:
    """The sorted distinct hashes of every unit as bytes."""
    of, h = np.repeat(np.arange(len(many)), many), grams[_spread(first, many)]
    h = h[np.lexsort((h, of))]
    fresh = np.concatenate([np.ones(1, dtype=bool), (h[1:] != h[:-1]) | (of[1:] != of[:-1])])[:len(h)]
    ends = np.append(0, np.cumsum(np.bincount(of[fresh], minlength=len(many)))) * 8
    return pa.Array.from_buffers(pa.binary(), len(many), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(h[fresh])])


def _units_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(id, first, end) of the distinct units of a step, and per unit of the step which of them it is, in the order of
    ``unit_places``."""
    a, b = unit_places(words)
    ids, at, which = np.unique(span_ids(words.flat, a, b), return_index=True, return_inverse=True)
    return ids, a[at], b[at], which


def band_keys(h: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Band keys [units, bands] of MinHash signatures."""
    rng = np.random.default_rng(2024)
    factor = rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
    start = np.cumsum(many) - many
    keys = np.zeros((len(many), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        key = np.full(len(many), b + 1, dtype=np.uint64)
        for r in range(b * ROWS, (b + 1) * ROWS):
            low = np.minimum.reduceat(h * factor[r] + shift[r], start) if len(many) else key
            key = (key ^ low) * np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(31)
        keys[:, b] = key
    return keys.view(np.int64)


def prefix_keys(order: np.ndarray, distinct: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, their units): the smallest hashes of each unit of up to ``most`` distinct shingles, from ``_distinct``.

    Two sets at the threshold share all but a fifth of either, so one of these is common to both.
    """
    of = (order >> np.uint64(40)).astype(np.int64)
    rank = np.arange(len(order)) - (np.cumsum(distinct) - distinct)[of]
    first = (distinct - np.ceil(SIMILARITY * distinct - 1e-9) + 1)[of]
    chosen = (rank < first) & (distinct <= most)[of]
    key = (order[chosen] & np.uint64((1 << 40) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    key ^= key >> np.uint64(31)
    return key.view(np.int64), of[chosen]


def bands(docs: DataFrame, repeated, gate: bool = True) -> DataFrame:
    """(key, unit) per key that two units or more share: bands of the long ones, smallest hashes of the short ones. The
    longest of the short ones that reach the threshold with a long one have both.

    A break (a changed, added or missing word, or a passage that moved) costs four shingles of either side or more, so
    texts of m different shingles at the threshold have m / 36 breaks at most and share a run of 16 shingles, which is 20
    words, from m = 18 on. A unit of that size without a repeated seed has no near copy and needs no bands. Units that
    repeat four words in a row are banded always, as the count of breaks does not hold for them; ``gate=False`` bands all.
    """
    known, least = _WordHash(), BANDED_WORDS - SHINGLE + 1
    run = SEED_WORDS + SEED_WINDOW - SHINGLE

    def one(batch):
        words = scan(texts_of(batch), known)
        ids, a, b, which = _units_of(words)
        grams, many = runs(words.flat, SHINGLE), b - a - SHINGLE + 1
        order, distinct = _distinct(grams, a, many)
        keys, of = prefix_keys(order, distinct, int((least - 1) / SIMILARITY + 1e-9))
        long = distinct >= least
        if gate:
            places, h = seeds(words.flat, words.left())
            hits = np.append(places[passes(h, repeated.value)], 1 << 60)
            low, high = unit_places(words)
            seeded = np.zeros(len(ids), dtype=bool)
            seeded[which[hits[np.searchsorted(hits, low)] + SEED_WORDS <= high]] = True
            open_ = np.flatnonzero(long & ~seeded & (distinct * 8 >= run * 9))
            four = _distinct(runs(words.flat, SHINGLE - 1), a[open_], many[open_] + 1)[1]
            long[open_[four == many[open_] + 1]] = False
        banded = band_keys(grams[_spread(a[long], many[long])], many[long])
        return np.column_stack([np.concatenate([banded.ravel(), keys]),
                                np.concatenate([np.repeat(ids[long], BANDS), ids[of]])]).view(np.uint64)

    def shared(rows):
        same = rows[1:, 0] == rows[:-1, 0]
        rows = rows[np.append(False, same) | np.append(same, False)].view(np.int64)
        return pa.RecordBatch.from_pydict({"key": rows[:, 0], "unit": rows[:, 1]})

    return dealt(docs, one, 2, _once, shared, "key bigint, unit bigint")


def shingle_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(unit, shingles) of the units that may be among ``members``: the sorted distinct shingle hashes as
    little-endian 64-bit numbers."""
    known, shared = _WordHash(), docs.sparkSession.sparkContext.broadcast(key_filter(members, "unit"))

    def one(batch):
        words = scan(texts_of(batch), known)
        ids, a, b, _ = _units_of(words)
        wanted = passes(ids, shared.value)
        return {"unit": ids[wanted], "shingles": _sets(runs(words.flat, SHINGLE), a[wanted], (b - a - SHINGLE + 1)[wanted])}

    return map_rows(docs.select("text"), one, "unit bigint, shingles binary", step=STEP)


def _similar(one: np.ndarray, flat: np.ndarray, size: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which of the sets laid out in ``flat`` have Jaccard similarity of the threshold or more with ``one``."""
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    shared = np.add.reduceat((one[at] == flat).astype(np.int64), start)
    return shared >= SIMILARITY * (len(one) + size - shared) - 1e-9


def spanning_links(ids: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Edges that span the components of one bucket: breadth first, each visited unit meets the unvisited ones."""
    out, rest = [], list(range(len(ids)))
    while len(rest) > 1:
        root, todo, rest = rest[0], [rest[0]], rest[1:]
        while todo and rest:
            size = np.array([len(sets[i]) for i in rest])
            close = _similar(sets[todo.pop()], np.concatenate([sets[i] for i in rest]), size, np.cumsum(size) - size)
            found = [i for i, c in zip(rest, close) if c]
            rest = [i for i, c in zip(rest, close) if not c]
            out += [(ids[root], ids[i]) for i in found]
            todo += found
    return out


def _search_buckets(batches, exact: int):
    """Rows (key, unit, shingles) sorted by key to edges. A bucket over ``exact`` units keeps only leaders in memory: each
    further unit is linked to every leader it is similar to, or becomes one. ``_split_links`` finds the rest."""
    def emit(edges):
        return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in edges], pa.int64()),
                                           "b": pa.array([b for _, b in edges], pa.int64())})

    key, ids, sets, leading, edges = None, [], [], False, []

    def close_bucket():
        return [] if leading else spanning_links(ids, sets)

    for batch in batches:
        for k, u, raw in zip(batch.column("key").to_pylist(), batch.column("unit").to_pylist(), batch.column("shingles").to_pylist()):
            if k != key:
                edges += close_bucket()
                key, ids, sets, leading = k, [], [], False
            one = np.frombuffer(raw, dtype="<u8")
            if leading:
                size = np.array([len(s) for s in sets])
                close = _similar(one, np.concatenate(sets), size, np.cumsum(size) - size)
                edges += [(ids[i], u) for i in np.flatnonzero(close)]
                if close.any():
                    continue
            ids.append(u)
            sets.append(one)
            if not leading and len(ids) > exact:
                own = spanning_links(ids, sets)
                edges += own
                led = {b for _, b in own}
                keep = [i for i, x in enumerate(ids) if x not in led]
                ids, sets, leading = [ids[i] for i in keep], [sets[i] for i in keep], True
            if len(edges) > 50_000:
                yield emit(edges)
                edges = []
    edges += close_bucket()
    if edges:
        yield emit(edges)


def prefix(one: np.ndarray) -> np.ndarray:
    """The smallest hashes of a sorted set, of which every set at the threshold or above has one among its own smallest."""
    return one[:len(one) - int(np.ceil(SIMILARITY * len(one) - 1e-9)) + 1]


def _split_links(full: DataFrame, marks: DataFrame, links: DataFrame, exact: int) -> DataFrame:
    """The edges that leaders can not see in the buckets of more than ``exact`` units, between components of ``links``.

    A bucket is cut by the prefixes of its sets, and only parts with units of two components or more are searched. A part
    that is still too large is cut into blocks, and every two blocks meet in a bucket of their own.
    """
    roots = components(links).select(F.col("node").alias("unit"), "root")
    wide = full.join(marks.filter(F.col("n") > exact).select("key"), "key", "left_semi").join(roots, "unit", "left").withColumn(
        "root", F.coalesce("root", "unit"))
    mixed = F.min("root") != F.max("root")
    open_ = wide.groupBy("key").agg(mixed.alias("mixed")).filter("mixed").select("key")
    wide = cut(wide.join(open_, "key", "left_semi"))

    def parts(batches):
        for batch in batches:
            sets = [prefix(np.frombuffer(raw, dtype="<u8")).view(np.int64) for raw in batch.column("shingles").to_pylist()]
            at = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key").take(at), "part": pa.array(np.concatenate(sets) if sets else [], pa.int64()),
                "unit": batch.column("unit").take(at), "root": batch.column("root").take(at)})

    rows = wide.select("key", "unit", "root", "shingles").mapInArrow(parts, "key bigint, part bigint, unit bigint, root bigint")
    found = rows.groupBy("key", "part").agg(mixed.alias("mixed"), F.count("*").alias("n")).filter("mixed").drop("mixed")
    rows = rows.drop("root").join(found, ["key", "part"])
    n = F.ceil(F.col("n") / exact)
    rows = rows.withColumn("blocks", n).withColumn("one", F.pmod(F.xxhash64("unit"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("key", "unit", F.xxhash64("key", "part", F.least("one", "other"), F.greatest("one", "other")).alias("meet"))
    rows = rows.join(wide.select("key", "unit", "shingles"), ["key", "unit"]).select(F.col("meet").alias("key"), "unit", "shingles")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(
        lambda b: _search_buckets(b, 1 << 62), "a bigint, b bigint")


def near_links(docs: DataFrame, exact: int = EXACT_BUCKET, repeated=None, gate: bool = True) -> DataFrame:
    """Verified edges (a, b) between units that differ; ``repeated`` as from ``repeated_keys``."""
    shared = cut(bands(docs, repeated or (repeated_keys(docs) if gate else None), gate))
    # buckets with the same members are searched once
    marks = shared.groupBy("key").agg(F.sum(F.xxhash64("unit").cast("decimal(38,0)")).alias("members"), F.count("*").alias("n"))
    chosen = marks.groupBy("members", "n").agg(F.min("key").alias("key")).select("key")
    members = cut(shared.join(chosen, "key"))
    sets = shingle_sets(docs, members).join(members.select("unit").distinct(), "unit", "left_semi").groupBy("unit").agg(
        F.first("shingles").alias("shingles"))
    full = members.join(sets, "unit").select("key", "unit", "shingles")
    links = full.repartition("key").sortWithinPartitions("key").mapInArrow(
        lambda b: _search_buckets(b, exact), "a bigint, b bigint").distinct()
    if marks.filter(F.col("n") > exact).isEmpty():
        return links
    links = cut(links)
    return links.union(_split_links(full, marks, links, exact)).distinct()


def repeated_passages(docs: DataFrame, exact: int = EXACT_BUCKET) -> DataFrame:
    """One row per repeated passage: doc_id, first_word, end_word, n_words, cluster, keep_doc_ids, removed, digest.

    Words are numbered from 0 over the white-space-separated words of the text, ends are exclusive. Rows with ``removed``
    go, their text stays in the documents ``keep_doc_ids``; rows without are the kept passages. Documents without a repeated passage of
    ``PASSAGE_WORDS`` words have no row. Null and empty texts have no units; null ids take part and rank before others, and
    an owner without an id is a null in ``keep_doc_ids``. Different texts of one id, or of none, are texts of their own, told
    apart by ``digest``; rows equal in id and text count as one. Of equal places the smallest (doc_id, digest, first word)
    owns a cluster. Empty input gives no rows; very long texts are a step of their own; other columns are not read.
    """
    repeated = repeated_keys(docs)
    near = staged(components(near_links(docs, exact, repeated)).select(F.col("node").alias("unit"), "root"), "near")
    wanted = docs.sparkSession.sparkContext.broadcast(repeated.value | key_filter(near, "unit"))
    found = staged(places(docs, wanted), "places")
    lines = found.filter("unit is not null").drop("seeds")
    same = lines.groupBy("unit").agg(F.count("*").alias("copies"), F.min(F.struct(*TEXT, "first")).alias("place"))
    classes = cut(same.join(near, "unit", "left").filter(F.col("root").isNotNull() | (F.col("copies") > 1)).withColumn(
        "root", F.coalesce("root", "unit")))
    owner = classes.groupBy("root").agg(F.min("place").alias("owner"))
    classes = cut(classes.join(owner, "root").select("unit", "copies", "root", "owner"))
    rows = join_classes(lines, classes.hint("shuffle_hash"), "unit", "copies", "inner").select(
        *TEXT, "first", "last", F.col("root").alias("cluster"), F.struct("owner.doc_id", "owner.digest").alias("keep"),
        (~(F.struct(*TEXT, "first").eqNullSafe(F.col("owner")))).alias("removed"))
    rows = staged(rows, "verdicts")
    rows = rows.unionByName(repeated_runs(docs, found.filter("seeds is not null"), rows))
    order = Window.partitionBy(*TEXT, "removed").orderBy("first", F.desc("last"))
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("__new", F.when(before + GAP_WORDS >= F.col("first"), 0).otherwise(1))
    rows = rows.withColumn("__run", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    owners = F.transform(F.array_sort(F.collect_set("keep")), lambda o: o["doc_id"])
    return rows.groupBy(*TEXT, "removed", "__run").agg(
        F.min("first").alias("first_word"), F.max("last").alias("end_word"), F.min("cluster").alias("cluster"),
        F.array_distinct(owners).alias("keep_doc_ids")).withColumn("n_words", F.col("end_word") - F.col("first_word")).filter(
        F.col("n_words") >= PASSAGE_WORDS).select("doc_id", "first_word", "end_word", "n_words", "cluster", "keep_doc_ids", "removed", "digest")
