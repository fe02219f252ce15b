"""Alignment of two tokenizers by lockstep merging of their byte offsets.

The tokens of all texts of a step lie one after another on one line of bytes. A state vector holds a pointer into the
ends of A and one into the ends of B for every lane (a text, or a stretch of a long one); each round every lane emits its
link and, where both tokens end on the same byte, a cut, and advances whichever pointer ends first. Lanes that are
through leave the vector. Cuts bound the groups; in groups with several tokens on both sides the links of tokens that
do not overlap are added.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from silsila.llm.common import map_rows, stage_table, texts_of
from silsila.llm.packing import byte_signs

#: Tokens of A in one lane, bytes of text in one step, links that are listed at a time.
LANE, STEP, LISTED = 1024, 2_000_000, 1 << 20
#: Id pairs with more than this part of all rows are broadcast; there are fewer than that many, by arithmetic.
SHARE = 100_000


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Merge two ascending arrays of byte ends, lane by lane in step: (links a, links b, cuts a, cuts b).

    A lane goes through the tokens ``start`` to ``stop`` of A; its first token of B is the one that ends after the byte on
    which the lane begins. A link is a pair of overlapping tokens, a cut a pair with one end.
    """
    before = np.where(start > 0, ends_a[start - 1], 0)
    a, b = start, np.searchsorted(ends_b, before, "right")
    links, cuts = [], []
    while len(a):
        x, y = ends_a[a], ends_b[b]
        links.append((a, b))
        both = x == y
        if both.any():
            cuts.append((a[both], b[both]))
        a, b = a + (x <= y), b + (y <= x)
        live = a < stop
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    return tuple(np.concatenate([r[i] for r in rows]) if rows else np.zeros(0, dtype=np.int64) for rows in (links, cuts) for i in (0, 1))


def _blocks(low_a, low_b, n_a, n_b):
    """All (a, b) of blocks of n_a times n_b tokens."""
    many = n_a * n_b
    at = np.repeat(np.arange(len(many)), many)
    place = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
    return low_a[at] + place // n_b[at], low_b[at] + place % n_b[at]


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches flat[start:start + size] one after another."""
    stops = np.cumsum(size)
    return flat[np.repeat(start - (stops - size), size) + np.arange(int(stops[-1]) if len(stops) else 0)]


#: No token of either vocabulary goes on from a sign into the blank after it, and what follows the blank starts a token.
_CHUNK = re.compile("(?<! )(?= [!-~À-ɏ])")


class Aligner:
    """Tokens, groups and links of texts under both tokenizers; each distinct blank-separated chunk is encoded once while
    it is remembered."""

    def __init__(self, spec_a: str, model_b: bytes, remember: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.remember = Tokenizer.from_str(spec_a), remember
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        byte = {sign: value for value, sign in enumerate(byte_signs())}
        names = self.a.get_vocab(with_added_tokens=True)
        self.size_a, self.size_b = max(names.values()) + 1, self.b.vocab_size()
        self.raw_a = [b""] * self.size_a
        for name, i in names.items():
            self.raw_a[i] = bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()
        self.raw_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.size_b))]
        self.width_a, self.width_b = (np.array([len(r) for r in raw], dtype=np.int64) for raw in (self.raw_a, self.raw_b))
        self.span = max(self.size_a, self.size_b)
        self.written = [f"{i}{mark}" for mark in ",|;" for i in range(self.span)]
        self._forget()

    def _forget(self) -> None:
        none = np.zeros(0, dtype=np.int64)
        self.code: dict[str, int] = {}
        self.flat, self.start, self.size, self.spelled = [none, none], [none, none], [none, none], np.zeros(0, dtype=bool)

    def _learn(self, chunks: list[str]) -> None:
        encode = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        ids = ([e.ids for e in encode(chunks, add_special_tokens=False)], self.b.encode([c[1:] for c in chunks], num_threads=1))
        raw = [c.encode("utf-8", "surrogatepass") for c in chunks]
        fits = [b"".join(map(self.raw_b.__getitem__, b)) == r and b"".join(map(self.raw_a.__getitem__, a)) == r for a, b, r in zip(*ids, raw)]
        self.spelled = np.concatenate([self.spelled, np.array(fits, dtype=bool)])
        for side, lists in enumerate(ids):
            size = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
            self.start[side] = np.concatenate([self.start[side], len(self.flat[side]) + np.cumsum(size) - size])
            self.size[side] = np.concatenate([self.size[side], size])
            self.flat[side] = np.concatenate([self.flat[side], np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(size.sum()))])
        self.code.update(zip(chunks, range(len(self.code), len(self.code) + len(chunks))))

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of A, ids of B, number of A per text, number of B per text); no ids where the tokens of a side do not
        spell a blank and the text."""
        if len(self.flat[0]) > self.remember:
            self._forget()
        parts = [_CHUNK.split(" " + t) if t else [] for t in texts]
        parts = [some if not some or some[0] else some[1:] for some in parts]
        new = [c for c in dict.fromkeys(chain.from_iterable(parts)) if c not in self.code]
        if new:
            self._learn(new)
        many = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        code = np.fromiter(map(self.code.__getitem__, chain.from_iterable(parts)), dtype=np.int64, count=int(many.sum()))
        of = np.repeat(np.arange(len(texts)), many)
        broken = np.zeros(len(texts), dtype=bool)
        broken[of[~self.spelled[code]]] = True
        of, code = of[~broken[of]], code[~broken[of]]
        n_a, n_b = (np.bincount(of, weights=size[code], minlength=len(texts)).astype(np.int64) for size in self.size)
        ids_a, ids_b = (_gather(flat, start[code], size[code]) for flat, start, size in zip(self.flat, self.start, self.size))
        return ids_a, ids_b, n_a, n_b

    def align(self, texts: list[str]) -> dict:
        """Columns n_a, n_b, n_groups, n_links, groups_sha256, and per text its linked id pairs with how often."""
        ids_a, ids_b, n_a, n_b = self.tokens(texts)
        stops = np.cumsum(n_a)
        lanes = -(-n_a // LANE)                                    # long texts go in several lanes
        of = np.repeat(np.arange(len(texts)), lanes)
        start = (stops - n_a)[of] + LANE * (np.arange(len(of)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        link_a, link_b, cut_a, cut_b = lockstep(np.cumsum(self.width_a[ids_a]), np.cumsum(self.width_b[ids_b]), start,
                                                np.minimum(start + LANE, stops[of]))
        cut_a, cut_b = np.sort(cut_a), np.sort(cut_b)
        size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
        text_of = np.searchsorted(stops, cut_a, "right")           # of a group; every text ends with a cut
        n_groups = np.bincount(text_of, minlength=len(texts))
        n_links = np.bincount(text_of, weights=size_a * size_b, minlength=len(texts)).astype(np.int64)
        pairs, times, text = self._id_pairs(ids_a, ids_b, (link_a, link_b), (cut_a, cut_b), (size_a, size_b), text_of)
        bounds = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
                "groups_sha256": self._digests(ids_a, ids_b, (cut_a, cut_b), (size_a, size_b), n_a + n_b),
                "pairs": pa.ListArray.from_arrays(bounds, pairs), "times": pa.ListArray.from_arrays(bounds, times)}

    def _id_pairs(self, ids_a, ids_b, links, cuts, sizes, text_of):
        """(pair, times, text) sorted by text and pair; a pair is ``id A * vocabulary of B + id B``."""
        (link_a, link_b), (cut_a, cut_b), (size_a, size_b) = links, cuts, sizes
        span = self.size_a * self.size_b
        wide = (size_a > 1) & (size_b > 1)
        group = np.searchsorted(cut_a, link_a)
        narrow = ~wide[group]
        found = [((text_of[group[narrow]] * self.size_a + ids_a[link_a[narrow]]) * self.size_b + ids_b[link_b[narrow]], None)]
        at = np.flatnonzero(wide)
        many = size_a[at] * size_b[at]
        for g in at[many > LISTED]:                                # a very large group: its distinct ids only
            one, n_one = np.unique(ids_a[cut_a[g] + 1 - size_a[g]:cut_a[g] + 1], return_counts=True)
            two, n_two = np.unique(ids_b[cut_b[g] + 1 - size_b[g]:cut_b[g] + 1], return_counts=True)
            found.append((((text_of[g] * self.size_a + one)[:, None] * self.size_b + two[None, :]).ravel(),
                          (n_one[:, None] * n_two[None, :]).ravel()))
        at, many = at[many <= LISTED], many[many <= LISTED]
        parts = np.cumsum(many) // LISTED
        for part in range(int(parts[-1]) + 1 if len(parts) else 0):
            g = at[parts == part]
            a, b = _blocks(cut_a[g] + 1 - size_a[g], cut_b[g] + 1 - size_b[g], size_a[g], size_b[g])
            t = text_of[np.searchsorted(cut_a, a)]
            found.append(_counted((t * self.size_a + ids_a[a]) * self.size_b + ids_b[b]))
        keys = np.concatenate([k for k, _ in found])
        weight = np.concatenate([np.ones(len(k), dtype=np.int64) if w is None else w for k, w in found])
        keys, inverse = np.unique(keys, return_inverse=True)
        return keys % span, np.bincount(inverse, weights=weight, minlength=len(keys)).astype(np.int64), keys // span

    def _digests(self, ids_a, ids_b, cuts, sizes, n_tokens) -> list[str]:
        """Digests of the groups as text: ids of a group in order, commas between them, ``|`` after A, ``;`` after B."""
        last_a, last_b = (np.zeros(len(ids), dtype=bool) for ids in (ids_a, ids_b))
        last_a[cuts[0]] = last_b[cuts[1]] = True
        code = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        # in the text stand, before a token of A, all tokens of earlier groups, and before one of B its whole group of A too
        code[np.arange(len(ids_a)) + np.repeat(cuts[1] + 1 - sizes[1], sizes[0])] = ids_a + self.span * last_a
        code[np.arange(len(ids_b)) + np.repeat(cuts[0] + 1, sizes[1])] = ids_b + 2 * self.span * last_b
        out, low, written = [], 0, self.written
        for n in n_tokens.tolist():
            said = "".join(map(written.__getitem__, code[low:low + n].tolist()))
            out.append(hashlib.sha256(said[:-1].encode()).hexdigest() if n else "")
            low += n
        return out


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) per row: the linked id pairs of a text
    (``id A * vocabulary of B + id B``, each once) and how many links each has."""
    with open(path_a, encoding="utf-8") as f, open(path_b, "rb") as g:
        files = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))       # two vocabulary files
    held = []

    def one(batch):
        if not held:
            held.append(Aligner(*files.value))
        return {"doc_id": batch.column("doc_id"), **held[0].align(texts_of(batch))}

    return map_rows(docs.select("doc_id", "text"), one, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                    "groups_sha256 string, pairs array<bigint>, times array<bigint>", step=STEP)


def pair_counts(rows: DataFrame, vocabulary_b: int) -> DataFrame:
    """(pair, n, best): in how many rows a pair is linked, and whether no pair of its id of A is linked in more."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = stage_table(counts.withColumn("a", F.floor(F.col("pair") / F.lit(vocabulary_b))), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))                         # one row per id of A
    return counts.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, path_a: str, path_b: str, share: int = SHARE) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Texts that are null, empty, or not spelled by the tokens of a side (normalised away) have no tokens: zeros and an empty
    digest. Strings of special tokens are plain text. Ties for the highest count of an id all count as best; repeated rows
    count and come back as often as they occur; empty input gives no rows; a very long text is one step of its own, cut into
    lanes; columns besides doc_id and text are not read.

    Pairs with more than one ``share``-th of all (row, pair) are told to every task (fewer than ``share`` by arithmetic);
    the other pairs meet their rows in a join on the pair, where none has more than that share.
    """
    rows = stage_table(aligned(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = pair_counts(rows, sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size())
    total = counts.agg(F.sum("n")).first()[0] or 0
    is_heavy = F.col("n") * share > total
    heavy = counts.filter(is_heavy).orderBy("pair").toArrow()                        # fewer than ``share`` rows
    told = docs.sparkSession.sparkContext.broadcast(tuple(heavy.column(c).to_numpy() for c in ("pair", "n", "best")))

    def parts(batches):
        """Runs of rows that hold about LISTED pairs."""
        for batch in batches:
            before = batch.column("pairs").offsets.to_numpy().astype(np.int64)
            low = 0
            while low < batch.num_rows:
                high = max(int(np.searchsorted(before, before[low] + LISTED, "right")) - 1, low + 1)
                yield batch.slice(low, high - low)
                low = high

    def look_up(batch):
        """(pairs, times, row number in the batch, place among the heavy pairs, whether it is one)."""
        pairs, n, best = told.value
        listed = batch.column("pairs")
        flat, times = listed.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
        of = np.repeat(np.arange(batch.num_rows), np.diff(listed.offsets.to_numpy()))
        at = np.minimum(np.searchsorted(pairs, flat), max(len(pairs) - 1, 0))
        return flat, times, of, at, (pairs[at] == flat if len(pairs) else np.zeros(len(flat), dtype=bool))

    def known(batches):
        for batch in parts(batches):
            flat, times, of, at, hit = look_up(batch)
            _, n, best = told.value
            at, of, times = at[hit], of[hit], times[hit]
            out = {name: batch.column(name) for name in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            for name, value in (("n_best", times * best[at]), ("count_sum", times * n[at])):
                sums = np.zeros(batch.num_rows, dtype=np.int64)
                np.add.at(sums, of, value)
                out[name] = sums
            yield pa.RecordBatch.from_pydict(out)

    def unknown(batches):
        for batch in parts(batches):
            flat, times, of, _, hit = look_up(batch)
            yield pa.RecordBatch.from_pydict({"row": batch.column("row").to_numpy()[of[~hit]], "pair": flat[~hit], "times": times[~hit]})

    first = rows.mapInArrow(known, "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
                                   "n_best bigint, count_sum bigint")
    rest = rows.select("row", "pairs", "times").mapInArrow(unknown, "row bigint, pair bigint, times bigint").join(counts.filter(~is_heavy), "pair")
    rest = rest.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("__best"), F.sum(F.col("times") * F.col("n")).alias("__sum"))
    zero = F.lit(0).cast("long")
    return first.join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("__best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("__sum", zero)).alias("count_sum"), "groups_sha256")
