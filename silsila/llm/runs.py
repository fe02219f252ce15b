"""Periodic runs of words by seed and extend on the diagonals of a text against itself.

A run of period q and at least 4q words holds 3q or more equal pairs on diagonal (lag) q. Lags are taken in classes
[2^j, 2^(j+1)): every run of a class holds a seed of ``3 * 2^j`` words (five at lag one) at its start and once more one
period on. A seed is longer than any lag of its class, so by the theorem of Fine and Wilf its next occurrence inside a
run lies exactly one smallest period away. Only pairs of neighbouring occurrences are listed, at most one per word and
class, and none is a multiple of the smallest period. A seed pair is extended along its lag unless the table of the lag
says that an earlier extension covered it.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame

from silsila.llm.common import map_rows, texts_of

LEAST_WORDS, LEAST_PERIODS = 6, 4
_STRIDE = 64


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Words of a text, with a tail that repeats where the digest of the id says so (see the contract of the query)."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def _pair_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal numbers exactly for equal (left, right); numbers below the length."""
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def _reach(codes: np.ndarray, low: int, lag: int, step: int) -> int:
    """How many pairs (k, k + lag) from k = low on, in direction ``step``, are equal."""
    limit = len(codes) - lag - low if step > 0 else low + 1
    done, size = 0, _STRIDE
    while done < limit:
        size = min(size, limit - done)
        at = low + done if step > 0 else low - done - size + 1
        differs = np.flatnonzero(codes[at:at + size] != codes[at + lag:at + lag + size])
        if len(differs):
            return done + int(differs[0] if step > 0 else size - 1 - differs[-1])
        done += size
        size *= 2
    return limit


def find_runs(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """All (start, length, period) of maximal runs, by start, then period; ``codes`` are numbers of words.

    A run has its smallest period q and at least ``max(6, 4q)`` words.
    """
    n = len(codes)
    found = []
    names = np.unique(codes, return_inverse=True)[1].astype(np.int64)       # of every run of ``width`` words
    words, width, least = names, 1, 1
    while LEAST_PERIODS * least <= n and n >= LEAST_WORDS:
        while width < 2 * least:
            names = _pair_names(names[:len(names) - width], names[width:])
            width *= 2
        if least == 1:                                                       # five words: four and one
            four = _pair_names(names[:-2], names[2:])
            seeds = _pair_names(four[:n - 4], words[4:])
        else:                                                                # 2^(j+1) and 2^j words
            seeds = _pair_names(names[:len(half) - width], half[width:])
        half = names
        order = np.argsort(seeds, kind="stable")
        again = seeds[order[1:]] == seeds[order[:-1]]
        if not again.any():                     # a longer lag would repeat these seeds too
            break
        here = order[:-1][again]
        lag = order[1:][again] - here
        of_class = (lag >= least) & (lag < 2 * least)
        here, lag = here[of_class], lag[of_class]
        by_lag = np.lexsort((here, lag))
        here, lag = here[by_lag], lag[by_lag]
        edge = np.flatnonzero(np.concatenate([[True], lag[1:] != lag[:-1], [True]])) if len(lag) else [0]
        for low, high in zip(edge[:-1], edge[1:]):
            q = int(lag[low])
            while low < high:
                i = int(here[low])
                start = i - (_reach(codes, i - 1, q, -1) if i else 0)
                covered = i + _reach(codes, i, q, 1)
                if covered + q - start >= max(LEAST_WORDS, LEAST_PERIODS * q):
                    found.append((start, covered + q - start, q))
                low += int(np.searchsorted(here[low:high], covered))         # seeds up to there belong to this stretch
        least *= 2
    found.sort(key=lambda r: (r[0], r[2]))
    return found


def describe(text: str, doc_id: int | None) -> dict:
    """The digest columns of one text."""
    words = planted(text.encode("utf-8", "surrogatepass").split(), doc_id)
    code: dict[bytes, int] = {}
    codes = np.fromiter((code.setdefault(w, len(code)) for w in words), dtype=np.int64, count=len(words))
    found = find_runs(codes)
    best = (None, None, None)
    exponent = None
    if found:
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        exponent = 1000 * best[1] // best[2]
        depth = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, q in found:
            depth[start + q] += 1
            depth[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return {"n_runs": len(found), "start": best[0], "length": best[1], "period": best[2], "exponent_milli": exponent,
            "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(b" ".join(words)).hexdigest()}


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_runs, the run of greatest length/period (start, length, period, exponent_milli),
    runs_sha256, collapsed_sha256.

    Words are parted by ASCII white space. Null and empty texts have no words and no runs (four nulls, digests of nothing);
    a null id plants no repetition. Ties between runs go to the smallest start, then period. Repeated rows repeat; empty
    input gives no rows; a very long text is one step of its own, its work is n log n; columns besides doc_id and text are
    not read. No shuffle: each text is searched where it is read.
    """
    def one(batch):
        ids = batch.column("doc_id")
        rows = [describe(t, i) for t, i in zip(texts_of(batch), ids.to_pylist())]
        names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
        return {"doc_id": ids, **{name: [r[name] for r in rows] for name in names}}

    return map_rows(docs.select("doc_id", "text"), one,
                    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
                    "runs_sha256 string, collapsed_sha256 string")
