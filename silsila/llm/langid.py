"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Training is follow-the-regularised-leader with an elastic net (McMahan 2013), then one temperature is fitted.
Document frequencies are counted over every labelled document; only the gradient steps use a bounded sample.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silsila.llm.common import GRAIN, edit_rows, map_rows, segment_sums, steps, texts_of

BITS = 14
ORDERS = (1, 2, 3)
UNKNOWN = "und"
#: Text per step: n-gram arrays take some thirty times its size.
STEP = 1_500_000
_NOT_BLANK = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """A character of the Unicode letter categories."""
    if not _NOT_BLANK.search(text):
        return False
    return any(map(str.isalpha, text))


def grams(texts: list[str], bits: int = BITS, orders=ORDERS):
    """Hashed n-grams of the lower-cased texts: yields (ids, starts, ends) per order, segments by text.

    White space of any length counts as one blank; no gram crosses from one text to another.
    """
    flat = [" ".join(t.lower().split()) for t in texts]
    size = np.array([len(t) for t in flat], dtype=np.int64)
    ends = np.cumsum(size)
    codes = np.frombuffer("".join(flat).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    h = np.zeros(len(codes), dtype=np.uint32)
    for n in range(1, max(orders) + 1):
        # h of order n at i covers codes[i : i+n]
        h = (h[:len(codes) - n + 1] if n > 1 else h) * np.uint32(0x01000193) ^ codes[n - 1:] * np.uint32(0x9E3779B1)
        if n in orders:
            starts = ends - size
            last = np.maximum(np.minimum(ends - (n - 1), len(h)), np.minimum(starts, len(h)))
            yield (h * np.uint32(0x85EBCA6B) >> np.uint32(32 - bits)).astype(np.int32), np.minimum(starts, len(h)), last
        if len(codes) <= n:
            return


@dataclass
class LanguageModel:
    """``table``: per gram and language the weight times the inverse document frequency, divided by the temperature."""
    languages: list[str]
    table: np.ndarray
    bias: np.ndarray

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """One row per text."""
        k = len(self.languages)
        total, count = np.zeros((len(texts), k)), np.zeros(len(texts))
        for ids, starts, ends in grams(texts):
            for c in range(k):
                total[:, c] += segment_sums(self.table[c].take(ids), starts, ends)
            count += np.maximum(ends - starts, 0)
        z = total / np.maximum(count, 1)[:, None] + self.bias
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        return p / p.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Best language and its probability; ``und`` with 0.0 for a text without a letter or an empty model."""
        lettered = [has_letter(t) for t in texts]
        if not self.languages or not texts:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        p = self.probabilities(texts)
        best = p.argmax(axis=1)
        return ([self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)],
                [float(p[i, b]) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, lettered))])


def learnable(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """Rows that may be learned from: a language, and a crc32 of the id outside the held-out fold."""
    return docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                       & F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds != held_out, F.lit(False)))


def document_frequencies(docs: DataFrame, bits: int = BITS) -> tuple[np.ndarray, int]:
    """Documents per gram over all rows. Each task hands on at most ``2**bits`` counts; so does the last step."""
    schema = "gram int, df bigint"

    def run(batches):
        df, n = np.zeros(1 << bits, dtype=np.int64), 0
        for batch in batches:
            for part in steps(batch, limit=STEP):
                texts = texts_of(part)
                n += len(texts)
                seen = np.zeros(1 << bits, dtype=bool)
                pieces = list(grams(texts, bits))
                for d in range(len(texts)):
                    seen[:] = False
                    for ids, starts, ends in pieces:
                        seen[ids[starts[d]:ends[d]]] = True
                    df += seen
        found = np.flatnonzero(df)
        if n:
            yield pa.RecordBatch.from_pydict({"gram": pa.array(np.append(found, -1), pa.int32()),
                                              "df": pa.array(np.append(df[found], n), pa.int64())})

    out, total = np.zeros(1 << bits, dtype=np.int64), 0
    for r in docs.select("text").mapInArrow(run, schema).groupBy("gram").agg(F.sum("df").alias("df")).collect():
        if r.gram < 0:
            total = r.df
        else:
            out[r.gram] = r.df
    return out, total


def gram_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, gram, n): the grams of each whole text and how often they occur, at most ``2**BITS`` per row."""
    def one(batch):
        out = {"doc_id": batch.column("doc_id"), "lang": batch.column("lang"), "gram": [], "n": []}
        for text in texts_of(batch):
            parts = [ids[s[0]:e[0]] for ids, s, e in grams([text])]
            ids, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int32), return_counts=True)
            out["gram"].append(ids.astype(np.int32))
            out["n"].append(n)
        return out

    return map_rows(docs.select("doc_id", "text", "lang"), one, "doc_id bigint, lang string, gram array<int>, n array<bigint>", step=STEP)


def _features(grams_of, counts, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse TF-IDF vector: gram ids and (relative frequency x idf)."""
    ids, n = np.array(grams_of, dtype=np.int64), np.array(counts, dtype=float)
    return ids, n / max(n.sum(), 1) * idf[ids]


def fit_ftrl(rows, targets, k: int, width: int, epochs: int = 4, alpha: float = 8.0, beta: float = 1.0,
             l1: float = 2e-5, l2: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Per-coordinate FTRL-proximal with elastic net; returns (weights[width, k], bias[k]). Order is fixed."""
    z, n = np.zeros((width + 1, k)), np.zeros((width + 1, k))
    w = np.zeros((width + 1, k))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            ids, x = rows[i]
            ids, x = np.append(ids, width), np.append(x, 0.05)
            zi, ni = z[ids], n[ids]
            wi = -(zi - np.sign(zi) * l1) / ((beta * 1e-3 + np.sqrt(ni)) / alpha + l2)
            wi[np.abs(zi) <= l1] = 0.0
            w[ids] = wi
            s = x @ wi
            p = np.exp(s - s.max())
            p /= p.sum()
            p[targets[i]] -= 1.0
            g = np.outer(x, p)
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[ids] += g - sigma * wi
            n[ids] += g * g
    return w[:width], w[width] * 0.05


def fit_temperature(logits: np.ndarray, targets: np.ndarray) -> float:
    """Temperature (0.5 to 20) with the least negative log likelihood; golden section on its logarithm."""
    if not len(logits):
        return 1.0

    def loss(t):
        s = logits / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), targets]))

    a, b, r = np.log(0.5), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def stratified_sample(known: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` rows by a hash of the id, all rows where there are no more than that.

    Half of ``sample`` is promised to the languages in equal parts: a language with fewer rows in its share of the whole
    is taken up to that part, so rare ones stay, and the rows are one and a half times ``sample`` at most. Of a language
    that no hash chose the row with the least id and text is taken.
    """
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())
    if n <= sample:
        return known
    floor = max(1.0, sample / (2 * len(counts)))
    part = {lang: int(GRAIN * min(1.0, max(sample / n, floor / c))) for lang, c in counts.items()}
    parts = F.create_map(*[F.lit(x) for pair in part.items() for x in pair])
    spot = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(GRAIN))
    chosen = known.filter(spot < parts[F.col("lang")])
    missing = sorted(set(counts) - {r.lang for r in chosen.select("lang").distinct().collect()})
    if not missing:
        return chosen
    least = known.filter(F.col("lang").isin(missing)).groupBy("lang").agg(F.min(F.struct("doc_id", "text")).alias("row"))
    return chosen.unionByName(least.select("row.doc_id", "row.text", "lang"))


def temperature_share(targets: np.ndarray) -> np.ndarray:
    """Which rows set the temperature: the first fifth of each language. A language of under five rows is only learned."""
    chosen = np.zeros(len(targets), dtype=bool)
    for c in np.unique(targets):
        at = np.flatnonzero(targets == c)
        chosen[at[:len(at) // 5]] = True
    return chosen


def train(docs: DataFrame, sample: int = 3000) -> LanguageModel:
    """Learn from ``learnable(docs)``, every language of it. ``sample`` bounds the documents used for gradient steps and the
    temperature, see ``stratified_sample``."""
    known = learnable(docs.select("doc_id", "text", "lang"))
    rows = gram_counts(stratified_sample(known, sample)).collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id, r.lang, r.gram, r.n))
    languages = sorted({r.lang for r in rows})
    width = 1 << BITS
    if not languages:
        return LanguageModel([], np.zeros((0, width), np.float32), np.zeros(0))
    df, n = document_frequencies(known)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    at = {lang: i for i, lang in enumerate(languages)}
    x = [_features(r.gram, r.n, idf) for r in rows]
    y = np.array([at[r.lang] for r in rows])
    tail = temperature_share(y)
    fit = np.flatnonzero(~tail)
    w, bias = fit_ftrl([x[i] for i in fit], y[fit], len(languages), width)
    logits = np.array([x[i][1] @ w[x[i][0]] + bias for i in np.flatnonzero(tail)])
    t = fit_temperature(logits, y[tail])
    return LanguageModel(languages, np.ascontiguousarray((w * idf[:, None] / t).T.astype(np.float32)), bias / t)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) per row. Null text and text without a letter: ``und`` and 0.0; repeated rows repeat."""
    def one(batch):
        langs, scores = model.predict(texts_of(batch))
        return {"doc_id": batch.column("doc_id"), "lang_pred": langs, "score": scores}

    return map_rows(docs.select("doc_id", "text"), one, "doc_id bigint, lang_pred string, score double", step=STEP)


def accept(docs: DataFrame, model: LanguageModel, least: float = 0.35) -> DataFrame:
    """Documents with a recognised language; rejected: no letter (``und``) or a probability below ``least``."""
    def one(batch):
        langs, scores = model.predict(texts_of(batch))
        return batch.filter(pa.array([g != UNKNOWN and s >= least for g, s in zip(langs, scores)], pa.bool_()))

    return edit_rows(docs, one, step=STEP)
