"""Quality classifier by nearest-neighbour voting over labelled latent-semantic vectors.

Terms describe style, not vocabulary: hashed trigrams of character classes and how soon words come back. Inverse
document frequencies are counted over all documents; the latent space and the labelled vectors come from a bounded
sample, so the broadcast has a fixed size. Every document is compared with every labelled vector, in blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silsila.llm.common import bounded_sample, map_rows, steps, texts_of
from silsila.llm.quality_rules import word_codes

#: Classes of bytes: runs of the same letter class tell nothing, so letters count by case, other characters by sort.
_CLASSES = np.zeros(256, dtype=np.int32)
for _bytes, _class in ((range(97, 123), 1), (range(65, 91), 2), (range(48, 58), 3), (b" \t\x0b\x0c\r", 4), (b"\n", 5), (b".", 6), (b",;:", 7),
                       (b"!?", 8), (b"|", 9), (b"*", 10), (b"#", 11), (b"$%&", 12), (b"<>[]{}()/\\", 13), (b"'\"-_+=@^`~", 14),
                       (range(128, 192), 15), (range(192, 256), 1)):
    _CLASSES[list(_bytes)] = _class
_GAPS = np.array([1, 2, 4, 16, 64])                     # words back to the last occurrence, by bucket
WIDTH = 16 ** 3 + len(_GAPS) + 1


def term_counts(text: str) -> np.ndarray:
    """Occurrences of each term in a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    c = _CLASSES[np.frombuffer(raw, np.uint8)]
    c = c[c != 15]                                       # continuation bytes belong to the letter before them
    tri = np.bincount((c[:-2] * 16 + c[1:-1]) * 16 + c[2:], minlength=16 ** 3) if len(c) > 2 else np.zeros(16 ** 3, int)
    codes, distinct = word_codes(raw.split())
    order = np.argsort(codes, kind="stable")
    back = np.diff(order)[codes[order[1:]] == codes[order[:-1]]]
    gaps = np.bincount(np.searchsorted(_GAPS, back, "left"), minlength=len(_GAPS) + 1)[:len(_GAPS) + 1]
    return np.concatenate([tri, gaps])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per term over all rows; a task hands on one count per term."""
    def run(batches):
        df, n = np.zeros(WIDTH, dtype=np.int64), 0
        for batch in batches:
            for part in steps(batch):
                for t in texts_of(part):
                    df += term_counts(t) > 0
                    n += 1
        found = np.flatnonzero(df)
        if n:
            yield pa.RecordBatch.from_pydict({"term": pa.array(np.append(found, -1), pa.int32()),
                                              "df": pa.array(np.append(df[found], n), pa.int64())})

    out, total = np.zeros(WIDTH, dtype=np.int64), 0
    for r in docs.select("text").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        if r.term < 0:
            total = r.df
        else:
            out[r.term] = r.df
    return out, total


def _weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of unit length; term frequencies are damped by a logarithm of their share."""
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    x = np.log1p(share * 1000.0) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def latent_space(x: np.ndarray, dims: int, passes: int = 4) -> np.ndarray:
    """Right singular vectors [terms, dims] by subspace iteration from a fixed start."""
    q = np.random.default_rng(11).standard_normal((x.shape[1], min(dims + 8, min(x.shape))))
    for _ in range(passes):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    return q @ np.linalg.svd(x @ q, full_matrices=False)[2].T[:, :dims]


@dataclass
class Neighbours:
    """Labelled unit vectors in the latent space, with the weights to reach it."""
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    votes: np.ndarray
    prior: float
    nearest: int = 15
    sharpness: float = 30.0

    def embed(self, counts: np.ndarray) -> np.ndarray:
        z = _weigh(counts, self.idf).astype(np.float32) @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray, block: int = 1024) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by similarity; exact cosine products."""
        z = self.embed(counts)
        best_s, best_v = np.full((len(z), 0), -2.0, np.float32), np.zeros((len(z), 0), np.float32)
        for low in range(0, len(self.vectors), block):
            s = np.hstack([best_s, z @ self.vectors[low:low + block].T])
            v = np.hstack([best_v, np.broadcast_to(self.votes[low:low + block], (len(z), len(self.vectors[low:low + block])))])
            if s.shape[1] > self.nearest:
                top = np.argpartition(-s, self.nearest - 1, axis=1)[:, :self.nearest]
                s, v = np.take_along_axis(s, top, 1), np.take_along_axis(v, top, 1)
            best_s, best_v = s, v
        w = np.exp(self.sharpness * (best_s.astype(np.float64) - 1.0))
        out = (w * best_v).sum(axis=1) + 0.1 * self.prior * np.exp(-self.sharpness)
        out /= w.sum(axis=1) + 0.1 * np.exp(-self.sharpness)
        out[counts.sum(axis=1) == 0] = self.prior            # nothing to compare
        return np.clip(out, 0.0, 1.0)


def learnable(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """(doc_id, text, quality) of labelled rows outside the held-out fold of the id's crc32."""
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    known = labels.filter("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("__label")).filter(fold != held_out)
    return docs.select("doc_id", "text").join(known, "doc_id").withColumnRenamed("__label", "quality")


def train(docs: DataFrame, labels: DataFrame, sample: int = 3000, dims: int = 40) -> Neighbours | None:
    """``sample`` bounds the labelled vectors; None without any."""
    marks = labels.filter("quality is not null").select("doc_id").distinct().filter(
        F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    _, some_docs, some_labels = bounded_sample(marks, "doc_id", sample, docs, labels)
    chosen = learnable(some_docs, some_labels)

    def sparse(batch):
        out = {"doc_id": batch.column("doc_id"), "quality": batch.column("quality"), "term": [], "n": []}
        for t in texts_of(batch):
            c = term_counts(t)
            at = np.flatnonzero(c)
            out["term"].append(at.astype(np.int32))
            out["n"].append(c[at].astype(np.int64))
        return out

    rows = map_rows(chosen, sparse, "doc_id bigint, quality int, term array<int>, n array<bigint>").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.doc_id, r.term, r.n))
    df, n = document_frequencies(docs)
    counts = np.zeros((len(rows), WIDTH), dtype=np.float32)
    for i, r in enumerate(rows):
        counts[i, r.term] = r.n
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    basis = latent_space(_weigh(counts, idf), dims).astype(np.float32)
    votes = np.array([float(r.quality > 0) for r in rows], dtype=np.float32)
    model = Neighbours(idf.astype(np.float32), basis, np.zeros((0, basis.shape[1]), np.float32), votes, float(votes.mean()))
    model.vectors = model.embed(counts).astype(np.float32)
    return model


def classify(docs: DataFrame, model: Neighbours | None, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) per row. Null and empty texts get the share of label 1 among the learned rows, all
    texts 0.5 where nothing was learned. Repeated rows repeat; empty input gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)   # at most ``sample`` vectors

    def one(batch):
        texts, m = texts_of(batch), Neighbours(**shared.value) if shared.value else None
        score = np.full(len(texts), 0.5)
        for low in range(0, len(texts) if m is not None else 0, 500):
            some = texts[low:low + 500]
            score[low:low + 500] = m.score(np.array([term_counts(t) for t in some], dtype=np.float32))
        return {"doc_id": batch.column("doc_id"), "score": score, "predicted": (score >= threshold).astype(np.int32)}

    return map_rows(docs.select("doc_id", "text"), one, "doc_id bigint, score double, predicted int")
