"""Quality rules: gradient-boosted trees over document statistics, scored as flat numpy node arrays.

Chosen features are monotone: more symbols, repeated lines or repeated words never raise a score, and more distinct
words never lower it. Texts are read once; the statistics are a small table that training and scoring share.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silsila.llm.common import bounded_sample, cut, map_rows, texts_of

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features and the sign each may have: -1 never raises the score, 1 never lowers it, 0 is free.
FEATURES = {"symbols": -1, "dup_lines": -1, "repeat_words": -1, "word_length": 0, "log_words": 0, "upper": -1, "digits": 0,
            "punctuation": -1, "line_words": 0, "bare_words": -1, "distinct_words": 1, "same_as_last": -1}
_SPACE, _SYMBOLS = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8), np.frombuffer(b"#*$%&|<>", np.uint8)
_PUNCTUATION = np.array([c for c in range(33, 127) if not chr(c).isalnum()], dtype=np.uint8)


def word_codes(words: list[bytes]) -> tuple[np.ndarray, int]:
    """Numbers of the words in order of first occurrence, and how many differ."""
    seen: dict[bytes, int] = {}
    add = seen.setdefault
    return np.array([add(w, len(seen)) for w in words], dtype=np.int64), len(seen)


def repeated_words(codes: np.ndarray, distinct: int) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(codes) < 4:
        return 0
    if distinct < 2_000_000:
        windows = (codes[:-2] * distinct + codes[1:-1]) * distinct + codes[2:]
    else:
        pairs = np.unique(codes[:-1] * distinct + codes[1:], return_inverse=True)[1]
        windows = pairs[:-1] * distinct + codes[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    at = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    inside = np.zeros(len(codes), dtype=bool)
    for k in range(3):
        inside[at + k] = True
    return int(inside.sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """(base counts, features) of a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    codes, distinct = word_codes(words)
    lines = [line for line in raw.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
    n, chars = len(words), len(raw) - int(count[128:192].sum()) - int(count[_SPACE].sum())
    base = [n, chars, int(count[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated_words(codes, distinct)]
    size, many = max(chars, 1), max(n, 1)
    bare = sum(len(w) < 3 and not w.isalnum() and w.isascii() for w in words)
    features = [base[2] / many, base[3] / max(len(lines), 1), base[4] / many, chars / many, float(np.log1p(n)),
                int(count[65:91].sum()) / size, int(count[48:58].sum()) / size, int(count[_PUNCTUATION].sum()) / size,
                n / max(len(lines), 1), bare / many, distinct / many, float((codes[1:] == codes[:-1]).sum()) / many]
    return base, features


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, base counts, features array) per row."""
    def one(batch):
        both = [statistics(t) for t in texts_of(batch)]
        out = {"doc_id": batch.column("doc_id")}
        out |= {name: [b[i] for b, _ in both] for i, name in enumerate(BASE)}
        return out | {"features": [f for _, f in both]}

    return map_rows(docs.select("doc_id", "text"), one,
                    "doc_id bigint, " + ", ".join(f"{n} bigint" for n in BASE) + ", features array<double>")


@dataclass
class Trees:
    """All trees in one set of node arrays; a leaf points to itself."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability per row: all trees of all rows go down one level at a time."""
        node = np.repeat(self.roots[None, :], len(x), axis=0)
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return 1.0 / (1.0 + np.exp(-(self.start + self.value[node].sum(axis=1))))


def fit_trees(x: np.ndarray, y: np.ndarray, signs, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 48,
              l2: float = 1.0, least: int = 8) -> Trees:
    """Newton boosting of the logistic loss on binned features.

    A split on a monotone feature must order its children's values, and the middle of the two bounds whatever lies
    below either child, so the whole tree is monotone.
    """
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(prior / (1 - prior)))
    score = np.full(len(y), start)

    def node():
        for part, v in ((feature, 0), (threshold, np.inf), (left, len(feature) - 1), (right, len(feature) - 1), (value, 0.0)):
            part.append(v)
        left[-1] = right[-1] = len(feature) - 1
        return len(feature) - 1

    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        roots.append(node())
        todo = [(roots[-1], np.arange(len(y)), 0, -np.inf, np.inf)]
        while todo:
            at, rows, level, low, high = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            best = None
            if level < depth and len(rows) >= 2 * least:
                for f, e in enumerate(edges):
                    c = code[rows, f]
                    gl = np.cumsum(np.bincount(c, g[rows], len(e) + 1))[:-1]
                    hl = np.cumsum(np.bincount(c, h[rows], len(e) + 1))[:-1]
                    nl = np.cumsum(np.bincount(c, minlength=len(e) + 1))[:-1]
                    a, b = np.clip(gl / (hl + l2), low, high), np.clip((gs - gl) / (hs - hl + l2), low, high)
                    gain = gl * a - (hl + l2) * a * a / 2 + (gs - gl) * b - (hs - hl + l2) * b * b / 2
                    bad = (nl < least) | (len(rows) - nl < least) | (signs[f] * (b - a) < 0)
                    gain[bad] = -np.inf
                    if len(gain) and (best is None or gain.max() > best[0]):
                        i = int(gain.argmax())
                        best = (gain[i], f, i, a[i], b[i])
            own = float(np.clip(gs / (hs + l2), low, high))
            if best is None or best[0] <= gs * own - (hs + l2) * own * own / 2 + 1e-6:
                value[at] = rate * own
                score[rows] += rate * own
                continue
            _, f, i, a, b = best
            feature[at], threshold[at] = f, edges[f][i]
            left[at], right[at] = node(), node()
            middle = (a + b) / 2
            bounds = ((low, high), (low, high)) if not signs[f] else (
                ((low, middle), (middle, high)) if signs[f] > 0 else ((middle, high), (low, middle)))
            goes = code[rows, f] <= i
            todo.append((left[at], rows[goes], level + 1, *bounds[0]))
            todo.append((right[at], rows[~goes], level + 1, *bounds[1]))
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(roots),
                 depth, start)


def train(stats: DataFrame, labels: DataFrame, sample: int = 20_000) -> Trees | None:
    """Trees for ``labels.quality`` from at most about ``sample`` labelled rows of the statistics; None without both classes."""
    known = stats.join(labels.filter("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("__label")), "doc_id")
    rows = bounded_sample(known, "doc_id", sample).select("doc_id", "features", "__label").collect()
    rows.sort(key=lambda r: (r.doc_id, r.features))
    y = np.array([float(r["__label"] > 0) for r in rows])
    if not len(y) or y.min() == y.max():
        return None
    return fit_trees(np.array([r.features for r in rows]), y, list(FEATURES.values()))


def quality_verdicts(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, least_words: int = 50) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept and the trees' score.

    Null text has no words and fails the base rules. Without labels of both classes the base rules decide alone (score
    null). Repeated rows repeat; a doc_id labelled twice counts as good if any label says so; empty input gives no rows.
    """
    stats = cut(document_statistics(docs))
    trees = train(stats, labels)

    def one(batch):
        out = {n: batch.column(n) for n in ("doc_id", *BASE)}
        n, repeats = (np.asarray(batch.column(c)) for c in ("n_words", "n_repeat_words"))
        failed = (n < least_words) | (100 * repeats > 50 * n)
        if trees is None:
            return out | {"base_failed": failed, "kept": ~failed, "score": pa.nulls(batch.num_rows, pa.float64())}
        x = np.asarray(batch.column("features").values).reshape(batch.num_rows, -1)
        parts = [trees.score(x[low:low + 4000]) for low in range(0, len(x), 4000)]
        score = np.concatenate(parts) if parts else np.zeros(0)
        return out | {"base_failed": failed, "kept": ~failed & (score >= threshold), "score": score}

    return map_rows(stats, one, "doc_id bigint, " + ", ".join(f"{n} bigint" for n in BASE)
                    + ", base_failed boolean, kept boolean, score double", None)
