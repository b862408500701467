"""Quality by histogram gradient-boosted trees over document statistics.

Statistics are computed for whole batches of texts in numpy. Trees are grown level by level on
quantile bins of a bounded sample of labelled rows, and kept as flat arrays (statistic, threshold,
children, value) that score all texts of a batch by one indexed step per level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import labels as lab
from tidewatch.llm.flat import SPACES, pieces, prefix, small_batches, span_hash, sums, words

FIT_ROWS = 50_000  # labelled rows that the trees are grown on, at most about
BINS, DEPTH, TREES, RATE, LEAF, RIDGE = 64, 4, 60, 0.15, 5.0, 1.0

# Byte classes of the statistics, as lists of bytes.
CLASSES = {
    "upper": [*range(65, 91)],
    "lower": [*range(97, 123)],
    "digit": [*range(48, 58)],
    "space": [*SPACES],
    "line": [10],
    "stop": [33, 46, 63],
    "comma": [44, 58, 59],
    "mark": [33],
    "pipe": [124],
    "symbol": [35, 36, 37, 38, 42, 60, 61, 62, 64, 91, 92, 93, 94, 95, 123, 125, 126],
    "high": [*range(128, 256)],
}
NAMES = ["bytes", "words", "word_bytes", "word_spread", "longest_word", "distinct_words", "repeated_pairs", "repeated_words", "words_a_line", "words_a_sentence",
         *[f"{c}_share" for c in CLASSES], "capitals_a_word", "distinct_bytes"]


@dataclass
class Model:
    statistic: np.ndarray  # per node, -1 in leaves
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float


def _distinct(keys: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Number of distinct keys between the bounds ``own``."""
    of = np.repeat(np.arange(len(own) - 1), np.diff(own))
    order = np.lexsort((keys, of))
    k, o = keys[order], of[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=len(own) - 1)


def statistics(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Texts x statistics, in the order of NAMES; an empty text has zeros."""
    n_bytes = np.diff(bounds).astype(float)
    inside = np.ones(256, bool)
    inside[list(SPACES)] = False
    starts, ends, own = words(data, bounds, inside)
    n_words = np.diff(own).astype(float)
    length = (ends - starts).astype(float)
    per_byte, per_word = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    mean = sums(length, own) / per_word
    spread = np.sqrt(np.maximum(sums(length ** 2, own) / per_word - mean ** 2, 0))
    longest = np.zeros(len(n_words))
    full = np.flatnonzero(n_words)
    if len(full):
        longest[full] = np.maximum.reduceat(length, own[:-1][full])
    h = span_hash(prefix(data), starts, ends)
    distinct = _distinct(h, own)
    follows = np.zeros(len(h), bool)  # the same word as the one before it, in the same text
    follows[1:] = h[1:] == h[:-1]
    follows[own[:-1][own[:-1] < len(h)]] = False
    pairs = h.copy()
    pairs[:-1] = h[:-1] * np.uint64(3) + h[1:]
    last = own[1:][n_words > 0] - 1
    pairs[last] = 0  # no pair begins with the last word
    n_pairs = np.maximum(n_words - 1, 1)
    distinct_pairs = np.maximum(_distinct(pairs, own) - 1, 0)
    out = {"bytes": np.log1p(n_bytes), "words": np.log1p(n_words), "word_bytes": mean, "word_spread": spread, "longest_word": np.log1p(longest),
           "distinct_words": distinct / per_word, "repeated_pairs": 1 - distinct_pairs / n_pairs, "repeated_words": sums(follows.astype(float), own) / per_word}
    shares = {}
    for name, members in CLASSES.items():
        table = np.zeros(256, np.uint8)
        table[members] = 1
        shares[name] = sums(table[data], bounds, np.float64)
    out["words_a_line"] = n_words / (shares["line"] + 1)
    out["words_a_sentence"] = n_words / (shares["stop"] + 1)
    for name in CLASSES:
        out[f"{name}_share"] = shares[name] / per_byte
    out["capitals_a_word"] = shares["upper"] / per_word
    used = np.unique(np.repeat(np.arange(len(n_bytes)), np.diff(bounds)) * 256 + data)
    out["distinct_bytes"] = np.bincount(used // 256, minlength=len(n_bytes)).astype(float)
    stats = np.column_stack([out[c] for c in NAMES])
    stats[n_bytes == 0] = 0
    return stats


def grow(x: np.ndarray, y: np.ndarray) -> Model:
    """Boosted trees for labels 0 and 1 under the logistic loss."""
    base_rate = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(base_rate / (1 - base_rate)))
    nodes: list[list[float]] = []
    roots = []
    if 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
        z = np.full(len(y), base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            g, h = y - p, p * (1 - p)
            root = len(nodes)
            roots.append(root)
            nodes.append([-1, 0, 0, 0, 0])
            level, at = [root], np.full(len(y), root)
            for depth in range(DEPTH + 1):
                slot = np.full(len(nodes), -1)
                slot[level] = np.arange(len(level))
                of = slot[at]
                live = of >= 0
                k = len(level)
                gs, hs = np.bincount(of[live], g[live], k), np.bincount(of[live], h[live], k)
                best = np.full(k, 1e-6)
                pick = np.full((k, 2), -1)
                for f in range(len(bins)) if depth < DEPTH else ():
                    key = of[live] * BINS + bins[f][live]
                    gl = np.bincount(key, g[live], k * BINS).reshape(k, BINS).cumsum(axis=1)[:, :-1]
                    hl = np.bincount(key, h[live], k * BINS).reshape(k, BINS).cumsum(axis=1)[:, :-1]
                    gr, hr = gs[:, None] - gl, hs[:, None] - hl
                    gain = gl ** 2 / (hl + RIDGE) + gr ** 2 / (hr + RIDGE) - (gs ** 2 / (hs + RIDGE))[:, None]
                    gain[(hl < LEAF / 4) | (hr < LEAF / 4)] = -1
                    gain[:, len(cuts[f]):] = -1
                    j = gain.argmax(axis=1)
                    better = gain[np.arange(k), j] > best
                    best[better] = gain[np.arange(k), j][better]
                    pick[better] = np.column_stack([np.full(k, f), j])[better]
                nxt = []
                for i, node in enumerate(level):
                    nodes[node][4] = RATE * gs[i] / (hs[i] + RIDGE)
                    if pick[i, 0] >= 0:
                        f, j = pick[i]
                        nodes[node][:4] = [f, cuts[f][j], len(nodes), len(nodes) + 1]
                        nxt += [len(nodes), len(nodes) + 1]
                        nodes.extend([[-1, 0, 0, 0, 0], [-1, 0, 0, 0, 0]])
                        mine = at == node
                        at[mine] = np.where(bins[f][mine] <= j, nodes[node][2], nodes[node][3])
                level = nxt
                if not level:
                    break
            z += np.array([n[4] for n in nodes])[at]
    flat = np.array(nodes, float).reshape(-1, 5)
    return Model(flat[:, 0].astype(int), flat[:, 1], flat[:, 2].astype(int), flat[:, 3].astype(int), flat[:, 4], np.array(roots, int), base)


def probability(model: Model, x: np.ndarray) -> np.ndarray:
    """Probability of label 1: every text walks all trees at once, one level a step."""
    if not len(model.roots):
        return np.full(len(x), 1 / (1 + np.exp(-model.base)))
    at = np.repeat(model.roots[None, :], len(x), axis=0)
    rows = np.arange(len(x))[:, None]
    for _ in range(DEPTH):
        f = model.statistic[at]
        down = np.where(x[rows, np.maximum(f, 0)] <= model.threshold[at], model.left[at], model.right[at])
        at = np.where(f >= 0, down, at)
    return 1 / (1 + np.exp(-(model.base + model.value[at].sum(axis=1))))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held: int = 0, most: int = FIT_ROWS) -> Model:
    """The model from labelled documents outside the held-out fold, about ``most`` at most: their statistics come to the driver."""
    small_batches(docs)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, bounds in pieces(b.column(0)):
                x = np.column_stack([statistics(data, bounds), b.column(1).to_numpy()[i:j], b.column(2).to_numpy()[i:j]])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in x.T], [f"x{k}" for k in range(x.shape[1])])

    train = lab.training_rows(docs, labels, label, folds, held, most)
    schema = ", ".join(f"x{k} double" for k in range(len(NAMES) + 2))
    got = train.select("text", "label", "doc_id").mapInArrow(run, schema).toArrow()
    x = np.column_stack([c.to_numpy() for c in got.columns]) if got.num_rows else np.zeros((0, len(NAMES) + 2))
    x = x[np.argsort(x[:, -1], kind="stable")]  # by id: sums don't depend on the order of tasks
    return grow(x[:, :-2], x[:, -2])


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) per document. Null and empty texts have all statistics 0 and get a score; repeated rows get equal ones."""
    small_batches(docs)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, bounds in pieces(b.column(1)):
                p = probability(model, statistics(data, bounds))
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
