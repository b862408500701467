"""Toxic passages as maximum-scoring segments over token log-odds.

Every token has a score: the log-odds of its use in toxic against other texts, less a small drift. The Dirichlet
prior of a word is what its longest beginning says, whose prior is the next shorter beginning, down to the share of
all uses; so an unseen word scores as its beginning does.
All maximal segments of a text (Ruzzo and Tompa) are found in one scan. The score that the best one of
a clean text of n tokens reaches by chance follows an extreme-value law; what a segment exceeds it by
gives its significance and, through a logistic fit on texts that the scores weren't learned from, the text's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import labels as lab
from tidewatch.llm.flat import pieces, prefix, small_batches, span_hash, sums, words

BUCKETS = 1 << 20
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes
PRIOR = 30.0  # texts that a prior weighs
DRIFT, LOWEST, HIGHEST = 0.1, -1.0, 8.0
SIGNIFICANT = 0.01  # expected segments as good in a clean text
LEAST, BENDS, MOST = -4.0, (5.0, 9.0, 14.0), 30.0  # the excess is held between the ends, and weighs differently between the bends

_inside = np.zeros(256, bool)
_inside[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    counts: tuple[np.ndarray, np.ndarray, np.ndarray] = field(default_factory=lambda: packed(np.zeros(1), np.zeros(1)))
    rate: float = 1.0
    log_k: float = 0.0
    beta: tuple[float, ...] = (-30.0, *[0.0] * (len(BENDS) + 1))


def token_buckets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a column of buckets per beginning and last for the word, per token; bounds of the texts in it)."""
    starts, ends, own = words(data, bounds, _inside)
    run = prefix(data)
    word = span_hash(run, starts, ends) ^ np.uint64(0x5BD1E9955BD1E995)
    cols = []
    for n in BEGINNINGS:
        longer = ends - starts > n
        h = word.copy()
        h[longer] = span_hash(run, starts[longer], starts[longer] + n)
        cols.append(h)
    return (np.column_stack([*cols, word]) >> np.uint64(44)).astype(np.int32), own


def packed(clean: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets in use with their counts: what is sent to the tasks."""
    used = np.flatnonzero((clean > 0) | (toxic > 0)).astype(np.int32)
    return used, clean[used].astype(np.float32), toxic[used].astype(np.float32)


def unpacked(used: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros((2, BUCKETS), np.float32)
    out[0, used], out[1, used] = clean, toxic
    return out[0], out[1]


def token_scores(buckets: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Log-odds of each token, each column being the prior of the next; a shorter word has one column several times, counted once."""
    n1 = float(toxic.sum(dtype=np.float64)) + 1
    base = n1 / (n1 + float(clean.sum(dtype=np.float64)) + 1)
    q = np.full(len(buckets), base)
    for k in range(buckets.shape[1]):
        b = buckets[:, k]
        t = toxic[b]
        nxt = (t + PRIOR * q) / (t + clean[b] + PRIOR)
        q = nxt if not k else np.where(b == buckets[:, k - 1], q, nxt)
    return np.clip(np.log(q / (1 - q)) - np.log(base / (1 - base)) - DRIFT, LOWEST, HIGHEST)


def segments(values: list[float], gaps: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of positive ``values`` with ``gaps[i]`` (0 or less) before value i."""
    lefts, rights, firsts, lasts, links = [], [], [], [], []
    total = 0.0
    for i, v in enumerate(values):
        total += gaps[i]
        left, first = total, i
        total += v
        right = total
        j = len(lefts) - 1
        while True:
            while j >= 0 and lefts[j] >= left:
                j = links[j]
            if j < 0 or rights[j] >= right:
                break
            left, first = lefts[j], firsts[j]
            del lefts[j:], rights[j:], firsts[j:], lasts[j:]
            k = links[j]
            del links[j:]
            j = k
        lefts.append(left)
        rights.append(right)
        firsts.append(first)
        lasts.append(i)
        links.append(j)
    return [(f, e, r - x) for f, e, r, x in zip(firsts, lasts, rights, lefts)]


def text_segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """Maximal segments (start, end, score) of one text's token scores, ends exclusive."""
    up = np.flatnonzero(score > 0)
    if not len(up):
        return []
    run = np.concatenate(([0.0], np.cumsum(score, dtype=np.float64)))
    gaps = run[up] - run[np.concatenate(([0], up[:-1] + 1))]
    return [(int(up[a]), int(up[b]) + 1, s) for a, b, s in segments(score[up].astype(float).tolist(), gaps.tolist())]


def _scored(column: pa.Array, clean: np.ndarray, toxic: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(row, token scores) of every text."""
    for i, _, data, bounds in pieces(column):
        buckets, own = token_buckets(data, bounds)
        s = token_scores(buckets, clean, toxic)
        # a word's first use in a text counts; again and again the same word is no further evidence
        text = np.repeat(np.arange(len(own) - 1, dtype=np.int64), np.diff(own))
        first = np.unique((text << 20) | buckets[:, -1], return_index=True)[1]
        again = np.ones(len(s), bool)
        again[first] = False
        s[again] = np.minimum(s[again], -DRIFT)
        for k in range(len(own) - 1):
            yield i + k, s[own[k]: own[k + 1]]


def _counts(train: DataFrame) -> np.ndarray:
    """Texts that use each bucket by (half, label): one sum over the table, at most ``BUCKETS`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, BUCKETS), np.int64)
        for b in batches:
            kind = b.column(1).to_numpy() + 2 * b.column(2).to_numpy()
            for i, j, data, bounds in pieces(b.column(0)):
                buckets, own = token_buckets(data, bounds)
                text = np.repeat(np.arange(j - i, dtype=np.int64), np.diff(own))
                seen = np.unique((text[:, None] << 20) | buckets)
                of = kind[i:j][seen >> 20]
                for k in range(4):
                    total[k] += np.bincount(seen[of == k] & (BUCKETS - 1), minlength=BUCKETS)
        used = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *[pa.array(t[used]) for t in total]], ["bucket", "c0", "c1", "c2", "c3"])

    rows = train.select("text", "label", "half").mapInArrow(run, "bucket int, c0 long, c1 long, c2 long, c3 long")
    got = rows.groupBy("bucket").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(4)]).toArrow()
    out = np.zeros((4, BUCKETS))
    at = got.column("bucket").to_numpy()
    for i in range(4):
        out[i, at] = got.column(f"c{i}").to_numpy()
    return out


def _rate(hist: np.ndarray, centers: np.ndarray) -> float:
    """The positive root of sum p(s) exp(rate s) = 1."""
    p = hist / max(1, hist.sum())
    if not (p[centers > 0].sum() > 0 and (p * centers).sum() < 0):
        return 1.0
    low, high = 1e-3, 1.0
    while (p * np.exp(high * centers)).sum() < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(mid * centers)).sum() < 1 else (low, mid)
    return high


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held: int = 0, most: int = lab.TRAIN_ROWS) -> Model:
    """The model from labelled documents outside the held-out fold, at most about ``most`` of them.

    Each half of them is scored by what the other half teaches, to set the extreme-value law and the
    logistic fit; the final scores come from both. Without any label all scores are 0.
    """
    small_batches(docs)
    train = lab.training_rows(docs, labels, label, folds, held, most).withColumn("text", F.lower("text"))
    c = _counts(train)
    if not c.any():
        return Model()
    c = c.astype(np.float32)
    halves = [packed(c[2], c[3]), packed(c[0], c[1])]  # for half 0: learned from half 1
    edges = np.linspace(LOWEST, HIGHEST, 181)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [unpacked(*h) for h in halves]
        for b in batches:
            best, n, y, hist = [], [], [], np.zeros(180, np.int64)
            for h in (0, 1):
                part = b.filter(pa.array(b.column(2).to_numpy() == h))
                for row, s in _scored(part.column(0), *counts[h]):
                    found = text_segments(s)
                    best.append(max((x[2] for x in found), default=0.0))
                    n.append(len(s))
                    y.append(part.column(1)[row].as_py())
                    if not y[-1]:
                        hist += np.histogram(s, edges)[0]
            at = np.flatnonzero(hist)  # the histogram travels as rows with label -1
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([best, at]), pa.float64()), pa.array(np.concatenate([n, hist[at]]), pa.float64()),
                                              pa.array(np.concatenate([y, np.full(len(at), -1)]), pa.float64())], ["best", "n", "y"])

    rows = train.select("text", "label", "half").mapInArrow(run, "best double, n double, y double")
    rows = rows.groupBy(F.when(F.col("y") < 0, -1).otherwise(F.monotonically_increasing_id()).alias("g"), "best", "y").agg(F.sum("n").alias("n"))
    got = rows.select("best", "n", "y").toArrow()  # at most ``most`` rows and the histogram
    best, n, y = (got.column(x).to_numpy() for x in ("best", "n", "y"))
    hist = np.zeros(180)
    np.add.at(hist, best[y < 0].astype(int), n[y < 0])
    best, n, y = best[y >= 0], n[y >= 0], y[y >= 0]
    rate = _rate(hist, (edges[1:] + edges[:-1]) / 2)
    clean = y == 0
    # the median of the law is (log(k n) - log log 2) / rate
    log_k = float(np.median(rate * best[clean] - np.log(np.maximum(n[clean], 1)))) + np.log(np.log(2)) if clean.any() else 0.0
    model = Model(packed(c[0] + c[2], c[1] + c[3]), rate, log_k)
    x = excess(model, best, n)
    if 0 < y.sum() < len(y):
        model.beta = rising(bent(x), y)
    else:
        model.beta = (30.0 if len(y) and y[0] else -30.0, *[0.0] * (len(BENDS) + 1))
    return model


def bent(x):
    """The part of the excess below the first bend, between two bends, and above the last one, as columns."""
    edges = (LEAST, *BENDS, MOST)
    return np.stack([np.clip(x, a, b) - a for a, b in zip(edges, edges[1:])], axis=-1)


def rising(parts: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """A logistic fit that never falls: parts that would weigh less than nothing are left out one by one."""
    used = list(range(parts.shape[1]))
    while True:
        beta = lab.logistic(parts[:, used], y)
        if not used or beta[1:].min() >= 0:
            out = np.zeros(parts.shape[1])
            out[used] = beta[1:]
            return (float(beta[0]), *out.tolist())
        used.pop(int(beta[1:].argmin()))


def excess(model: Model, best, n):
    """Minus the log of the segments as good that chance brings, held between LEAST and MOST."""
    return np.clip(model.rate * best - np.log(np.maximum(n, 1)) - model.log_k, LEAST, MOST)


def _verdict(model: Model, s: np.ndarray) -> tuple[float, int]:
    found = text_segments(s)
    x = [float(excess(model, f[2], len(s))) for f in found]
    top = max(x, default=float(excess(model, 0.0, len(s))))
    z = model.beta[0] + float(bent(top) @ np.array(model.beta[1:]))
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30)))), sum(v >= -np.log(SIGNIFICANT) for v in x)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, score, predicted, n_passages (significant segments). Null and empty texts have no token and get a score."""
    small_batches(docs)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.lower(F.col(text)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = unpacked(*model.counts)
        for b in batches:
            got = [_verdict(model, s) for _, s in _scored(b.column(1), *counts)]
            p = np.array([g[0] for g in got], float)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array([g[1] for g in got], pa.int32())],
                                             ["doc_id", "score", "predicted", "n_passages"])

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double, predicted int, n_passages int")


def passages(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Significant segments: doc_id, first and end (token positions), segment_score, expected (as good ones in a clean text of this length)."""
    small_batches(docs)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.lower(F.col(text)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = unpacked(*model.counts)
        for b in batches:
            rows = [(i, *f, float(np.exp(-excess(model, f[2], len(s))))) for i, s in _scored(b.column(1), *counts) for f in text_segments(s)]
            rows = [r for r in rows if r[4] <= SIGNIFICANT]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
                                              pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.float64())], ["doc_id", "first", "end", "segment_score", "expected"])

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, first int, end int, segment_score double, expected double")


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the rows that the model calls toxic (score 0.5 or more); columns as they were, and nothing is shuffled."""
    small_batches(docs)
    lowered = docs.select(*[F.lower(F.col(f"`{text}`")).alias("_lower"), *[F.col(f"`{c}`") for c in docs.columns]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = unpacked(*model.counts)
        for b in batches:
            keep = [_verdict(model, s)[0] < 0.5 for _, s in _scored(b.column(0), *counts)]
            yield pa.RecordBatch.from_arrays(b.columns[1:], names=b.schema.names[1:]).filter(pa.array(keep, pa.bool_()))

    return lowered.mapInArrow(run, docs.schema)
