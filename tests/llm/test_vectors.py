"""Centroid clusters and vector codes against SQL and plain numpy."""

import hashlib
import random

import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import types as T

from tidewatch.llm import centroids, codes
from tidewatch.llm.queries import QUERIES, SQL

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
                       T.StructField("cluster", T.StringType()), T.StructField("key", T.DoubleType()), T.StructField("x", T.StringType()), T.StructField("codes", T.StringType())])


@pytest.fixture(scope="module")
def vectors_of(spark):
    def make(rows):
        """Rows (vec_id, vector, label); the other columns have names that the operators use themselves."""
        return spark.createDataFrame([(i, v, label, "c", 0.5, "x", "k") for i, v, label in rows], SCHEMA)

    return make


@pytest.mark.parametrize("name", ["op11_centroid_clusters", "op12_vector_codes"])
def test_queries_match_sql(spark, sf, name):
    assert compare(spark, connect(sf), QUERIES[name], SQL[name], sf)[0] == "ok"


def mixed_rows(n=400, dims=8):
    """Clumps, a vector that a third of the rows share, ties, repeated rows, rows to leave out."""
    rnd = random.Random(3)
    middles = [[rnd.uniform(-1, 1) for _ in range(dims)] for _ in range(12)]
    rows = [(i, [m + rnd.gauss(0, 0.05) for m in rnd.choice(middles)], rnd.choice([None, 1, 2])) for i in range(n)]
    rows += [(1000 + i, [0.25] * dims, 1) for i in range(n // 2)]
    rows += [rows[0], rows[0], (5, [0.5] * dims, None), (None, [0.125] * dims, 2), (None, [-0.5] * dims, None)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.1] * (dims - 1), 1), (2003, [0.1] * (dims - 1) + [None], 1),
             (2004, [float("nan")] + [0.1] * (dims - 1), 1), (2005, [float("-inf")] + [0.1] * (dims - 1), 1)]
    return rows


def whole(rows, scale, dims):
    out = []
    for i, v, label in rows:
        if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v):
            out.append((i, [int(np.floor(scale * c)) for c in v], label))
    return out


def lloyd(rows, k, rounds, scale, dims):
    rows = whole(rows, scale, dims)
    name = lambda i: (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest(), i or 0)
    seeds = [v for _, v in sorted(((name(i), v) for i, v, _ in rows))][:k]
    x, c = np.array([v for _, v, _ in rows]), np.array(seeds)
    for r in range(rounds + 1):
        d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        own = d.argmin(axis=1)
        if r < rounds:
            c = np.array([x[own == j].sum(axis=0) // (own == j).sum() if (own == j).any() else c[j] for j in range(len(c))])
    far = d[np.arange(len(x)), own]
    sha = [hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest() for row in c]
    return sorted(((i, int(j), int(f), int(far[own == j].sum()), int(far.sum()), sha[j]) for (i, _, _), j, f in zip(rows, own, far)), key=str)


@pytest.mark.parametrize("k,rounds", [(16, 3), (5, 8), (1, 2)])
def test_clusters_against_plain_rounds(vectors_of, k, rounds):
    rows = mixed_rows()
    got = centroids.cluster(vectors_of(rows), k=k, rounds=rounds, scale=64, dims=8)
    assert sorted((tuple(r) for r in got.collect()), key=str) == lloyd(rows, k, rounds, 64, 8)


def test_clusters_of_little(vectors_of):
    assert centroids.cluster(vectors_of([])).count() == 0
    few = [(1, [0.5] * 8, 1), (2, [0.5] * 8, 1), (3, None, 1)]
    assert sorted(map(tuple, centroids.cluster(vectors_of(few), dims=8).collect())) == lloyd(few, 16, 3, 64, 8)


def test_only_due_vectors_are_rescanned(vectors_of, monkeypatch):
    """Two far clumps: after a move within a clump no gap has expired."""
    rnd = random.Random(1)
    rows = [(i, [(i % 2) * 100 + rnd.random() for _ in range(4)], None) for i in range(200)]
    written = []
    keep = centroids.stage_at
    monkeypatch.setattr(centroids, "stage_at", lambda df, tag: written.append(keep(df, tag)) or written[-1])
    monkeypatch.setattr(centroids, "drop", lambda *_: None)
    got = centroids.cluster(vectors_of(rows), k=2, rounds=3, dims=4)
    assert sorted(map(tuple, got.collect()), key=str) == lloyd(rows, 2, 3, 64, 4)
    sizes = [df.count() for df, _ in written]
    assert sizes[0] == 200 and (sizes[1:] == [0, 0, 0] or len({r[1] for r in lloyd(rows, 2, 0, 64, 4)}) == 1 or sum(sizes[2:]) == 0)


def test_large_components_are_exact_or_refused(vectors_of):
    rows = [(i, [1e6 + i * 0.5, -1e6, 3.0, float(i % 3)], None) for i in range(40)]
    got = centroids.cluster(vectors_of(rows), k=4, rounds=3, dims=4)
    assert sorted(map(tuple, got.collect()), key=str) == lloyd(rows, 4, 3, 64, 4)
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(vectors_of([(1, [1e300] * 4, None)]), dims=4).collect()


def coded(rows, parts, entries, rounds, scale, dims):
    rows = whole(rows, scale, dims)
    x = np.array([v for _, v, _ in rows]).reshape(len(rows), parts, -1)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = x[first].transpose(1, 0, 2).copy()
    for r in range(rounds + 1):
        d = ((x[:, :, None, :] - books[None, :, :, :]) ** 2).sum(axis=3)
        own = d.argmin(axis=2)
        if r < rounds:
            for p in range(parts):
                for e in range(len(first)):
                    if (own[:, p] == e).any():
                        books[p, e] = x[own[:, p] == e, p].sum(axis=0) // (own[:, p] == e).sum()
    error = d.min(axis=2).sum(axis=1)
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    per = {}
    for (_, _, label), e in zip(rows, error):
        per[label] = per.get(label, 0) + int(e)
    return sorted(((i, "".join(f"{c:02x}" for c in code), int(e), label, per[label], sha) for (i, _, label), code, e in zip(rows, own, error)), key=str)


@pytest.mark.parametrize("values", [8192, 64])
def test_codes_against_plain_rounds(vectors_of, monkeypatch, values):
    """With 64 values a dimension most components are outside the dictionary."""
    monkeypatch.setattr(codes, "VALUES", values)
    rows = mixed_rows()
    got = codes.encode(vectors_of(rows), parts=4, entries=6, rounds=4, scale=4096, dims=8)
    assert sorted((tuple(r) for r in got.collect()), key=str) == coded(rows, 4, 6, 4, 4096, 8)


def test_codes_of_little(vectors_of):
    assert codes.encode(vectors_of([])).count() == 0
    few = [(2, [0.5] * 8, 1), (2, [0.25] * 8, None), (None, [1.0] * 8, None), (3, None, 1)]
    assert sorted((tuple(r) for r in codes.encode(vectors_of(few), dims=8, parts=2).collect()), key=str) == coded(few, 2, 16, 6, 4096, 8)
    with pytest.raises(ValueError):
        codes.encode(vectors_of(few), dims=9)
