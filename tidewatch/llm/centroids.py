"""Exact k-means over integer vectors, with bounds kept in heaps per cluster.

A vector is in the heap of its cluster under the gap between its distance to the nearest other centroid
and the distance to its own. When centroids move, every gap of a cluster shrinks by what its own centroid
and the fastest other one have moved; the cluster adds that up as its drift. A vector enters at gap plus
drift so far, so it is due when the drift has reached its key, and nobody touches it before.

The heap of a cluster is a set of sorted runs. A round writes one run: the vectors it has popped, with their
new clusters and keys, in key order. What is due lies in one range of keys of each earlier run, which the
scan finds by the runs' statistics; runs are never changed, and a vector is alive in one run only. Sums of
centroids change by the vectors that changed clusters. All sums are of integers, so results are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.plans.staging import drop, stage, stage_at

LIMIT = 1 << 27  # larger components (after scaling) are an error: a squared distance of 64 of them is no long
SLACK = 1e-9  # of the distances, against rounding of roots


def whole_vectors(rows: DataFrame, id_col: str, vector: str, scale: int, dims: int) -> DataFrame:
    """(vec_id, x): vectors of ``dims`` finite components as floor(scale * component)."""
    v = F.col(vector)
    good = (F.size(v) == dims) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    whole = F.transform(v, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    beyond = F.exists("x", lambda c: F.abs(c) > LIMIT)
    kept = rows.select(F.col(id_col).alias("vec_id"), whole.alias("x"), F.coalesce(good, F.lit(False)).alias("_good")).filter("_good").select("vec_id", "x")
    return kept.select("vec_id", F.when(beyond, F.raise_error(F.lit("a component is too large for exact distances")))
                       .otherwise(F.col("x")).cast("array<int>").alias("x"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dims)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``x`` to rows of ``c``: by products where doubles hold every sum, else one by one."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * top * top * max(1, x.shape[1]) < 1 << 53:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    return np.stack([((x.astype(np.int64) - row.astype(np.int64)) ** 2).sum(axis=1) for row in c], axis=1)


def ranked(x: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row (ties: smaller number), and the drift of that cluster at which the row is due again.

    A key is above the drift so far, so that live rows of a run are those above it.
    """
    d = squared(x, centroids)
    own = d.argmin(axis=1)
    at = np.arange(len(x))
    upper = np.sqrt(d[at, own].astype(np.float64))
    rest = d.copy()
    rest[at, own] = np.iinfo(np.int64).max
    lower = np.sqrt(rest.min(axis=1).astype(np.float64)) if len(centroids) > 1 else np.full(len(x), np.inf)
    gap = lower - upper - SLACK * (1.0 + upper + np.where(np.isinf(lower), 0.0, lower))
    return own.astype(np.int32), np.maximum(gap + drift[own], np.nextafter(drift[own], np.inf))


def _placed(rows: DataFrame, centroids: np.ndarray, drift: np.ndarray, kind: str, was: bool) -> DataFrame:
    """(vec_id, x, was, cluster, key) of rows, ordered as a run of heaps."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            own, key = ranked(matrix(b.column(1), dims), centroids, drift)
            before = b.column(2) if was else pa.array(np.full(b.num_rows, -1, np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), before, pa.array(own), pa.array(key)], ["vec_id", "x", "was", "cluster", "key"])

    return rows.mapInArrow(run, f"vec_id {kind}, x array<int>, was int, cluster int, key double").sortWithinPartitions("cluster", "key")


def _sums(moved: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Change of counts and of component sums per cluster by the rows that changed theirs."""
    sides = F.array(F.struct(F.col("cluster").alias("c"), F.lit(1).alias("s")), F.struct(F.col("was").alias("c"), F.lit(-1).alias("s")))
    both = moved.filter("was != cluster").select("x", F.explode(sides).alias("e")).filter("e.c >= 0").select("x", "e.c", "e.s")
    total = both.groupBy("c").agg(F.sum("s").alias("n"), *[F.sum(F.get("x", F.lit(i)).cast("long") * F.col("s")).alias(f"x{i}") for i in range(dims)])
    n, x = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
    for r in total.collect():  # one row per cluster
        n[r[0]], x[r[0]] = r[1], r[2:]
    return n, x


def _between(lo: np.ndarray | None, hi: np.ndarray | None) -> Column:
    """Keys above ``lo`` of their cluster and not above ``hi``, in a form that a Parquet scan uses to skip what isn't due."""
    out = F.lit(False)
    for c in range(len(hi if hi is not None else lo)):
        term = F.col("cluster") == c
        if lo is not None:
            term = term & (F.col("key") > float(lo[c]))
        if hi is not None:
            term = term & (F.col("key") <= float(hi[c]))
        out = out | term
    return out


def cluster(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3, scale: int = 64,
            dims: int = 64, seed: int = 1) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of ``dims`` components, none null or non-finite; other columns aren't read. The first centroids
    are the ``k`` vectors of the smallest sha256 of "seed:id", by id and then by components where that is tied (no id:
    last); fewer vectors make fewer centroids. Each round assigns all vectors, ties to the smaller number, and moves each
    centroid to the floor of its vectors' mean; an empty cluster keeps its centroid. Repeated rows each count. An empty
    table gives no rows.
    """
    vectors = whole_vectors(rows, id_col, vector, scale, dims)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(name.alias("h"), "vec_id", "x").orderBy(F.asc_nulls_last("h"), "vec_id", "x").limit(k).collect()
    if not first:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
                              F.lit("").alias("centroid_sha256"))
    centroids = np.array([r["x"] for r in first], np.int64)
    k = len(centroids)
    drift, before = np.zeros(k), None
    run, path = stage_at(_placed(vectors, centroids, drift, kind, False), "heaps")
    runs, paths = [run], [path]
    n, x = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
    for _ in range(rounds):
        dn, dx = _sums(runs[-1], k, dims)
        n, x = n + dn, x + dx
        moved = np.where(n[:, None] > 0, x // np.maximum(n, 1)[:, None], centroids)
        step = np.sqrt(((moved - centroids).astype(np.float64) ** 2).sum(axis=1)) * (1 + SLACK)
        fastest = np.array([np.delete(step, c).max(initial=0.0) for c in range(k)])
        centroids, before, drift = moved, drift, drift + step + fastest
        due = None
        for i, r in enumerate(runs):
            part = r.filter(_between(None if i == len(runs) - 1 else before, drift)).select("vec_id", "x", F.col("cluster").alias("was"))
            due = part if due is None else due.unionByName(part)
        run, path = stage_at(_placed(due, centroids, drift, kind, True), "heaps")
        runs.append(run)
        paths.append(path)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(2).to_numpy()
            d = ((matrix(b.column(1), dims).astype(np.int64) - centroids[own]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(d)], ["vec_id", "cluster", "distance"])

    live = None
    for i, r in enumerate(runs):
        part = (r if i == len(runs) - 1 else r.filter(_between(drift, None))).select("vec_id", "x", "cluster")
        live = part if live is None else live.unionByName(part)
    done = stage(live.mapInArrow(final, f"vec_id {kind}, cluster int, distance long"), "clustered")
    drop(rows.sparkSession, *paths)
    per = {r[0]: r[1] for r in done.groupBy("cluster").agg(F.sum("distance")).collect()}  # one row per cluster
    inertia = F.create_map(*[F.lit(v) for c in range(k) for v in (c, per.get(c, 0))])
    digest = F.create_map(*[F.lit(v) for c in range(k) for v in (c, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())])
    return done.select("vec_id", "cluster", "distance", inertia[F.col("cluster")].cast("long").alias("cluster_inertia"),
                       F.lit(sum(per.values())).cast("long").alias("inertia"), digest[F.col("cluster")].alias("centroid_sha256"))
