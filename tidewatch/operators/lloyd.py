"""K-means of many groups in one job (K1).

Seeds come from k-means++ on at most about ``SEED_ROWS`` rows of a group, drawn by a hash; a smaller group gives all its
rows. Then Lloyd rounds: every start of every group is moved in the same pass, each stops when it no longer moves, and the
cheapest start of a group names its clusters. Centroids are joined to blocks of rows and their sums added up by (group,
start, cluster), so no row moves between rounds. A group that is one block is solved where it lies, by the same rounds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.clean import standardize
from tidewatch.plans.chunks import attach
from tidewatch.plans.staging import drop, scratch, stage, stage_at

SEED_ROWS, BLOCK_ROWS = 2048, 4096
ROUNDS, STILL = 100, 1e-4  # rounds at most, and the move of a centroid that counts as none


def _rows(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(float)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids, one centroid at a time."""
    return np.stack([((x - m) ** 2).sum(axis=1) for m in c], axis=1)


def _seeds(x: np.ndarray, k: int, seed: int, starts: int) -> np.ndarray:
    """k-means++ seeds (start, cluster, column); with fewer different rows than clusters seeds repeat."""
    out = np.empty((starts, k, x.shape[1]))
    for s in range(starts):
        rng = np.random.default_rng((seed, s))
        out[s, 0] = x[rng.integers(len(x))]
        near = ((x - out[s, 0]) ** 2).sum(axis=1)
        for j in range(1, k):
            total = near.sum()
            out[s, j] = x[int(np.searchsorted(np.cumsum(near), rng.random() * total, side="right").clip(0, len(x) - 1)) if total > 0 else rng.integers(len(x))]
            near = np.minimum(near, ((x - out[s, j]) ** 2).sum(axis=1))
    return out


def _sums(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    d = _distances(x, c)
    own = d.argmin(axis=1)
    member = (own[:, None] == np.arange(len(c))[None, :]).astype(float)
    return member.sum(axis=0), member.T @ x, float(d[np.arange(len(x)), own].sum())


def _moved(c: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, bool]:
    """Centroids at their rows' means; empty ones stay."""
    out = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return out, bool(((out - c) ** 2).sum(axis=1).max() <= STILL**2)


def _in_order(c: np.ndarray) -> np.ndarray:
    """Centroids by their first column, then the next, so that numbers don't depend on the start."""
    return c[np.lexsort(c.T[::-1])]


def _solve(x: np.ndarray, k: int, seed: int, starts: int) -> np.ndarray:
    best, least = None, np.inf
    for c in _seeds(x, k, seed, starts):
        for _ in range(ROUNDS):
            n, total, _ = _sums(x, c)
            c, still = _moved(c, n, total)
            if still:
                break
        cost = _sums(x, c)[2]
        if cost < least:
            best, least = c, cost
    return _in_order(best)


def grouped_kmeans(df: DataFrame, keys: Sequence[str], cols: Sequence[str], k: int = 4, seed: int = 42, n_init: int = 10,
                   label: str = "cluster") -> DataFrame:
    """K1 for every group of ``keys`` at once: labels on columns standardized within the group, numbered by centroid.

    The label is NULL for rows with a missing coordinate and in groups with fewer than ``k`` whole rows. NULL keys are a group.
    """
    spark, keys, cols = df.sparkSession, list(keys), list(cols)
    d = len(cols)
    rows, _ = stage_at(df.withColumn("_row", F.monotonically_increasing_id()), "kmeans")
    whole = F.lit(True)
    for c in cols:
        whole = whole & F.coalesce(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")), F.lit(False))
    with scratch(spark):
        known = rows.filter(whole)
        sizes = stage(known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= k).withColumn("_g", F.monotonically_increasing_id()), "groups")
        z = standardize(known, cols, keys, "_z").select(*keys, "_row", F.array(*[F.col(f"{c}_z").cast("double") for c in cols]).alias("v"))
        vectors = stage(attach(z, sizes, keys).filter(F.col("_g").isNotNull()).select("_g", "_n", "_row", "v"), "vectors")

        def alone(table: pa.Table) -> pa.Table:
            x = _rows(table["v"], d)
            order = np.argsort(table["_row"].to_numpy())
            own = _distances(x, _solve(x[order], k, seed, n_init)).argmin(axis=1)
            return pa.table([table["_row"], pa.array(own.astype(np.int32))], ["_row", "_label"])

        small = vectors.filter(F.col("_n") <= BLOCK_ROWS).select("_g", "_row", "v").groupBy("_g").applyInArrow(alone, "_row long, _label int")
        large = vectors.filter(F.col("_n") > BLOCK_ROWS)
        if not large.isEmpty():
            small = small.unionByName(_in_rounds(large, d, k, seed, n_init))
        labels = stage(small, "labels", keep=True).withColumnsRenamed({"_row": "_of", "_label": label})
    return rows.join(labels, F.col("_row") == F.col("_of"), "left").select(*df.columns, label)


def _in_rounds(vectors: DataFrame, d: int, k: int, seed: int, starts: int) -> DataFrame:
    """(_row, _label) of groups of several blocks."""
    def seeded(table: pa.Table) -> pa.Table:
        x = _rows(table["v"], d)[np.argsort(table["_row"].to_numpy())]
        c = _seeds(x, k, seed, starts)
        return pa.table([table["_g"][:1], pa.array([c.tobytes()], pa.binary()), pa.array([np.ones(starts, bool).tobytes()], pa.binary()),
                         pa.array([np.full(starts, np.inf).tobytes()], pa.binary())], ["_g", "c", "moves", "cost"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = b.column(0).to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(g)) + 1, [len(g)])) if len(g) else [0]
            parts = [(int(g[i]), _rows(b.column(1)[i:j], d).tobytes()) for i, j in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int64()), pa.array([p[1] for p in parts], pa.binary())], ["_g", "x"])

    spread = F.xxhash64("_row")
    dealt = vectors.select("_g", "v", spread.alias("h")).repartitionByRange("_g", "h").sortWithinPartitions("_g").select("_g", "v")
    blocks = stage(dealt.mapInArrow(packed, "_g long, x binary"), "blocks")
    drawn = vectors.filter(F.pmod(spread, F.lit(1 << 30)) < (F.lit(float(SEED_ROWS << 30)) / F.col("_n")).cast("long"))
    state = "_g long, c binary, moves binary, cost binary"
    cents, path = stage_at(drawn.select("_g", "_row", "v").groupBy("_g").applyInArrow(seeded, state), "centroids")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                x, c = np.frombuffer(r["x"]).reshape(-1, d), np.frombuffer(r["c"]).reshape(starts, k, d)
                for s in np.flatnonzero(np.frombuffer(r["moves"], bool)):
                    n, total, cost = _sums(x, c[s])
                    out += [(r["_g"], int(s), j, n[j], cost if j == 0 else 0.0, total[j].tolist()) for j in range(k)]
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["_g", "s", "j", "n", "cost", "total"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                c, cost = np.frombuffer(r["c"]).reshape(starts, k, d).copy(), np.frombuffer(r["cost"]).copy()
                moves = np.frombuffer(r["moves"], bool).copy()
                per: dict[int, list] = {}
                for e in r["all"] or ():
                    per.setdefault(e["s"], []).append(e)
                for s, entries in per.items():
                    entries.sort(key=lambda e: e["j"])
                    c[s], still = _moved(c[s], np.array([e["n"] for e in entries]), np.array([e["total"] for e in entries]))
                    cost[s], moves[s] = sum(e["cost"] for e in entries), not still
                out.append((r["_g"], c.tobytes(), moves.tobytes(), cost.tobytes()))
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), *[pa.binary()] * 3])], ["_g", "c", "moves", "cost"])

    spark = vectors.sparkSession
    for _ in range(ROUNDS):
        live = cents.filter(F.instr(F.hex("moves"), "01") > 0)
        if live.isEmpty():
            break
        part = blocks.join(live.select("_g", "c", "moves"), "_g").mapInArrow(sums, "_g long, s int, j int, n double, cost double, total array<double>")
        added = part.groupBy("_g", "s", "j").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(d)]).alias("total"))
        per = added.groupBy("_g").agg(F.collect_list(F.struct("s", "j", "n", "cost", "total")).alias("all"))  # starts x clusters entries
        was = path
        cents, path = stage_at(cents.join(per, "_g", "left").mapInArrow(step, state), "centroids")
        drop(spark, was)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = [_in_order(np.frombuffer(r["c"]).reshape(starts, k, d)[int(np.frombuffer(r["cost"]).argmin())]) for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.tobytes() for m in c], pa.binary())], ["_g", "c"])

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, own = _rows(b.column(1), d), np.zeros(b.num_rows, np.int32)
            c = b.column(2).to_pylist()
            cuts = np.concatenate(([0], [i for i in range(1, len(c)) if c[i] is not c[i - 1] and c[i] != c[i - 1]], [len(c)])).astype(int)
            for i, j in zip(cuts[:-1], cuts[1:]):
                if j > i:
                    own[i:j] = _distances(x[i:j], np.frombuffer(c[i]).reshape(k, d)).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own)], ["_row", "_label"])

    chosen = stage(cents.select("_g", "c", "moves", "cost").mapInArrow(best, "_g long, c binary"), "chosen")
    return vectors.join(chosen, "_g").select("_row", "v", "c").mapInArrow(labelled, "_row long, _label int")
