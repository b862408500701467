"""Isolation forest (K3): a sample per tree from all rows, trees grown one per task, rows scored in Spark."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.quantile import exact_quantiles
from tidewatch.plans.staging import stage

TREES, SAMPLE = 100, 256
SPREAD = 1 << 62


def _path_correction(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary search tree of n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    out = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, out, np.where(n == 2, 1.0, 0.0))


def _grow(tree: int, x: np.ndarray, seed: int) -> list[tuple]:
    """Nodes (tree, node, feature, cut, left, right, value); leaves carry their path length."""
    rng = np.random.default_rng([seed, tree])
    limit = max(1, ceil(log2(max(len(x), 2))))
    nodes: list[tuple] = []
    stack = [(0, np.arange(len(x)), 0)]
    used = 1
    while stack:
        node, rows, depth = stack.pop()
        sub = x[rows]
        spread = np.flatnonzero(sub.max(axis=0) > sub.min(axis=0)) if len(rows) > 1 else np.array([], dtype=int)
        if depth >= limit or not len(spread):
            nodes.append((tree, node, -1, 0.0, -1, -1, float(depth + _path_correction(len(rows)))))
            continue
        f = int(rng.choice(spread))
        cut = float(rng.uniform(sub[:, f].min(), sub[:, f].max()))
        go_left = sub[:, f] <= cut
        left, right, used = used, used + 1, used + 2
        nodes.append((tree, node, f, cut, left, right, 0.0))
        stack += [(left, rows[go_left], depth + 1), (right, rows[~go_left], depth + 1)]
    return nodes


NODE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, value double"


def fit_forest(df: DataFrame, row_key: Sequence[str], cols: Sequence[str], trees: int = TREES, sample: int = SAMPLE,
               seed: int = 42) -> tuple[DataFrame, int]:
    """Tree nodes (at most trees x (2 sample - 1) rows) and the sample size per tree.

    Rows are drawn by a hash of their key and the tree, straight from the table, so that each row is as
    likely as any other and a repeated task draws the same rows.
    """
    n = df.count()
    per_tree = min(sample, n)
    # Three times the wanted share leaves the per-tree ranking a few hundred rows.
    share = min(1.0, 3.0 * per_tree / max(n, 1)) if n > 4 * per_tree else 1.0
    drawn = lambda t: F.pmod(F.xxhash64(*row_key, t, F.lit(seed)), F.lit(SPREAD))
    picked = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: drawn(t) < int(SPREAD * share))
    draws = df.select(*row_key, F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"), F.explode(picked).alias("tree")).withColumn("_h", drawn(F.col("tree")))
    ranked = draws.withColumn("_r", F.row_number().over(Window.partitionBy("tree").orderBy("_h", *row_key)))
    picked = ranked.filter(F.col("_r") <= per_tree).select("tree", "_x")

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf["_x"].tolist(), dtype=float)
        x = x[np.lexsort(x.T[::-1])]  # the draw does not depend on arrival order
        return pd.DataFrame(_grow(int(pdf["tree"].iloc[0]), x, seed),
                            columns=["tree", "node", "feature", "cut", "left", "right", "value"])

    return stage(picked.groupBy("tree").applyInPandas(grow, NODE_SCHEMA), "forest"), per_tree


def score_forest(df: DataFrame, cols: Sequence[str], nodes: DataFrame, per_tree: int, name: str = "score") -> DataFrame:
    """Adds the anomaly score 2^(-mean path / expected path), higher being more isolated."""
    table = nodes.toPandas()  # bounded: trees x (2 sample - 1) nodes
    forest = []
    for _, t in table.groupby("tree"):
        t = t.sort_values("node")
        forest.append(tuple(t[c].to_numpy() for c in ("feature", "cut", "left", "right", "value")))
    packed = df.sparkSession.sparkContext.broadcast(forest)
    expected = float(_path_correction(per_tree)) or 1.0

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees = packed.value
        for columns in parts:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            depth, rows = np.zeros(len(x)), np.arange(len(x))
            for feature, cut, left, right, value in trees:
                at = np.zeros(len(x), dtype=np.int64)
                while True:
                    f = feature[at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    go = x[rows, np.maximum(f, 0)] <= cut[at]
                    at = np.where(inner, np.where(go, left[at], right[at]), at)
                depth += value[at]
            yield pd.Series(2.0 ** (-(depth / len(trees)) / expected))

    return df.withColumn(name, score(*[F.col(c).cast("double") for c in cols]))


def isolation_outliers(df: DataFrame, row_key: Sequence[str], cols: Sequence[str], contamination: float = 0.1,
                       seed: int = 42, trees: int = TREES, sample: int = SAMPLE) -> DataFrame:
    """Adds iso_score and is_outlier_iso: scores above their (1 - contamination) quantile."""
    df = stage(df, "rows")  # read by the count, the draws and the scores
    nodes, per_tree = fit_forest(df, row_key, cols, trees, sample, seed)
    scored = stage(score_forest(df, cols, nodes, per_tree, "iso_score"), "scored")
    cut = exact_quantiles(scored, [], "iso_score", {"cut": 1.0 - contamination}).select("cut").scalar()
    return scored.withColumn("is_outlier_iso", F.col("iso_score") > cut)
