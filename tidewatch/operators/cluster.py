"""K-means, PCA, cluster quality and cluster insights."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.constants import INTERPRETATION, QUALITY_BANDS, QUALITY_DEFAULT
from tidewatch.operators.clean import standardize
from tidewatch.operators.lloyd import grouped_kmeans
from tidewatch.plans.chunks import attach, match, with_position
from tidewatch.plans.staging import stage


def _assembled(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=name).transform(df)


def scaled(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> tuple[DataFrame, list[str]]:
    return standardize(df, cols, suffix=suffix), [f"{c}{suffix}" for c in cols]


def kmeans(df: DataFrame, cols: Sequence[str], k: int = 4, seed: int = 42, n_init: int = 10,
           label: str = "cluster", keys: Sequence[str] = ()) -> DataFrame:
    """K1: labels on standardized columns, for every group of ``keys`` in one job. Of ``n_init`` starts, which run side by
    side, the cheapest wins; labels are numbered by centroid, so that they do not depend on the start's order. With fewer rows
    than ``k`` a group has no model: its labels are NULL (``eligibility`` tells the reason)."""
    return grouped_kmeans(df, keys, cols, k, seed, n_init, label)


def pca(df: DataFrame, cols: Sequence[str], components: int = 2, standard: bool = True) -> DataFrame:
    """K4: adds pca1.. of the standardized (or only centered) columns. The largest loading of
    each component is positive. One column gives (x, 0, 0)."""
    cols = list(cols)
    z, zs = scaled(df, cols)
    if not standard:
        means = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols])
        z = attach(df, means, []).withColumns({f"{c}_z": F.col(c) - F.col(f"_m_{c}") for c in cols})
    wanted = [f"pca{i + 1}" for i in range(components)]
    k = min(components, len(cols))
    if len(cols) == 1:
        return z.withColumns({"pca1": F.col(zs[0]), **{w: F.lit(0.0) for w in wanted[1:]}}).select(*df.columns, *wanted)
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(_assembled(z, zs, "_v"))
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, i]).argmax(), i] >= 0 else -1.0 for i in range(k)]
    out = model.transform(_assembled(z, zs, "_v")).withColumn("_a", vector_to_array("_p"))
    values = {w: F.get(F.col("_a"), F.lit(i)) * F.lit(signs[i]) if i < k else F.lit(0.0) for i, w in enumerate(wanted)}
    return out.withColumns(values).select(*df.columns, *wanted)


def _sq(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v)


def _as_array(cols: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


TILE = 1024  # clusters, or points against points, that a task holds of either side
PART, PARTS = 32768, 16  # points of a part; parts of a group whose parts would otherwise be larger than a tile
PART_VALUES = 1 << 21  # coordinates of a part, which has fewer points in many columns
SQUARE = 384  # points of the tiles whose distances are computed at once
SUMS = 1 << 23  # sums of distances that a task holds
CLOSE = 1e-5  # squared distances below this share of the squared norms are taken by differences


def _described(df: DataFrame, keys: list[str], label: str, cols: Sequence[str]) -> DataFrame:
    """Per cluster (g, k): size, mean, mean distance and mean squared distance from it, and its tile of at most TILE clusters."""
    x = df.select(_group(keys), F.col(label).alias("k"), _as_array(cols).alias("x"))
    mean = x.groupBy("g", "k").agg(F.count(F.lit(1)).alias("size"), F.array(*[F.avg(F.get("x", F.lit(i))) for i in range(len(cols))]).alias("mean"))
    far = x.join(mean, ["g", "k"]).select("g", "k", "size", "mean", _sq(F.col("x"), F.col("mean")).alias("d2"))
    clusters = stage(far.groupBy("g", "k").agg(F.max("size").alias("size"), F.any_value("mean").alias("mean"), F.avg(F.sqrt("d2")).alias("s"), F.avg("d2").alias("var")), "clusters")
    tiles = clusters.groupBy(F.col("g").alias("tg")).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    return clusters.join(tiles, F.col("g") == F.col("tg")).drop("tg").withColumn("tile", F.pmod(F.xxhash64("k"), F.col("tiles")).cast("int"))


def _group(keys: Sequence[str]) -> Column:
    """The keys as one value that is never NULL."""
    return (F.struct(*keys) if keys else F.lit(0)).alias("g")


def _per_group(scores: DataFrame, keys: list[str], score: Column, name: str) -> DataFrame:
    out = scores.groupBy("g").agg(score.alias(name)) if keys else scores.agg(score.alias(name))
    return out.select(*[F.col("g")[k].alias(k) for k in keys], name)


def _part(d: int) -> int:
    """Points of ``d`` columns that a task holds of either side."""
    return max(1, min(PART, PART_VALUES // d))


def _flat(column: pa.ChunkedArray, d: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def silhouette_squared(df: DataFrame, label: str, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """K5 at any scale: mean silhouette under squared Euclidean distance, without pairs of points.

    The mean squared distance from x to a cluster is |x - mean|^2 plus the cluster's mean squared spread, so counts, means and
    spreads per cluster are enough. Blocks of points meet tiles of clusters; of each a point keeps the smallest.
    """
    keys, cols = list(keys), list(cols)
    d = len(cols)
    clusters = _described(df, keys, label, cols)
    points = stage(df.select(_group(keys), F.col(label).alias("own"), _as_array(cols).alias("x"), F.monotonically_increasing_id().alias("id")), "points")
    tiles = clusters.groupBy(F.col("g").alias("tg")).agg(F.max("tiles").alias("tiles"), F.sum("size").alias("n"))
    blocks = F.ceil(F.col("n") / _part(d)).cast("int")
    asks = (points.join(tiles, F.col("g") == F.col("tg")).withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
            .select("g", "block", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), "id", "own", "x"))
    shown = (clusters.join(tiles.select("tg", blocks.alias("blocks")), F.col("g") == F.col("tg"))
             .select("g", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "tile", "k", "size", "mean", "var"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.float64(), pa.float64(), pa.int64())], ["id", "own", "other", "size"])
        x, mean = _flat(left["x"], d), _flat(right["mean"], d)
        var, size, name = right["var"].to_numpy(), right["size"].to_numpy(), right["k"].to_pylist()
        place = {k: i for i, k in enumerate(name)}
        own = np.array([place.get(k, -1) for k in left["own"].to_pylist()])
        mine, other = np.full(len(x), np.nan), np.full(len(x), np.inf)
        for j in range(len(mean)):
            far = ((x - mean[j]) ** 2).sum(axis=1) + var[j]
            mine = np.where(own == j, far, mine)
            other = np.where(own == j, other, np.minimum(other, far))
        none = np.isinf(other)
        return pa.table([left["id"], pa.array(mine, mask=own < 0), pa.array(other, mask=none), pa.array(np.where(own < 0, 0, size[own]).astype(np.int64), mask=own < 0)],
                        ["id", "own", "other", "size"])

    met = asks.groupBy("g", "block", "tile").cogroup(shown.groupBy("g", "block", "tile")).applyInArrow(meet, "id long, own double, other double, size long")
    per = met.groupBy("id").agg(F.max("own").alias("own"), F.min("other").alias("other"), F.max("size").alias("size"))
    scores = points.select("g", "id").join(per, "id")
    a = F.col("own") * F.col("size") / F.nullif(F.col("size") - 1, F.lit(0)).cast("double")
    return _per_group(scores, keys, F.avg(_score(a, F.col("other"), F.col("size"))), "silhouette").withColumn("distance", F.lit("squared"))


def _score(a: Column, b: Column, size: Column) -> Column:
    """Silhouette of a point: 0 alone in its cluster, or without another cluster."""
    s = (b - a) / F.nullif(F.greatest(a, b), F.lit(0.0))
    return F.when((size <= 1) | b.isNull(), F.lit(0.0)).otherwise(F.coalesce(s, F.lit(0.0)))


def davies_bouldin(df: DataFrame, label: str, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """K6: mean over clusters of the worst (scatter_i + scatter_j) / centroid distance. Tiles of clusters meet tiles of clusters."""
    keys, cols = list(keys), list(cols)
    d = len(cols)
    clusters = _described(df, keys, label, cols)
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    left = clusters.select("g", "tile", every.alias("to"), "k", "mean", "s")
    right = clusters.select(F.col("g").alias("g2"), every.alias("tile"), F.col("tile").alias("to"), F.col("k").alias("k2"), F.col("mean").alias("mean2"), F.col("s").alias("s2"))
    kind = clusters.schema["k"].dataType.simpleString()
    g_kind = clusters.schema["g"].dataType.simpleString()

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        top = np.full(a.num_rows, np.nan)
        if a.num_rows and b.num_rows:
            x, y, s, t = _flat(a["mean"], d), _flat(b["mean2"], d), a["s"].to_numpy(), b["s2"].to_numpy()
            name, other = a["k"].to_pylist(), b["k2"].to_pylist()
            place = {k: i for i, k in enumerate(other)}
            for i in range(len(x)):
                far = np.sqrt(((y - x[i]) ** 2).sum(axis=1))
                ratio = np.where(far > 0, (s[i] + t) / np.where(far > 0, far, 1), np.nan)
                if name[i] in place:
                    ratio[place[name[i]]] = np.nan
                if not np.isnan(ratio).all():
                    top[i] = np.nanmax(ratio)
        return pa.table([a["g"], a["k"], pa.array(top, from_pandas=True)], ["g", "k", "worst"])

    met = left.groupBy("g", "tile", "to").cogroup(right.groupBy("g2", "tile", "to")).applyInArrow(meet, f"g {g_kind}, k {kind}, worst double")
    worst = met.groupBy("g", "k").agg(F.coalesce(F.max("worst"), F.lit(0.0)).alias("worst"))
    return _per_group(worst, keys, F.avg("worst"), "davies_bouldin")


def quality(silhouette: Column, davies_bouldin_: Column) -> Column:
    """K7."""
    out = None
    for name, above, below in QUALITY_BANDS:
        hit = (silhouette > above) & (davies_bouldin_ < below)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(QUALITY_DEFAULT)


def interpretation(metric: Column, overall: Column, cluster: Column) -> Column:
    """K9."""
    out = None
    for name, bands in INTERPRETATION.items():
        for below, text in bands:
            hit = (metric == name) if below is None else (metric == name) & (overall < below)
            out = F.when(hit, text) if out is None else out.when(hit, text)
    return out.otherwise(F.format_string("Cluster %d behavior pattern", cluster))


def insights(df: DataFrame, keys: Sequence[str], label: str, cols: Sequence[str], metric: Column | None = None) -> DataFrame:
    """K8/K9: per cluster its size, the mean of its column means and of its column stds."""
    keys, n = list(keys), len(cols)
    stats = df.groupBy(*keys, label).agg(
        F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)],
        *[F.stddev_samp(c).alias(f"_s{i}") for i, c in enumerate(cols)])
    mean = sum((F.col(f"_m{i}") for i in range(1, n)), F.col("_m0")) / F.lit(float(n))
    std = sum((F.col(f"_s{i}") for i in range(1, n)), F.col("_s0")) / F.lit(float(n))
    out = stats.select(*keys, label, "size", mean.alias("avg_activity_level"), std.alias("stability"))
    who = metric if metric is not None else F.lit("")
    return out.withColumn("interpretation", interpretation(who, F.col("avg_activity_level"), F.col(label)))


def eligibility(df: DataFrame, keys: Sequence[str], needed: int) -> DataFrame:
    """Rows per series, whether they suffice, and the reason if not."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).withColumns({
        "eligible": F.col("n_rows") >= needed,
        "reason": F.when(F.col("n_rows") < needed, F.format_string("%d rows, %s needed", "n_rows", F.lit(str(needed))))})


def with_enough_rows(df: DataFrame, keys: Sequence[str], needed: int) -> DataFrame:
    """Only the series that have enough rows."""
    keys = list(keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return attach(df, sizes, keys).filter(F.col("_n") >= needed).drop("_n")


def _distances(x: np.ndarray, y: np.ndarray, held: np.ndarray) -> np.ndarray:
    """All distances of two small tiles, in the memory ``held``, from one product of matrices; pairs so close that it would cost digits are taken by differences."""
    middle = y.mean(axis=0)
    p, q = x - middle, y - middle
    n, m = (p * p).sum(axis=1), (q * q).sum(axis=1)
    d2 = np.matmul(np.column_stack((p, n, np.ones(len(p)))), np.column_stack((-2 * q, np.ones(len(q)), m)).T, out=held[:len(x) * len(y)].reshape(len(x), len(y)))
    close = CLOSE * (n.max() + m.max())
    if not d2.min() > close:
        i, j = np.nonzero(~(d2 > close))
        for k in range(0, len(i), 1 << 15):
            s = slice(k, k + (1 << 15))
            d2[i[s], j[s]] = ((x[i[s]] - y[j[s]]) ** 2).sum(axis=1)
    return np.sqrt(d2, out=d2)


def _sums(x: np.ndarray, v: np.ndarray, y: np.ndarray, w: np.ndarray, of_x: np.ndarray | None, of_y: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Per row of ``x`` the distances to the rows of ``y``, weighted by ``w`` and summed over the runs of ``y`` that begin at ``of_y``;
    if ``of_x`` is given, the same per row of ``y`` over the runs of ``x``, weighted by ``v``."""
    there, back, held = np.zeros((len(x), len(of_y))), None if of_x is None else np.zeros((len(of_x), len(y))), np.empty(SQUARE * SQUARE)

    def runs(starts: np.ndarray, a: int, e: int) -> tuple[slice, np.ndarray]:
        first, last = np.searchsorted(starts, (a, e - 1), side="right") - 1
        return slice(first, last + 1), np.maximum(starts[first:last + 1], a) - a

    for j in range(0, len(y), SQUARE):
        cols = slice(j, min(j + SQUARE, len(y)))
        names, cuts = runs(of_y, cols.start, cols.stop)
        for i in range(0, len(x), SQUARE):
            rows = slice(i, min(i + SQUARE, len(x)))
            far = _distances(x[rows], y[cols], held)
            if back is not None:
                own, own_cuts = runs(of_x, rows.start, rows.stop)
                back[own, cols] += v[rows] @ far if len(own_cuts) == 1 else np.add.reduceat(far * v[rows, None], own_cuts, axis=0)
            there[rows, names] += (far @ w[cols])[:, None] if len(cuts) == 1 else np.add.reduceat(far * w[cols], cuts, axis=1)
    return there, None if back is None else back.T


def silhouette(df: DataFrame, label: str, cols: Sequence[str], distance: str = "euclidean", keys: Sequence[str] = ()) -> DataFrame:
    """K5: mean silhouette under the ``distance`` asked for, which is told in a column; per group of ``keys``.

    The Euclidean score is defined on every point against every other. Equal points of a cluster are merged into one point with
    a weight. Points are cut into parts of at most ``PART`` (fewer in many columns) in the order of their clusters, and a task
    compares two parts, tile by tile as products of matrices. Of the clusters that lie in one part as a whole a point keeps only
    the smallest mean; sums go on only for its own cluster and for clusters cut by a part's end. The pairs grow with the
    square of the points; for tables where all pairs are too much the caller asks for "squared", which needs none.
    """
    if distance == "squared":
        return silhouette_squared(df, label, cols, keys)
    if distance != "euclidean":
        raise ValueError(f"unknown distance {distance!r}")
    keys, d = list(keys), len(cols)
    rows = df.select(_group(keys), F.col(label).alias("own"), _as_array(list(cols)).alias("x")).groupBy("g", "own", "x").agg(F.count(F.lit(1)).alias("w"))
    rows = stage(rows.select("g", "own", "x", "w", F.monotonically_increasing_id().alias("id")), "points")
    most, length = _part(d), F.ceil(F.col("n_rows") / PARTS).cast("int")
    length = F.least(F.lit(most), F.greatest(F.lit(TILE), length))
    placed = with_position(rows, ["g"], ["own", "id"]).withColumn("part", (F.col("pos") / length).cast("int"))
    sized = placed.groupBy("g", "own").agg(F.sum("w").alias("size"), F.min("part").alias("lo"), F.max("part").alias("hi"))
    named = stage(sized.select("g", "own", F.monotonically_increasing_id().alias("c"), "size", (F.col("lo") == F.col("hi")).alias("whole")), "sizes")
    points = stage(match(placed, named, ["g", "own"]).select("g", "id", "c", "size", "whole", "x", "w", "part", F.ceil(F.col("n_rows") / length).cast("int").alias("parts")), "parts")
    left = points.select("g", "part", F.explode(F.sequence(F.col("part"), F.col("parts") - 1)).alias("to"), "id", "c", "size", "whole", "x", "w")
    right = points.select(F.col("g").alias("g2"), F.explode(F.sequence(F.lit(0), F.col("part"))).alias("part"), F.col("part").alias("to"), "id", "c", "size", "whole", "x", "w")

    def side(t: pa.Table):
        """Points in the order of their clusters, where each cluster begins, and the clusters."""
        order = np.argsort(t["c"].to_numpy(), kind="stable")
        own = t["c"].to_numpy()[order]
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        return (_flat(t["x"], d)[order], t["w"].to_numpy()[order].astype(float), t["id"].to_numpy()[order], own, starts,
                t["size"].to_numpy()[order][starts], t["whole"].to_numpy(zero_copy_only=False)[order][starts])

    def told(ids, own, sums, names, sizes, whole):
        """Rows (id, cluster or -1 for the smallest mean of the whole ones, value)."""
        mine = names[None, :] == own[:, None]
        low = np.where(whole[None, :] & ~mine, sums / sizes[None, :], np.inf).min(axis=1)
        i, j = np.nonzero(mine | ~whole[None, :])
        has = np.flatnonzero(np.isfinite(low))
        return np.concatenate((ids[has], ids[i])), np.concatenate((np.full(len(has), -1), names[j])), np.concatenate((low[has], sums[i, j]))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if a.num_rows and b.num_rows:
            same = a["part"][0] == a["to"][0]
            one, two = side(a), side(b)
            if not same and len(one[0]) * len(two[4]) + len(two[0]) * len(one[4]) <= SUMS:
                there, back = _sums(*one[:2], *two[:2], one[4], two[4])
                out += [told(*one[2:4], there, two[3][two[4]], *two[5:]), told(*two[2:4], back, one[3][one[4]], *one[5:])]
            else:
                for (x, v, ids, own, *_), (y, w, _, names, starts, *of) in ((one, two),) if same else ((one, two), (two, one)):
                    step = max(1, SUMS // len(starts))
                    for i in range(0, len(x), step):
                        s = slice(i, i + step)
                        out.append(told(ids[s], own[s], _sums(x[s], v[s], y, w, None, starts)[0], names[starts], *of))
        ids, names, value = (np.concatenate(c) for c in zip(*out))
        return pa.table([pa.array(ids.astype(np.int64)), pa.array(names.astype(np.int64)), pa.array(value)], ["id", "c", "value"])

    met = left.groupBy("g", "part", "to").cogroup(right.groupBy("g2", "part", "to")).applyInArrow(meet, "id long, c long, value double")
    met = stage(met, "met")
    lows = met.filter("c < 0").groupBy("id").agg(F.min("value").alias("low"))
    cut = met.filter("c >= 0").groupBy("id", "c").agg(F.sum("value").alias("sum")).join(named.select("c", F.col("size").alias("n")), "c")
    cut = cut.join(points.select("id", F.col("c").alias("mine")), "id").groupBy("id").agg(
        F.max(F.when(F.col("c") == F.col("mine"), F.col("sum"))).alias("inside"), F.min(F.when(F.col("c") != F.col("mine"), F.col("sum") / F.col("n"))).alias("other"))
    scores = points.select("g", "id", "size", "w").join(cut, "id").join(lows, "id", "left")
    a = F.col("inside") / F.nullif(F.col("size") - 1, F.lit(0)).cast("double")
    mean = F.sum(F.col("w") * _score(a, F.least("other", "low"), F.col("size"))) / F.sum("w")
    return _per_group(scores, keys, mean, "silhouette").withColumn("distance", F.lit("euclidean"))
