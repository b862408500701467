"""Density clustering (K2): DBSCAN labels and noise as grid joins.

Equal points are merged into one point with a weight. Space is cut into cells whose
diagonal is just under eps, so that

* a cell of weight >= min_samples is all core, without looking at any pair;
* every other cell has fewer than min_samples points, so the joins that count
  neighbours or find the nearest core point pair each point of a crowded cell with a
  bounded number of others (surrounding cells x min_samples), never with its own crowd;
* clusters are connected components of cells, and whether two cells touch is decided
  by bounding boxes, split further only where a box pair is undecided.

That holds for up to three columns. With more, cells would have too many neighbours, and a tree of balls takes
their place (``cover``). Clusters are numbered alike: in the order of their smallest core points.

The input is written once, so that verdicts and rows are of one evaluation; keys may be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.cover import by_cover
from tidewatch.plans.chunks import match, one_key
from tidewatch.plans.staging import drop, scratch, stage, stage_at

CELL_DIMS = 3
SIDE_SLACK = 1 - 1e-9
PAIR_BUDGET = 1024  # point pairs of one cell pair that are compared directly


def _coords(prefix: str, d: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(d)]


def _total(terms: Sequence[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def _dist2(a: Sequence[str], b: Sequence[str]) -> Column:
    return _total([(F.col(p) - F.col(q)) * (F.col(p) - F.col(q)) for p, q in zip(a, b)])


def _around(frame: DataFrame, cells: Sequence[str], reach: int, names: Sequence[str]) -> DataFrame:
    """One row per neighbour cell within ``reach`` along each axis, in columns ``names``."""
    for c, n in zip(cells, names):
        frame = frame.withColumn(n, F.explode(F.sequence(F.col(c) - reach, F.col(c) + reach)))
    return frame


def _probe(points: DataFrame, keys: list[str], d: int, reach: int, side: float, eps: float,
           columns: Sequence[str]) -> DataFrame:
    """One row per (point, cell that can hold a neighbour): the point in q*, the cell in c*.
    Cells out of reach are dropped axis by axis."""
    limit = eps * eps * (1 + 1e-6)
    rows = points.select(*keys, *columns, *[F.col(x).alias(q) for x, q in zip(_coords("x", d), _coords("q", d))],
                         *[F.col(c).alias(f"_{c}") for c in _coords("c", d)])
    gap = F.lit(0.0)
    for c, q in zip(_coords("c", d), _coords("q", d)):
        rows = rows.withColumn(c, F.explode(F.sequence(F.col(f"_{c}") - reach, F.col(f"_{c}") + reach)))
        lo = F.col(c).cast("double") * F.lit(side)
        away = F.greatest(lo - F.col(q), F.col(q) - lo - F.lit(side), F.lit(0.0))
        gap = gap + away * away
        rows = rows.filter(gap <= limit)
    return rows.drop(*[f"_{c}" for c in _coords("c", d)])


def _cell(x: str, side: float) -> Column:
    return F.floor(F.col(x) / F.lit(side)).cast("bigint")


def _part(x: str, cell: str, side: float, scale: int) -> Column:
    """The cell's part that holds x, cells being cut into ``scale`` (a power of two) along each axis; parts nest exactly."""
    return F.col(cell) * F.lit(scale) + F.floor((F.col(x) / F.lit(side) - F.col(cell)) * F.lit(float(scale))).cast("bigint")


def _touching_cells(core: DataFrame, keys: list[str], d: int, eps: float, side: float, reach: int) -> DataFrame:
    """Pairs (keys, a*, b*) of cells that hold core points within eps of each other."""
    xs, cs = _coords("x", d), _coords("c", d)
    split = 4 if d <= 2 else 2
    eps2 = eps * eps

    def boxes(points: DataFrame, by: list[str]) -> DataFrame:
        point = F.struct(*xs)
        return points.groupBy(*keys, *by).agg(
            F.count(F.lit(1)).alias("n"), *[F.min(x).alias(f"lo_{x}") for x in xs],
            *[F.max(x).alias(f"hi_{x}") for x in xs], F.min(point).alias("rep"))

    def side_of(frame: DataFrame, prefix: str, keep: Sequence[str]) -> DataFrame:
        fields = ["n", "rep", *[f"lo_{x}" for x in xs], *[f"hi_{x}" for x in xs]]
        return frame.select(*keys, *keep, F.struct(*fields).alias(f"{prefix}box"))

    def judged(pairs: DataFrame) -> DataFrame:
        """verdict: true = touching, false = apart, NULL = undecided."""
        a, b = F.col("a_box"), F.col("b_box")
        near, far = [], []
        for x in xs:
            gap = F.greatest(a[f"lo_{x}"] - b[f"hi_{x}"], b[f"lo_{x}"] - a[f"hi_{x}"], F.lit(0.0))
            reach_ = F.greatest(a[f"hi_{x}"] - b[f"lo_{x}"], b[f"hi_{x}"] - a[f"lo_{x}"])
            near.append(gap * gap)
            far.append(reach_ * reach_)
        rep = _total([(a["rep"][x] - b["rep"][x]) * (a["rep"][x] - b["rep"][x]) for x in xs])
        verdict = (F.when((_total(far) <= eps2) | (rep <= eps2), True).when(_total(near) > eps2, False))
        return pairs.withColumn("verdict", verdict)

    a_cells, b_cells = _coords("a", d), _coords("b", d)
    cells = stage(boxes(core, cs), "cells")
    later = F.struct(*b_cells) > F.struct(*cs)  # each pair of cells once
    left = side_of(_around(cells, cs, reach, b_cells).filter(later), "a_",
                   [*[F.col(c).alias(a) for a, c in zip(a_cells, cs)], *b_cells])
    right = side_of(cells, "b_", [F.col(c).alias(b) for b, c in zip(b_cells, cs)])
    pairs = stage(judged(left.join(right, on=[*keys, *b_cells])), "pairs")
    ids = [*keys, *a_cells, *b_cells]
    found = [pairs.filter(F.col("verdict")).select(*ids)]

    # Undecided pairs: compare points where that is cheap, split both boxes where it is not.
    work = pairs.filter(F.col("verdict").isNull()).select(
        *ids, *[F.col(a).alias(f"s{a}") for a in a_cells], *[F.col(b).alias(f"s{b}") for b in b_cells],
        (F.col("a_box")["n"] * F.col("b_box")["n"]).alias("_pairs"))
    level = 0
    while not work.isEmpty():
        scale = split**level
        placed = core.withColumns({f"p{i}": _part(x, c, side, scale) for i, (x, c) in enumerate(zip(xs, cs))})
        at = _coords("p", d)
        as_a = placed.select(*keys, *[F.col(p).alias(f"s{a}") for p, a in zip(at, a_cells)], *[F.col(x).alias(f"u{i}") for i, x in enumerate(xs)])
        as_b = placed.select(*keys, *[F.col(p).alias(f"s{b}") for p, b in zip(at, b_cells)], *[F.col(x).alias(f"v{i}") for i, x in enumerate(xs)])
        s_a, s_b = [f"s{a}" for a in a_cells], [f"s{b}" for b in b_cells]
        direct = (
            work.filter(F.col("_pairs") <= PAIR_BUDGET).join(as_a, on=[*keys, *s_a]).join(as_b, on=[*keys, *s_b])
            .filter(_dist2(_coords("u", d), _coords("v", d)) <= eps2).select(*ids).distinct()
        )
        found.append(stage(direct, "touching"))
        wide = work.filter(F.col("_pairs") > PAIR_BUDGET)
        level += 1
        if wide.isEmpty():
            break
        fine = split**level
        finer = core.withColumns({f"p{i}": _part(x, c, side, fine) for i, (x, c) in enumerate(zip(xs, cs))})
        parts = stage(boxes(finer, at).withColumns({f"up{i}": F.floor(F.col(f"p{i}") / split).cast("bigint") for i in range(d)}), "parts")
        sub_a = side_of(parts, "a_", [*[F.col(f"up{i}").alias(s) for i, s in enumerate(s_a)], *[F.col(p).alias(f"f{s}") for p, s in zip(at, s_a)]])
        sub_b = side_of(parts, "b_", [*[F.col(f"up{i}").alias(s) for i, s in enumerate(s_b)], *[F.col(p).alias(f"f{s}") for p, s in zip(at, s_b)]])
        next_pairs = stage(judged(wide.join(sub_a, on=[*keys, *s_a]).join(sub_b, on=[*keys, *s_b])), "parts")
        sure = stage(next_pairs.filter(F.col("verdict")).select(*ids).distinct(), "touching")
        found.append(sure)
        work = next_pairs.filter(F.col("verdict").isNull()).join(sure, on=ids, how="left_anti").select(
            *ids, *[F.col(f"f{s}").alias(s) for s in (*s_a, *s_b)],
            (F.col("a_box")["n"] * F.col("b_box")["n"]).alias("_pairs"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components: (node, label), label being the smallest node reached.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so long chains shrink by half; it ends when no label changes.
    """
    spark = nodes.sparkSession
    both, both_path = stage_at(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels, path = stage_at(nodes.select("node", F.col("node").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near"))
        step = labels.join(near, on="node", how="left").select("node", F.col("label").alias("_old"), F.least("label", F.coalesce("_near", "label")).alias("_new"))
        jump = labels.select(F.col("node").alias("_new"), F.col("label").alias("_far"))
        nxt, nxt_path = stage_at(step.join(jump, on="_new").select("node", "_old", F.least("_new", "_far").alias("label")), "labels")
        changed = not nxt.filter(F.col("_old") != F.col("label")).isEmpty()
        drop(spark, path)
        labels, path = nxt.select("node", "label"), nxt_path
        if not changed:
            drop(spark, both_path)
            return labels


def dbscan(df: DataFrame, keys: Sequence[str], cols: Sequence[str], eps: float = 0.5, min_samples: int = 5,
           labels: bool = True) -> DataFrame:
    """Adds is_core, is_noise and (with ``labels``) cluster: -1 for noise, else 0, 1, ...
    per series in the order of each cluster's smallest core point.
    Rows with a NULL or NaN among ``cols`` have NULL verdicts."""
    cols = list(cols)
    d = len(cols)
    if not d:
        raise ValueError("no columns to cluster on")
    added = ["is_core", "is_noise", "cluster"] if labels else ["is_core", "is_noise"]
    if d > CELL_DIMS:
        return _by_balls(df, keys, cols, eps, min_samples, labels, added)
    xs = [f"_x{i}" for i in range(d)]
    rows = stage(df.withColumns({x: F.col(c).cast("double") for x, c in zip(xs, cols)}), "rows")
    keyed, key = one_key(rows, keys)
    whole = F.lit(True)
    for x in xs:
        whole = whole & F.col(x).isNotNull() & ~F.isnan(x)
    whole = F.coalesce(whole, F.lit(False))
    with scratch(df.sparkSession):
        points = keyed.filter(whole).groupBy(*key, *[F.col(x).alias(f"x{i}") for i, x in enumerate(xs)]).agg(F.count(F.lit(1)).alias("w"))
        found = stage(_by_cells(points, key, d, eps, min_samples, labels), "verdicts", keep=True)
    found = found.withColumnsRenamed({f"x{i}": x for i, x in enumerate(xs)})
    done = keyed.filter(whole).join(found, on=[*key, *xs]).select(*df.columns, *added)
    kinds = {c: found.schema[c].dataType for c in added}
    return done.unionByName(keyed.filter(~whole).select(*df.columns, *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()]))


def _hash(*cols: str) -> Column:
    return F.xxhash64(*cols)


def _by_balls(df: DataFrame, keys: Sequence[str], cols: list[str], eps: float, min_samples: int, labels: bool, added: list[str]) -> DataFrame:
    """``dbscan`` of more than three columns. Rows keep a number, so that they aren't joined on their coordinates, and these go as
    4-byte numbers where that is exact. Points are grouped only where two rows share a hash."""
    spark = df.sparkSession
    keyed, key = one_key(stage(df.withColumn("_row", F.monotonically_increasing_id()), "rows"), keys)
    xs = [F.col(c).cast("double") for c in cols]
    whole = F.lit(True)
    for x in xs:
        whole = whole & F.coalesce(x.isNotNull() & ~F.isnan(x), F.lit(False))
    with scratch(spark):
        points = keyed.filter(whole).select(*key, F.col("_row").alias("id"), F.array(*[x + F.lit(0.0) for x in xs]).alias("v"))  # -0.0 is 0.0
        if points.filter(F.exists("v", lambda x: x.cast("float").cast("double") != x)).isEmpty():
            points = points.withColumn("v", F.col("v").cast("array<float>"))
        hashed = points.withColumn("hash", _hash(*key, "v"))
        alias = None
        if hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            points = points.select(*key, "id", F.lit(1).cast("long").alias("w"), "v")
        else:
            merged = stage(hashed.groupBy(*key, "v", "hash").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("w")), "merged")
            if merged.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
                alias = hashed.select("hash", "id").join(merged.select("hash", "first"), "hash")
            else:
                alias = match(hashed, merged.select(*key, "v", "first"), [*key, "v"])
            alias = stage(alias.filter("id <> first").select("id", "first"), "alias")
            points = merged.select(*key, F.col("first").alias("id"), "w", "v")
        verdicts = by_cover(points, key, len(cols), eps, min_samples, labels, components)
        if alias is not None:
            verdicts = stage(verdicts, "firsts")
            verdicts = verdicts.unionByName(alias.join(verdicts.withColumnRenamed("id", "first"), "first").drop("first"))
        found = stage(verdicts.withColumnRenamed("id", "_row"), "verdicts", keep=True)
    return keyed.join(found, "_row", "left").select(*df.columns, *added)


def _by_cells(points: DataFrame, keys: list[str], d: int, eps: float, min_samples: int, labels: bool) -> DataFrame:
    """Verdicts (keys, x*, is_core, is_noise, cluster) of different points in up to three dimensions."""
    side = eps / sqrt(d) * SIDE_SLACK
    reach = ceil(eps / side)
    xs, cs, qs = _coords("x", d), _coords("c", d), _coords("q", d)
    eps2 = eps * eps
    points = stage(points.withColumns({c: _cell(x, side) for c, x in zip(cs, xs)}), "points")
    crowd = points.groupBy(*keys, *cs).agg(F.sum("w").alias("cw"))
    points = points.join(crowd, on=[*keys, *cs])
    crowded = points.filter(F.col("cw") >= min_samples).select(*keys, *xs, *cs, "w")
    thin = points.filter(F.col("cw") < min_samples).select(*keys, *xs, *cs, "w")
    pool = points.select(*keys, *cs, *xs, "w")
    counted = (
        _probe(thin, keys, d, reach, side, eps, ["w"]).withColumnRenamed("w", "_w0")
        .join(pool, on=[*keys, *cs]).filter(_dist2(qs, xs) <= eps2)
        .groupBy(*keys, *qs).agg(F.sum("w").alias("_near"))
        .select(*keys, *[F.col(q).alias(x) for q, x in zip(qs, xs)], "_near")
    )
    thin = stage(thin.join(counted, on=[*keys, *xs], how="left"), "thin")
    core = stage(crowded.unionByName(thin.filter(F.col("_near") >= min_samples).drop("_near")), "core")
    loose = thin.filter(~(F.coalesce("_near", F.lit(0)) >= min_samples)).drop("_near")

    def node(names: list[str]) -> Column:
        return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"n{i}") for i, c in enumerate(names)])

    if labels:
        cells = core.groupBy(*keys, *cs).agg(F.min(F.struct(*xs)).alias("_p"))
        pairs = _touching_cells(core, keys, d, eps, side, reach)
        parts = components(cells.select(node(cs).alias("node")),
                           pairs.select(node(_coords("a", d)).alias("a"), node(_coords("b", d)).alias("b")))
        named = stage(cells.withColumn("node", node(cs)).join(parts, on="node"), "components")
        order = named.groupBy(*keys, "label").agg(F.min("_p").alias("_first"))
        number = Window.partitionBy(*keys).orderBy("_first")
        ids = order.select(*keys, "label", (F.row_number().over(number) - 1).alias("cluster"))
        cell_ids = named.join(ids, on=[*keys, "label"]).select(*keys, *cs, "cluster")
        core = core.join(cell_ids, on=[*keys, *cs])
    else:
        core = core.withColumn("cluster", F.lit(0))
    border = (
        _probe(loose, keys, d, reach, side, eps, [])
        .join(core.select(*keys, *cs, *xs, "cluster"), on=[*keys, *cs]).filter(_dist2(qs, xs) <= eps2)
        .groupBy(*keys, *qs).agg(F.min("cluster").alias("cluster"))
        .select(*keys, *[F.col(q).alias(x) for q, x in zip(qs, xs)], "cluster")
    )
    rest = loose.join(border, on=[*keys, *xs], how="left").select(
        *keys, *xs, F.lit(False).alias("is_core"), F.col("cluster").isNull().alias("is_noise"),
        F.coalesce("cluster", F.lit(-1)).alias("cluster"))
    verdicts = core.select(*keys, *xs, F.lit(True).alias("is_core"), F.lit(False).alias("is_noise"), "cluster").unionByName(rest)
    return verdicts
