"""Density clustering against brute force; properties of the seeded models; streams against batch."""

import datetime as dt
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import cluster, cover, density, detect, forest, lloyd
from tidewatch.plans.chunks import with_position
from tidewatch.streaming import live


def brute_dbscan(x, eps, m):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= eps
    core = d.sum(1) >= m
    label, comp = -np.ones(len(x), int), 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            stack = [i]
            while stack:
                j = stack.pop()
                if label[j] >= 0:
                    continue
                label[j] = comp
                stack += [n for n in np.flatnonzero(d[j] & core) if label[n] < 0]
            comp += 1
    noise = ~core & ~(d & core[None]).any(1)
    return core, noise, label


def check(spark, x, keys, eps, m):
    d = x.shape[1]
    cols = [f"f{i}" for i in range(d)]
    rows = [(str(k), i, *map(float, p)) for i, (k, p) in enumerate(zip(keys, x))]
    df = spark.createDataFrame(rows, "k string, id int, " + ", ".join(f"{c} double" for c in cols))
    out = density.dbscan(df, ["k"], cols, eps, m).toPandas().sort_values("id")
    assert len(out) == len(x)
    for k in sorted(set(keys)):
        mine = np.array([kk == k for kk in keys])
        core, noise, label = brute_dbscan(x[mine], eps, m)
        got = out[out.k == str(k)]
        assert (got.is_core.to_numpy() == core).all() and (got.is_noise.to_numpy() == noise).all()
        pairs = set(zip(label[core], got.cluster.to_numpy()[core]))
        assert len(pairs) == len(set(label[core])) == len({b for _, b in pairs})
        d_all = np.sqrt(((x[mine][:, None] - x[mine][None]) ** 2).sum(-1)) <= eps
        for i in np.flatnonzero(~core & ~noise):  # a border point belongs to a core point next to it
            near = got.cluster.to_numpy()[np.flatnonzero(d_all[i] & core)]
            assert got.cluster.to_numpy()[i] in near
        assert (got.cluster.to_numpy()[noise] == -1).all()


@pytest.mark.parametrize("d", [1, 2, 3])
def test_dbscan_matches_brute_force(spark, d):
    rng = np.random.default_rng(d)
    x = np.vstack([rng.normal(0, 0.3, (120, d)), rng.normal(4, 0.5, (80, d)), rng.uniform(-6, 10, (60, d)), np.zeros((90, d))])
    keys = ["hot" if r < 0.7 else "cold" for r in rng.random(len(x))]
    check(spark, x, keys, 0.5, 5)


def test_dbscan_decides_crowded_cells_by_boxes(spark, monkeypatch):
    """Two dense sheets a little under and a little over eps apart, with no direct comparison allowed."""
    monkeypatch.setattr(density, "PAIR_BUDGET", 1)
    rng = np.random.default_rng(9)
    a = np.column_stack([rng.uniform(0, 1, 80), rng.uniform(0, 0.02, 80)])
    for gap in (0.495, 0.53):
        b = np.column_stack([rng.uniform(0, 1, 80), rng.uniform(gap, gap + 0.02, 80)])
        check(spark, np.vstack([a, b]), ["s"] * 160, 0.5, 5)


@pytest.mark.parametrize("leaf,asks,partners", [(512, 2048, 16), (6, 4, 1)])
def test_dbscan_on_many_columns(spark, monkeypatch, leaf, asks, partners):
    """Trees of one leaf and of many, tight cells, a chain over many leaves, points apart, a copied point."""
    for name, n in (("LEAF", leaf), ("ASKS", asks), ("PARTNERS", partners)):
        monkeypatch.setattr(cover, name, n)
    rng = np.random.default_rng(3)
    chain = np.outer(np.arange(50) * 0.3, np.ones(5) / np.sqrt(5)) + 4
    x = np.vstack([rng.normal(0, 0.03, (40, 5)), rng.normal(0, 0.15, (40, 5)), rng.normal(1.5, 0.2, (40, 5)), rng.uniform(-3, 3, (30, 5)), chain, np.tile(chain[7], (6, 1))])
    order = rng.permutation(len(x))
    check(spark, x[order], ["s" if i % 3 else "t" for i in range(len(x))], 0.5, 4)


def test_dbscan_numbers_alike_in_any_number_of_columns(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(c, 0.1, (30, 2)) for c in ((2, 2), (-3, 1), (0, 5), (2, -4))])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id int, a double, b double").withColumns({"c": F.lit(0.0), "d": F.lit(1.0)})
    two = {r.id: r.cluster for r in density.dbscan(df, [], ["a", "b"], 0.5, 4).collect()}
    four = {r.id: r.cluster for r in density.dbscan(df, [], ["a", "b", "c", "d"], 0.5, 4).collect()}
    assert two == four and [two[i] for i in (30, 60, 90, 0)] in ([0, 1, 3, 2], [0, 1, 2, 3])


def test_a_dense_ball_in_many_columns_makes_no_pairs(spark, monkeypatch):
    """100,000 points within eps / 2 of their mean in 64 columns: nothing that is written has more rows than points, links or asks."""
    n, d = 100_000, 64
    rows = spark.range(n).select("id", *[(F.rand(i) * 0.05).alias(f"f{i}") for i in range(d)])
    sizes, keep = [], cover.stage

    def counted(df, tag):
        df = keep(df, tag)
        sizes.append((tag, df.count()))
        return df

    monkeypatch.setattr(cover, "stage", counted)
    got = density.dbscan(rows, [], [f"f{i}" for i in range(d)], 0.5, 5)
    assert got.agg(F.count(F.lit(1)), F.min("cluster"), F.max("cluster"), F.min("is_core")).first()[:] == (n, 0, 0, True)
    between = [size for tag, size in sizes if tag in ("pairs", "asks", "answers", "leaf-pairs", "links")]
    assert len(between) >= 6 and max(between) == 0 and max(size for _, size in sizes) == n


def by_differences(x, eps, m):
    """Core, noise and cluster numbers: by the smallest core point, a border point's the lowest next to it."""
    d = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core = d.sum(1) >= m
    label, number = -np.ones(len(x), int), 0
    for i in sorted(np.flatnonzero(core), key=lambda i: tuple(x[i])):
        todo = [i] if label[i] < 0 else []
        number += bool(todo)
        while todo:
            j = todo.pop()
            if label[j] < 0:
                label[j] = number - 1
                todo += [k for k in np.flatnonzero(d[j] & core) if label[k] < 0]
    for i in np.flatnonzero(~core & (d & core[None]).any(1)):
        label[i] = -2 - min(label[np.flatnonzero(d[i] & core)])
    return core, label == -1, np.where(label < -1, -2 - label, label)


def test_points_that_ask_many_leaves_are_not_copied(spark, monkeypatch):
    """800 points in 24 columns about eps apart, in leaves of at most 16 that are all within reach: no staged table is larger than the points."""
    import os
    from urllib.parse import unquote, urlparse

    for name, n in (("LEAF", 16), ("ASKS", 64), ("PARTNERS", 4)):
        monkeypatch.setattr(cover, name, n)
    rng = np.random.default_rng(11)
    x = rng.normal(0, 1, (800, 24))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype("f4").astype(float)
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id int, " + ", ".join(f"f{i} double" for i in range(24)))
    taken, keep = {}, cover.stage

    def measured(frame, tag):
        frame = keep(frame, tag)
        size = sum(os.path.getsize(unquote(urlparse(f).path)) for f in frame.inputFiles())
        taken[tag] = max(taken.get(tag, 0), size, 100 * frame.count())
        return frame

    monkeypatch.setattr(cover, "stage", measured)
    got = density.dbscan(df, [], [f"f{i}" for i in range(24)], 0.95, 4).toPandas().sort_values("id")
    core, noise, label = by_differences(x, 0.95, 4)
    assert 100 < core.sum() < 700 and noise.sum() > 50 and label.max() > 0
    assert (got.is_core.to_numpy() == core).all() and (got.is_noise.to_numpy() == noise).all() and (got.cluster.to_numpy() == label).all()
    assert max(taken.values()) < 3 * x.nbytes, taken


@pytest.mark.parametrize("clash", [False, True])
def test_equal_points_in_many_columns_are_one(spark, monkeypatch, clash):
    """Rows that share all coordinates count together, whether or not other rows share their hash; 0.0 and -0.0 are equal."""
    if clash:
        monkeypatch.setattr(density, "_hash", lambda *cols: F.lit(1))
    x = np.repeat(np.array([[0.0, 1, 2, 3], [5, 1, 2, 3], [9, 1, 2, 3], [9.3, 1, 2, 3], [20, 1, 2, 3]]), [4, 3, 2, 2, 1], axis=0)
    x[1, 0] = -0.0
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id int, a double, b double, c double, d double")
    got = density.dbscan(df, [], ["a", "b", "c", "d"], 0.5, 4).toPandas().sort_values("id")
    assert got.is_core.tolist() == [True] * 4 + [False] * 3 + [True] * 4 + [False]
    assert got.cluster.tolist() == [0] * 4 + [-1] * 3 + [1] * 4 + [-1]


@pytest.mark.parametrize("offset,scale", [(0.0, 1.0), (1e6, 1.0), (0.0, 1e-20), (0.0, 1e30)])
def test_products_tell_points_as_differences_do(offset, scale):
    """Pairs exactly eps apart, far from the origin, very small and very large numbers, and one infinite point."""
    rng = np.random.default_rng(4)
    x = (np.round(rng.uniform(-2, 2, (300, 6)), 1) + offset) * scale
    x[7, 2] = np.inf
    eps = 0.9 * scale
    with np.errstate(all="ignore"):
        want = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    assert (cover._Sides(x, x, eps).near(slice(0, 300), slice(0, 300)) == want).all()
    assert (cover._Sides(x[:40], x[40:], eps).near(np.arange(3, 30), slice(5, 200)) == want[3:30, 45:240]).all()


def test_dbscan_keeps_all_rows(spark):
    """Keys that look alike as text, NULL keys and NULL coordinates."""
    rows = [(a, b, i, float(i % 5) / 10, 0.0) for a, b in (("a|b", "c"), ("a", "b|c"), (None, "c"), ("c", None)) for i in range(10)]
    rows += [("a", "b|c", 99, None, 0.0), ("a", "b|c", 98, float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "p string, q string, i int, x double, y double")
    out = density.dbscan(df, ["p", "q"], ["x", "y"], 0.3, 3).collect()
    assert sorted((r.p or "", r.q or "", r.i) for r in out) == sorted((r[0] or "", r[1] or "", r[2]) for r in rows)
    assert all((r.cluster is None and r.is_noise is None) == (r.i > 90) for r in out) and all(r.cluster == 0 for r in out if r.i < 90)
    many = density.dbscan(df.withColumns({"z": F.col("x"), "w": F.col("x")}), ["p", "q"], ["x", "y", "z", "w"], 0.6, 3).collect()
    assert len(many) == len(rows) and all(r.cluster == 0 for r in many if r.i < 90)


def test_dbscan_is_of_one_evaluation(spark):
    """Sums in another order between building and reading lose no row."""
    df = spark.range(20000).select((F.col("id") % 400).alias("k"), (F.rand(5) / 3).alias("v")).groupBy("k").agg(F.avg("v").alias("x"), F.stddev("v").alias("y"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = density.dbscan(df, [], ["x", "y"], 0.01, 3)
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        assert out.count() == 400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_dbscan_leaves_two_tables(spark):
    import os

    from tidewatch.plans.staging import staging_root
    at = staging_root(spark)
    had = set(os.listdir(at)) if os.path.isdir(at) else set()
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in rng.uniform(0, 1, (150, 2))], "x double, y double")
    density.dbscan(df, [], ["x", "y"], 0.1, 3).count()
    assert len(set(os.listdir(at)) - had) == 2


def test_components_of_a_long_chain(spark):
    nodes = spark.range(60).select(F.format_string("%03d", "id").alias("node"))
    edges = spark.range(59).filter("id <> 30").select(F.format_string("%03d", "id").alias("a"), F.format_string("%03d", F.col("id") + 1).alias("b"))
    got = {r.node: r.label for r in density.components(nodes, edges).collect()}
    assert set(got.values()) == {"000", "031"} and all((l == "000") == (n <= "030") for n, l in got.items())


def blobs(spark, n=150):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(c, 0.3, (n, 2)) for c in ((0, 0), (5, 5), (0, 8))])
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id int, a double, b double"), n


def test_kmeans_finds_the_blobs_and_numbers_by_centroid(spark):
    df, n = blobs(spark)
    out = cluster.kmeans(df, ["a", "b"], 3, n_init=2).toPandas().sort_values("id")
    parts = [set(out.cluster[i * n:(i + 1) * n]) for i in range(3)]
    assert all(len(p) == 1 for p in parts) and len(set.union(*parts)) == 3
    assert parts[1] == {2}
    assert [r.cluster for r in cluster.kmeans(df.limit(2), ["a", "b"], 3).collect()] == [None, None]


def test_quality_of_good_and_bad_labels(spark):
    df, n = blobs(spark)
    good = df.withColumn("label", (F.col("id") / n).cast("int"))
    bad = df.withColumn("label", F.col("id") % 3)
    for f in (cluster.silhouette, cluster.silhouette_squared):
        assert f(good, "label", ["a", "b"]).first().silhouette > 0.8 > 0.1 > f(bad, "label", ["a", "b"]).first().silhouette
    assert cluster.davies_bouldin(good, "label", ["a", "b"]).first()[0] < 0.3
    assert cluster.silhouette(good, "label", ["a", "b"], "squared").first().distance == "squared"


def brute_silhouette(x, lab, squared=False):
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    d, s = d if squared else np.sqrt(d), []
    for i in range(len(x)):
        n = np.sum(lab == lab[i])
        a = d[i][lab == lab[i]].sum() / (n - 1) if n > 1 else 0
        b = min((d[i][lab == k].mean() for k in set(lab) - {lab[i]}), default=None)
        s.append(0 if n == 1 or b is None else (b - a) / max(a, b))
    return np.mean(s)


def brute_davies_bouldin(x, lab):
    names = sorted(set(lab))
    m = [x[lab == k].mean(axis=0) for k in names]
    s = [np.sqrt(((x[lab == k] - c) ** 2).sum(axis=1)).mean() for k, c in zip(names, m)]
    return np.mean([max(((s[i] + s[j]) / np.linalg.norm(m[i] - m[j]) for j in range(len(m)) if j != i), default=0) for i in range(len(m))])


@pytest.mark.parametrize("part,tile", [(8192, 1024), (40, 2)])
def test_quality_of_groups_against_brute_force(spark, monkeypatch, part, tile):
    """Clusters cut by the ends of parts, clusters of one point, a group of one cluster, a NULL group, noise as a cluster."""
    monkeypatch.setattr(cluster, "PART", part)
    monkeypatch.setattr(cluster, "TILE", tile)
    rng = np.random.default_rng(6)
    rows = [(g, int(rng.integers(-1, 4)) if g != "c" else 0, *map(float, rng.normal(0, 1, 3))) for g in ("a", None, "c") for _ in range(130 if g == "a" else 60)]
    rows += [("a", 77, 9.0, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "g string, label int, x double, y double, z double")
    by = {g: (np.array([r[2:] for r in rows if r[0] == g]), np.array([r[1] for r in rows if r[0] == g])) for g in ("a", None, "c")}
    cols = ["x", "y", "z"]
    for squared, name in ((False, "euclidean"), (True, "squared")):
        got = {r.g: r.silhouette for r in cluster.silhouette(df, "label", cols, name, ["g"]).collect()}
        assert got == {g: pytest.approx(brute_silhouette(x, lab, squared)) for g, (x, lab) in by.items()}
    got = {r.g: r.davies_bouldin for r in cluster.davies_bouldin(df, "label", cols, ["g"]).collect()}
    assert got == {g: pytest.approx(brute_davies_bouldin(x, lab)) for g, (x, lab) in by.items()}


@pytest.mark.parametrize("sums", [1 << 23, 50])
def test_silhouette_by_products_of_tiles(spark, monkeypatch, sums):
    """Tiles cut by clusters and clusters by tiles, close pairs far from zero; copies are compared once, with their number as weight."""
    for name, n in (("PART", 40), ("TILE", 16), ("SQUARE", 7), ("SUMS", sums)):
        monkeypatch.setattr(cluster, name, n)
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(1e4, 1, (60, 5)), rng.normal(1e4, 1e-3, (30, 5)), np.tile(rng.normal(1e4, 1, (2, 5)), (25, 1)), rng.normal(-3, 1e-6, (20, 5))])
    lab = np.concatenate((rng.integers(0, 4, 140), np.repeat([5, 6], 10)))
    df = spark.createDataFrame([(int(k), *map(float, p)) for k, p in zip(lab, x)], "label int, a double, b double, c double, d double, e double")
    sizes, keep = {}, cluster.stage

    def counted(df, tag):
        df = keep(df, tag)
        sizes[tag] = df.count()
        return df

    monkeypatch.setattr(cluster, "stage", counted)
    assert cluster.silhouette(df, "label", list("abcde")).first().silhouette == pytest.approx(brute_silhouette(x, lab), abs=1e-9)
    assert sizes["points"] == len(set(map(tuple, np.column_stack((lab, x))))) < len(x)


def test_quality_of_ten_thousand_clusters(spark):
    rng = np.random.default_rng(1)
    x, lab = rng.uniform(0, 100, (20_000, 2)), np.repeat(np.arange(10_000), 2)
    df = spark.createDataFrame([(int(k), float(a), float(b)) for k, (a, b) in zip(lab, x)], "label int, a double, b double")
    m, s = (x[::2] + x[1::2]) / 2, np.linalg.norm(x[::2] - x[1::2], axis=1) / 2
    worst = [np.max(np.delete((s[i] + s) / np.maximum(np.linalg.norm(m - m[i], axis=1), 1e-300), i)) for i in range(len(m))]
    assert cluster.davies_bouldin(df, "label", ["a", "b"]).first()[0] == pytest.approx(np.mean(worst))
    assert -1 < cluster.silhouette(df, "label", ["a", "b"], "squared").first().silhouette < 0


@pytest.mark.parametrize("block", [4096, 16])
def test_kmeans_of_many_groups_in_one_job(spark, monkeypatch, block):
    """Blocks moved in rounds give what a group gives where it lies; short groups, NULL groups, gaps, constant columns."""
    rng = np.random.default_rng(8)
    rows = []
    for g, n in (("a", 90), (None, 60), ("short", 2), ("flat", 20)):
        for i in range(n):
            c = rng.integers(3) * 4.0
            rows.append((g, len(rows), 1.0 if g == "flat" else float(c + rng.normal(0, 0.2)), float(c * 0.5 + rng.normal(0, 0.2)), 7.0))
    rows += [("a", len(rows), None, 1.0, 7.0), ("a", len(rows) + 1, float("nan"), 1.0, 7.0)]
    df = spark.createDataFrame(rows, "g string, id int, x double, y double, z double").coalesce(1)
    want = {r.id: r.cluster for r in cluster.kmeans(df, ["x", "y", "z"], 3, n_init=3, keys=["g"]).collect()}
    monkeypatch.setattr(lloyd, "BLOCK_ROWS", block)
    got = cluster.kmeans(df, ["x", "y", "z"], 3, n_init=3, keys=["g"])
    assert got.columns == [*df.columns, "cluster"] and {r.id: r.cluster for r in got.collect()} == want
    assert {want[r[1]] for r in rows if r[0] == "short" or r[2] is None or r[2] != r[2]} == {None}
    for g in ("a", None):
        mine = [r for r in rows if r[0] == g and r[2] is not None and r[2] == r[2]]
        assert len({want[r[1]] for r in mine}) == 3
        assert all(want[r[1]] == round(r[3] / 2) for r in mine)  # numbered by centroid: 0, 4 and 8 in x, half of it in y
    assert cluster.kmeans(df.limit(0), ["x", "y"], 3, keys=["g"]).count() == 0


def test_every_row_can_be_drawn_for_a_tree(spark):
    nodes, per_tree = forest.fit_forest(spark.range(3000).select("id", (F.col("id") % 97).cast("double").alias("a")), ["id"], ["a"], trees=40, sample=64)
    assert per_tree == 64 and nodes.select("tree").distinct().count() == 40


def test_pca_is_centered_orthogonal_and_ordered(spark):
    rng = np.random.default_rng(4)
    t = rng.normal(0, 3, 200)
    df = spark.createDataFrame([(i, float(v), float(v + e), float(w)) for i, (v, e, w) in enumerate(zip(t, rng.normal(0, .3, 200), rng.normal(0, 1, 200)))],
                               "id int, a double, b double, c double")
    p = cluster.pca(df, ["a", "b", "c"], 3).toPandas()
    assert abs(p[["pca1", "pca2", "pca3"]].mean()).max() < 1e-9
    cov = np.cov(p[["pca1", "pca2", "pca3"]].T)
    assert abs(cov - np.diag(np.diag(cov))).max() < 1e-9 and cov[0, 0] > cov[1, 1] > cov[2, 2]


def test_isolation_flags_a_tenth_and_the_spikes(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (600, 2))
    x[[10, 300]] = [[12, 12], [-11, 9]]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id int, a double, b double")
    first = forest.isolation_outliers(df, ["id"], ["a", "b"]).toPandas().sort_values("id")
    again = forest.isolation_outliers(df.repartition(5), ["id"], ["a", "b"]).toPandas().sort_values("id")
    assert abs(first.is_outlier_iso.mean() - 0.1) < 0.01
    assert set(first.sort_values("iso_score").id[-2:]) == {10, 300}
    np.testing.assert_allclose(first.iso_score, again.iso_score)


def test_isolation_scores_and_flags_against_plain_walks(spark):
    """Scores are 2 ** -(mean depth / expected depth) over the fitted trees, flags lie above their 0.9 quantile; with density noise they make N10."""
    rng = np.random.default_rng(12)
    x = np.vstack([rng.normal(0, 0.2, (150, 4)), rng.normal(2, 0.2, (100, 4)), rng.uniform(-4, 6, (12, 4))])
    cols = list("abcd")
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id int, a double, b double, c double, d double")
    nodes, per_tree = forest.fit_forest(df, ["id"], cols, trees=25, sample=64)
    trees = {}
    for n in nodes.collect():
        trees.setdefault(n.tree, {})[n.node] = n

    def depth(tree, p):
        at = tree[0]
        while at.feature >= 0:
            at = tree[at.left if p[at.feature] <= at.cut else at.right]
        return at.value

    expected = 2 * (np.log(per_tree - 1) + np.euler_gamma) - 2 * (per_tree - 1) / per_tree
    want = np.array([2 ** -(np.mean([depth(t, p) for t in trees.values()]) / expected) for p in x])
    got = forest.isolation_outliers(df, ["id"], cols, trees=25, sample=64).toPandas().sort_values("id")
    np.testing.assert_allclose(got.iso_score, want)
    assert (got.is_outlier_iso.to_numpy() == (want > np.quantile(want, 0.9))).all()
    for t in trees.values():  # a leaf's value is its depth and what its rows would take on average
        assert sum(n.feature < 0 for n in t.values()) == sum(n.feature >= 0 for n in t.values()) + 1
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    noise = brute_dbscan(z, 0.5, 5)[1]
    out = detect.multivariate_outliers(df, ["id"], cols).toPandas().sort_values("id")
    alone = detect.multivariate_outliers(df, ["id"], cols, by_density=False).toPandas().sort_values("id")
    assert (out.is_outlier_dbscan.to_numpy() == noise).all()
    assert (out.is_outlier.to_numpy() == (noise | alone.is_outlier_iso.to_numpy())).all() and noise.any() and not noise.all()


RULES = (("m", "x", 0, 10, 3),)
SCHEMA = "m string, id long, ts timestamp, v double"


def feed(spark, path, *parts):
    """A file per micro-batch, and the stream that reads them one by one."""
    for rows in parts:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)  # files are read in the order of their times
    return live.read_stream(spark, path, spark.read.parquet(path).schema, "ts", files_per_trigger=1)


T0 = dt.datetime(2024, 1, 1)


def readings(values, key="m", start=0):
    return [(key, start + i, T0 + dt.timedelta(minutes=start + i), None if v is None else float(v)) for i, v in enumerate(values)]


def test_sustained_alerts_cross_batches_like_one_batch(spark, tmp_path):
    rows = readings([1, 11, 12, 13, 14, 2, -1, -2, -3, 5, 11, 12, None, 11])
    stream = feed(spark, str(tmp_path / "in"), rows[:3], rows[3:8], rows[8:])
    out = live.run_sustained_alerts(stream, ["m"], "m", "ts", "v", ["id"], RULES)
    assert sorted((r.id, r.threshold_severity) for r in out.collect()) == [(3, "high"), (4, "high"), (8, "medium")]
    assert out.columns == ["m", "id", "ts", "v", "threshold_reason", "threshold_severity"]


def batch_alerts(spark, rows):
    placed = with_position(spark.createDataFrame(rows, SCHEMA), ["m"], ["ts", "id"])
    out = detect.threshold_rules(placed.withColumn("kind", F.lit("m")), ["m"], "kind", "v", RULES)
    return sorted((r.id, r.threshold_reason, r.threshold_severity) for r in out.filter("threshold_anomaly").collect())


def test_sustained_alerts_of_many_series_in_five_batches(spark, tmp_path):
    """Same alerts as the batch operator, null key, ties in time and empty batches of a series included."""
    rnd = random.Random(8)
    rows = []
    for i in range(400):
        key = rnd.choice(["m", "n", None, "x"])
        rows.append((key, i, T0 + dt.timedelta(minutes=i // 2), rnd.choice([None, 5.0, 11.0, 12.0, 13.0, -1.0, -2.0])))
    cuts = [0, 90, 91, 180, 300, 400]
    parts = [rnd.sample(rows[a:b], b - a) for a, b in zip(cuts, cuts[1:])]
    stream = feed(spark, str(tmp_path / "in"), *parts).withColumn("kind", F.lit("m"))
    out = live.run_sustained_alerts(stream, ["m"], "kind", "ts", "v", ["id"], RULES)
    got = sorted((r.id, r.threshold_reason, r.threshold_severity) for r in out.collect())
    assert got == batch_alerts(spark, rows) and len(got) > 10


def test_a_late_reading_is_judged_where_it_belongs(spark, tmp_path):
    rows = readings([11, 12, 1, 13, 14, 15])
    stream = feed(spark, str(tmp_path / "in"), [rows[0], rows[3]], [rows[1]], [rows[2]], rows[4:])
    out = live.run_sustained_alerts(stream, ["m"], "m", "ts", "v", ["id"], RULES)
    # reading 1 arrives late and completes nothing behind it; the low reading 2 then breaks the run, which counts again from 3 on
    assert [r.id for r in out.orderBy("id").collect()] == [5]


def test_a_restarted_stream_goes_on_with_its_state(spark, tmp_path):
    rows = readings([1, 11, 12, 13, 14, 2])
    where = dict(out=str(tmp_path / "out"), checkpoint=str(tmp_path / "state"))
    stream = feed(spark, str(tmp_path / "in"), rows[:3])
    assert live.run_sustained_alerts(stream, ["m"], "m", "ts", "v", ["id"], RULES, **where).count() == 0
    for _ in range(2):  # the second time there is nothing new
        stream = feed(spark, str(tmp_path / "in"), *([rows[3:]] if _ == 0 else []))
        out = live.run_sustained_alerts(stream, ["m"], "m", "ts", "v", ["id"], RULES, **where)
        assert sorted(r.id for r in out.collect()) == [3, 4]


def test_only_the_series_of_a_batch_are_read(spark, tmp_path):
    many = [r for k in range(40) for r in readings([11, 12], f"s{k}", 10 * k)]
    one = [("s3", 1000, T0 + dt.timedelta(minutes=1000), 13.0)]
    stream = feed(spark, str(tmp_path / "in"), many, one).withColumn("kind", F.lit("m"))
    alerts = live.sustained_alert_stream(stream, ["m"], "kind", "ts", "v", ["id"], RULES)
    setting = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(setting)
    spark.conf.set(setting, live.ROCKSDB)
    try:
        query = (alerts.writeStream.format("parquet").trigger(availableNow=True).option("path", str(tmp_path / "out"))
                 .option("checkpointLocation", str(tmp_path / "state")).start())
        query.awaitTermination()
    finally:
        spark.conf.set(setting, was)
    reads = [p["stateOperators"][0]["customMetrics"]["rocksdbGetCount"] for p in query.recentProgress if p["numInputRows"]]
    assert len(reads) == 2 and reads[0] >= 40 and reads[1] <= 4
    assert [r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1000]


def test_idle_series_are_forgotten(spark, tmp_path):
    rows = readings([11, 12])
    gap = [("m", 50, T0 + dt.timedelta(hours=5), 13.0), ("m", 51, T0 + dt.timedelta(hours=5, minutes=1), 13.0), ("m", 52, T0 + dt.timedelta(hours=5, minutes=2), 13.0)]
    other = [("n", 60 + i, T0 + dt.timedelta(hours=9 + i), 1.0) for i in range(3)]
    stream = feed(spark, str(tmp_path / "in"), rows, gap, *[[r] for r in other]).withColumn("kind", F.lit("m"))
    alerts = live.sustained_alert_stream(stream, ["m"], "kind", "ts", "v", ["id"], RULES, idle="1 hour", late="1 minute")
    setting = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(setting)
    spark.conf.set(setting, live.ROCKSDB)
    try:
        query = (alerts.writeStream.format("parquet").trigger(availableNow=True).option("path", str(tmp_path / "out"))
                 .option("checkpointLocation", str(tmp_path / "state")).start())
        query.awaitTermination()
    finally:
        spark.conf.set(setting, was)
    assert [r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [52]  # the run began anew after the gap
    tail = spark.read.format("statestore").option("path", str(tmp_path / "state")).option("stateVarName", "tail").load()
    assert {r["key"][0] for r in tail.collect()} == {"n"}


def test_late_rows_and_open_bins_stay_out(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    at = lambda h, m=0: t0 + dt.timedelta(hours=h, minutes=m)
    # the watermark of a batch applies to the lateness of the batch after the next
    for part in ([("m", 1, at(0, 10), 1.0), ("m", 2, at(0, 50), 3.0), ("m", 3, at(3), 9.0)], [("m", 4, at(4), 8.0)],
                 [("m", 5, at(0, 20), 100.0), ("m", 6, at(6), 7.0)]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = live.read_stream(spark, str(tmp_path / "in"), schema, "ts", files_per_trigger=1)
    out = live.run_to_table(live.resample_stream(stream, ["m"], "ts", "v")).orderBy("ts").collect()
    assert [(r.ts.hour, r.v, r.n) for r in out] == [(0, 2.0, 2), (3, 9.0, 1), (4, 8.0, 1)]


def test_density_outliers_skip_short_series(spark):
    df = spark.createDataFrame([("a", i, float(i % 3)) for i in range(9)], "k string, pos long, v double")
    assert detect.density_outliers(df, ["k"], "v").count() == 0
