"""Clustering, isolation, combined outliers and streams (K, N9, N10, G4, X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import HOURLY, KEY, hourly, query, r6, rounded, table
from catalog.detectors import EVENT_RULES, RULES_AND_RESIDUAL, RULES_SQL, SEASONAL
from catalog.series import FEATURES_SQL
from tidewatch.operators import cluster, density, detect, features, forest, grid
from tidewatch.operators.clean import standardize
from tidewatch.plans import reports, workflows
from tidewatch.plans.chunks import attach
from tidewatch.streaming import live

METRICS = ["click", "error", "purchase", "signup", "view"]


def wide(spark, sf):
    """Hourly means of all event types side by side: ts and a column per type."""
    g = grid.resample(table(spark, sf, "events"), [], "ts", "1h", {
        m: F.avg(F.when(F.col("event_type") == m, F.col("value"))) for m in METRICS}, "chain")
    return g.select("ts", *METRICS)


def _vectors(spark, sf, n=64):
    return table(spark, sf, "embeddings").select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(n)])


E = [f"e{i}" for i in range(64)]


@query("K1_kmeans_sizes")
def _(spark, sf):
    out = cluster.kmeans(wide(spark, sf), METRICS, k=3)
    return out.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), *[r6(F.avg(m)).alias(m) for m in METRICS])


@query("K1_kmeans_window_features")
def _(spark, sf):
    feats = features.impute_features(features.window_features(hourly(spark, sf), KEY, "value"))
    return cluster.kmeans(feats.select("event_type", "window_id", *features.FEATURES), features.FEATURES, k=4)


# N9 features: value, trailing 5-row mean and std, standardized per event type; noise by brute force.
DENSITY_SQL = HOURLY + """, w AS (SELECT event_type, ts, pos, value AS f0, avg(value) OVER f AS f1, coalesce(stddev_samp(value) OVER f, 0) AS f2 FROM g
  WINDOW f AS (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
st AS (SELECT event_type, avg(f0) AS m0, avg(f1) AS m1, avg(f2) AS m2, stddev_pop(f0) AS s0, stddev_pop(f1) AS s1, stddev_pop(f2) AS s2 FROM w GROUP BY 1),
x AS (SELECT event_type, ts, pos, (f0 - m0) / s0 AS a, (f1 - m1) / s1 AS b, (f2 - m2) / s2 AS c FROM w JOIN st USING (event_type)),
nb AS (SELECT p.event_type, p.pos, q.pos AS other FROM x p JOIN x q ON p.event_type = q.event_type
       AND (p.a - q.a) ** 2 + (p.b - q.b) ** 2 + (p.c - q.c) ** 2 <= 0.25),
core AS (SELECT event_type, pos FROM nb GROUP BY 1, 2 HAVING count(*) >= 5),
near_core AS (SELECT DISTINCT nb.event_type, nb.pos FROM nb JOIN core c ON nb.event_type = c.event_type AND nb.other = c.pos)"""


@query("K2_density_core_and_noise", DENSITY_SQL + """ SELECT x.event_type, x.ts, c.pos IS NOT NULL AS is_core, n.pos IS NULL AS is_noise
  FROM x LEFT JOIN core c ON x.event_type = c.event_type AND x.pos = c.pos LEFT JOIN near_core n ON x.event_type = n.event_type AND x.pos = n.pos""")
def _(spark, sf):
    feats = detect.density_features(hourly(spark, sf), KEY, "value")
    return density.dbscan(feats, KEY, ["f0_z", "f1_z", "f2_z"], labels=False).select("event_type", "ts", "is_core", "is_noise")


# Labels by walking the core graph from each core point: the smallest core position reached names the cluster.
@query("K2_density_clusters", DENSITY_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """,
ce AS (SELECT nb.event_type, nb.pos, nb.other FROM nb JOIN core c ON nb.event_type = c.event_type AND nb.pos = c.pos JOIN core d ON nb.event_type = d.event_type AND nb.other = d.pos),
reach AS (SELECT event_type, pos, pos AS root FROM core UNION SELECT ce.event_type, ce.other, r.root FROM reach r JOIN ce ON ce.event_type = r.event_type AND ce.pos = r.pos WHERE r.root < ce.other),
comp AS (SELECT event_type, pos, min(root) AS root FROM reach GROUP BY 1, 2)
SELECT event_type, root AS first_core, count(*)::BIGINT AS core_points FROM comp GROUP BY 1, 2""")
def _(spark, sf):
    feats = detect.density_features(hourly(spark, sf), KEY, "value")
    out = density.dbscan(feats, KEY, ["f0_z", "f1_z", "f2_z"])
    return out.filter("is_core").groupBy("event_type", "cluster").agg(
        F.min("pos").alias("first_core"), F.count(F.lit(1)).alias("core_points")).drop("cluster")


@query("N9_density_outliers", DENSITY_SQL + """ SELECT x.event_type, x.ts, n.pos IS NULL AS cluster_anomaly FROM x
  LEFT JOIN near_core n ON x.event_type = n.event_type AND x.pos = n.pos""")
def _(spark, sf):
    return detect.density_outliers(hourly(spark, sf), KEY, "value", labels=False).select("event_type", "ts", "cluster_anomaly")


@query("K3_isolation_outliers")
def _(spark, sf):
    return forest.isolation_outliers(wide(spark, sf), ["ts"], METRICS)


@query("N10_multivariate_outliers")
def _(spark, sf):
    return detect.multivariate_outliers(wide(spark, sf), ["ts"], METRICS)


# The wide table in SQL, standardized: x (ts, one column per type).
_AT = ", ".join(f"avg(value) FILTER (event_type = '{m}') AS {m}" for m in METRICS)
_CASE = "CASE m " + " ".join(f"WHEN '{m}' THEN {m}" for m in METRICS) + " END"
_BACK = ", ".join(f"max(z) FILTER (m = '{m}') AS {m}" for m in METRICS)
WIDE_SQL = f"""WITH o AS (SELECT date_trunc('hour', ts) AS ts, {_AT} FROM events GROUP BY 1),
sp AS (SELECT unnest(generate_series((SELECT min(ts) FROM o), (SELECT max(ts) FROM o), INTERVAL 1 HOUR)) AS ts),
l AS (SELECT unnest({METRICS}) AS m, sp.ts, {", ".join("o." + m for m in METRICS)} FROM sp LEFT JOIN o USING (ts)),
v AS (SELECT m, ts, dense_rank() OVER (ORDER BY ts) - 1 AS pos, {_CASE} AS value FROM l),
""" + HOURLY.split("near AS")[1].replace("event_type", "m").replace("FROM cells", "FROM v").replace(" (SELECT", "near AS (SELECT", 1) + f""",
z AS (SELECT m, ts, (value - avg(value) OVER (PARTITION BY m)) / stddev_pop(value) OVER (PARTITION BY m) AS z FROM g),
x AS (SELECT ts, {_BACK} FROM z GROUP BY 1)"""


@query("N10_multivariate_density", WIDE_SQL + f""",
nb AS (SELECT p.ts, q.ts AS other FROM x p JOIN x q ON {" + ".join(f"(p.{m} - q.{m}) ** 2" for m in METRICS)} <= 0.25),
core AS (SELECT ts FROM nb GROUP BY 1 HAVING count(*) >= 5)
SELECT x.ts, x.ts NOT IN (SELECT nb.ts FROM nb JOIN core ON nb.other = core.ts) AS is_outlier FROM x""")
def _(spark, sf):
    return detect.multivariate_outliers(wide(spark, sf), ["ts"], METRICS, by_isolation=False).select("ts", "is_outlier")


# Labels as above; clusters are numbered by their smallest core vector.
@query("K2_density_embeddings", """WITH RECURSIVE nb AS (SELECT p.vec_id, q.vec_id AS other FROM embeddings p JOIN embeddings q
  ON list_sum(list_transform(range(1, 65), lambda i: (p.embedding[i]::DOUBLE - q.embedding[i]::DOUBLE) ** 2)) <= 1.44),
core AS (SELECT vec_id FROM nb GROUP BY 1 HAVING count(*) >= 4),
ce AS (SELECT nb.vec_id, nb.other FROM nb JOIN core c ON nb.vec_id = c.vec_id JOIN core d ON nb.other = d.vec_id),
reach AS (SELECT vec_id, vec_id AS root FROM core UNION SELECT ce.other, r.root FROM reach r JOIN ce ON ce.vec_id = r.vec_id WHERE r.root < ce.other),
comp AS (SELECT vec_id, min(root) AS root FROM reach GROUP BY 1),
named AS (SELECT root, row_number() OVER (ORDER BY min(embedding)) - 1 AS cluster FROM comp JOIN embeddings USING (vec_id) GROUP BY 1),
own AS (SELECT vec_id, cluster FROM comp JOIN named USING (root)),
edge AS (SELECT nb.vec_id, min(own.cluster) AS cluster FROM nb JOIN own ON nb.other = own.vec_id GROUP BY 1)
SELECT e.vec_id, o.vec_id IS NOT NULL AS is_core, d.vec_id IS NULL AS is_noise, coalesce(o.cluster, d.cluster, -1)::INT AS cluster
FROM embeddings e LEFT JOIN own o ON e.vec_id = o.vec_id LEFT JOIN edge d ON e.vec_id = d.vec_id""")
def _(spark, sf):
    return density.dbscan(_vectors(spark, sf), [], E, eps=1.2, min_samples=4).select("vec_id", "is_core", "is_noise", "cluster")


@query("N10_behaviour_table", WIDE_SQL + f""",
nb AS (SELECT p.ts, q.ts AS other FROM x p JOIN x q ON {" + ".join(f"(p.{m} - q.{m}) ** 2" for m in METRICS)} <= 0.25),
core AS (SELECT ts FROM nb GROUP BY 1 HAVING count(*) >= 5),
k AS (SELECT x.ts, x.ts NOT IN (SELECT nb.ts FROM nb JOIN core ON nb.other = core.ts) AS noise FROM x)
SELECT ts, noise AS is_outlier_dbscan, CASE WHEN noise THEN true END AS is_outlier, true AS labelled, true AS placed FROM k""")
def _(spark, sf):
    out = workflows.behaviour(wide(spark, sf), ["ts"], METRICS)
    return out.select("ts", "is_outlier_dbscan", F.when(F.col("is_outlier_dbscan"), F.col("is_outlier")).alias("is_outlier"),
                      (F.col("kmeans_cluster").between(0, 2) & ((F.col("density_cluster") == -1) == F.col("is_outlier_dbscan"))).alias("labelled"),
                      (F.col("pca1").isNotNull() & F.col("pca2").isNotNull() & F.col("pca3").isNotNull()).alias("placed"))


# A tenth of the rows is flagged: the number of rows above the linear 0.9 quantile, if no two scores are equal there.
@query("K3_isolation_share", WIDE_SQL + """, n AS (SELECT count(*) AS n FROM x)
SELECT n::BIGINT AS n_rows, (n - 1 - floor(0.9 * (n - 1)))::BIGINT AS flagged, true AS highest FROM n""")
def _(spark, sf):
    out = forest.isolation_outliers(wide(spark, sf), ["ts"], METRICS)
    hit = F.col("is_outlier_iso")
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(hit).alias("flagged"),
                   (F.min(F.when(hit, F.col("iso_score"))) > F.max(F.when(~hit, F.col("iso_score")))).alias("highest"))


# A k-means result is a fixed point: no row is nearer to another centroid than to its own.
@query("K1_kmeans_fixed_point", WIDE_SQL + " SELECT count(*)::BIGINT AS n_rows, least(3, count(*))::BIGINT AS clusters, 0::BIGINT AS misplaced FROM x")
def _(spark, sf):
    out = cluster.kmeans(wide(spark, sf), METRICS, k=3)
    z, zs = cluster.scaled(out, METRICS)
    own = z.groupBy("cluster").agg(F.array(*[F.avg(c) for c in zs]).alias("_m"))
    centroids = own.agg(F.collect_list(F.struct("cluster", "_m")).alias("_all"))
    far = lambda m: F.aggregate(F.zip_with(m, F.array(*zs), lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, x: s + x)
    rows = attach(z, centroids, []).withColumn("_d", F.transform("_all", lambda c: F.struct(c["cluster"].alias("k"), far(c["_m"]).alias("d"))))
    mine = F.filter("_d", lambda x: x["k"] == F.col("cluster"))[0]["d"]
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("cluster").alias("clusters"),
                    F.count_if(F.array_min(F.transform("_d", lambda x: x["d"])) < mine - 1e-3).alias("misplaced"))


# The same for every metric of one job: windows per metric, clusters, none misplaced.
@query("K1_kmeans_per_metric_fixed_point", FEATURES_SQL + """ SELECT event_type, count(*)::BIGINT AS n_rows, 4::BIGINT AS clusters, 0::BIGINT AS misplaced
  FROM feat GROUP BY 1 HAVING count(*) >= 4""")
def _(spark, sf):
    feats = features.impute_features(features.window_features(hourly(spark, sf), KEY, "value"), keys=KEY)
    out = cluster.kmeans(feats, features.FEATURES, k=4, keys=KEY).filter("cluster is not null")
    zs = [f"{c}_z" for c in features.FEATURES]
    z = standardize(out, features.FEATURES, KEY, "_z").select(*KEY, "window_id", "cluster", F.array(*zs).alias("z"))
    middle = z.groupBy(*KEY, "cluster").agg(F.array(*[F.avg(F.get("z", F.lit(i))) for i in range(len(zs))]).alias("m"))
    far = F.aggregate(F.zip_with("z", "m", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda a, x: a + x)
    met = z.join(middle.withColumnRenamed("cluster", "other"), KEY).groupBy(*KEY, "window_id", "cluster").agg(
        F.min(far).alias("least"), F.max(F.when(F.col("other") == F.col("cluster"), far)).alias("mine"))
    return met.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("cluster").alias("clusters"), F.count_if(F.col("least") < F.col("mine") - 1e-3).alias("misplaced"))


# With as many components as columns a row keeps its length, and components are uncorrelated with falling variance.
@query("K4_pca_keeps_lengths", WIDE_SQL + f" SELECT ts, round({' + '.join(f'{m} ** 2' for m in METRICS)}, 6) AS length2 FROM x")
def _(spark, sf):
    out = cluster.pca(wide(spark, sf), METRICS, len(METRICS))
    total = F.lit(0.0)
    for i in range(len(METRICS)):
        total = total + F.col(f"pca{i + 1}") * F.col(f"pca{i + 1}")
    return rounded(out.select("ts", total.alias("length2")), "length2")


@query("K4_pca_uncorrelated", WIDE_SQL + f""" SELECT count(*)::BIGINT AS n_rows, round({' + '.join(f'var_pop({m})' for m in METRICS)}, 6) AS variance,
  0.0::DOUBLE AS largest_covariance, true AS falling FROM x""")
def _(spark, sf):
    n = len(METRICS)
    out = cluster.pca(wide(spark, sf), METRICS, n)
    p = [f"pca{i + 1}" for i in range(n)]
    row = out.agg(F.count(F.lit(1)).alias("n_rows"), *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(p)],
                  F.greatest(*[F.abs(F.covar_pop(a, b)) for i, a in enumerate(p) for b in p[:i]]).alias("largest_covariance"))
    falling = F.lit(True)
    for i in range(1, n):
        falling = falling & (F.col(f"v{i - 1}") >= F.col(f"v{i}"))
    total = F.lit(0.0)
    for i in range(n):
        total = total + F.col(f"v{i}")
    return row.select("n_rows", r6(total).alias("variance"), F.round("largest_covariance", 6).alias("largest_covariance"), falling.alias("falling"))


@query("K4_pca_two_components")
def _(spark, sf):
    return cluster.pca(_vectors(spark, sf), E, 2).select("vec_id", "label", "pca1", "pca2")


@query("K4_pca_three_components")
def _(spark, sf):
    return cluster.pca(wide(spark, sf), METRICS, 3)


@query("K4_pca_single_column", HOURLY + """ SELECT event_type, ts, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) AS pca1, 0.0::DOUBLE AS pca2, 0.0::DOUBLE AS pca3 FROM g""")
def _(spark, sf):
    return rounded(cluster.pca(hourly(spark, sf), ["value"], 3).select("event_type", "ts", "pca1", "pca2", "pca3"), "pca1")


_SIL = """WITH d AS (SELECT a.vec_id, a.label, b.label AS other, sum({dist}) AS s, count(*) AS n FROM embeddings a, embeddings b GROUP BY 1, 2, 3),
p AS (SELECT vec_id, max(CASE WHEN label = other THEN s / nullif(n - 1, 0) END) AS a, min(CASE WHEN label <> other THEN s / n END) AS b FROM d GROUP BY 1)
SELECT round(avg(coalesce((b - a) / nullif(greatest(a, b), 0), 0)), 6) AS silhouette, '{name}' AS distance FROM p"""
_D2 = "list_sum(list_transform(range(1, 65), lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) ** 2))"


@query("K5_silhouette", _SIL.format(dist=f"sqrt({_D2})", name="euclidean"))
def _(spark, sf):
    return rounded(cluster.silhouette(_vectors(spark, sf), "label", E), "silhouette")


@query("K5_silhouette_squared", _SIL.format(dist=_D2, name="squared"))
def _(spark, sf):
    return rounded(cluster.silhouette_squared(_vectors(spark, sf), "label", E), "silhouette")


@query("K6_davies_bouldin", """WITH u AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(1, 65)) AS i FROM embeddings),
c AS (SELECT label, i, avg(v) AS m FROM u GROUP BY 1, 2),
s AS (SELECT label, avg(d) AS s FROM (SELECT vec_id, u.label, sqrt(sum((v - m) ** 2)) AS d FROM u JOIN c USING (label, i) GROUP BY 1, 2) GROUP BY 1),
p AS (SELECT a.label AS l, b.label AS k, sqrt(sum((a.m - b.m) ** 2)) AS d FROM c a JOIN c b ON a.i = b.i AND a.label <> b.label GROUP BY 1, 2)
SELECT round(avg(r), 6) AS davies_bouldin FROM (SELECT l, max((x.s + y.s) / d) AS r FROM p JOIN s x ON l = x.label JOIN s y ON k = y.label GROUP BY 1)""")
def _(spark, sf):
    return rounded(cluster.davies_bouldin(_vectors(spark, sf), "label", E), "davies_bouldin")


# Density clusters as labels, noise left out.
_DENSE = DENSITY_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """,
ce AS (SELECT nb.event_type, nb.pos, nb.other FROM nb JOIN core c ON nb.event_type = c.event_type AND nb.pos = c.pos JOIN core d ON nb.event_type = d.event_type AND nb.other = d.pos),
reach AS (SELECT event_type, pos, pos AS root FROM core UNION SELECT ce.event_type, ce.other, r.root FROM reach r JOIN ce ON ce.event_type = r.event_type AND ce.pos = r.pos WHERE r.root < ce.other),
comp AS (SELECT event_type, pos, min(root) AS root FROM reach GROUP BY 1, 2),
pt AS (SELECT x.event_type, x.pos, x.a, x.b, x.c, root FROM x JOIN comp ON x.event_type = comp.event_type AND x.pos = comp.pos)"""


def _dense_cores(spark, sf):
    feats = detect.density_features(hourly(spark, sf), KEY, "value")
    return density.dbscan(feats, KEY, ["f0_z", "f1_z", "f2_z"]).filter("is_core")


@query("K5_silhouette_per_metric", _DENSE + """,
d AS (SELECT p.event_type, p.pos, p.root, q.root AS other, sum(sqrt((p.a - q.a) ** 2 + (p.b - q.b) ** 2 + (p.c - q.c) ** 2)) AS s, count(*) AS n
      FROM pt p JOIN pt q ON p.event_type = q.event_type GROUP BY 1, 2, 3, 4),
m AS (SELECT event_type, pos, max(CASE WHEN root = other THEN s / nullif(n - 1, 0) END) AS i, min(CASE WHEN root <> other THEN s / n END) AS o FROM d GROUP BY 1, 2)
SELECT event_type, round(avg(coalesce((o - i) / nullif(greatest(o, i), 0), 0)), 6) AS silhouette FROM m GROUP BY 1""")
def _(spark, sf):
    return rounded(cluster.silhouette(_dense_cores(spark, sf), "cluster", ["f0_z", "f1_z", "f2_z"], keys=KEY).drop("distance"), "silhouette")


@query("K6_davies_bouldin_per_metric", _DENSE + """,
mid AS (SELECT event_type, root, avg(a) AS a, avg(b) AS b, avg(c) AS c FROM pt GROUP BY 1, 2),
sp AS (SELECT pt.event_type, pt.root, m.a, m.b, m.c, avg(sqrt((pt.a - m.a) ** 2 + (pt.b - m.b) ** 2 + (pt.c - m.c) ** 2)) AS s FROM pt JOIN mid AS m USING (event_type, root) GROUP BY ALL),
wr AS (SELECT p.event_type, p.root, max((p.s + q.s) / nullif(sqrt((p.a - q.a) ** 2 + (p.b - q.b) ** 2 + (p.c - q.c) ** 2), 0)) AS worst
      FROM sp p LEFT JOIN sp q ON p.event_type = q.event_type AND p.root <> q.root GROUP BY 1, 2)
SELECT event_type, round(avg(coalesce(worst, 0)), 6) AS davies_bouldin FROM wr GROUP BY 1""")
def _(spark, sf):
    return rounded(cluster.davies_bouldin(_dense_cores(spark, sf), "cluster", ["f0_z", "f1_z", "f2_z"], KEY), "davies_bouldin")


# Labels as they are given with the vectors.
@query("K8_cluster_insights", """WITH u AS (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS i FROM embeddings),
c AS (SELECT label, i, avg(v) AS m, stddev_samp(v) AS s FROM u GROUP BY 1, 2)
SELECT label, (SELECT count(*) FROM embeddings e WHERE e.label = c.label)::BIGINT AS size, round(avg(m), 6) AS avg_activity_level, round(avg(s), 6) AS stability,
  'Cluster ' || label || ' behavior pattern' AS interpretation FROM c GROUP BY 1""")
def _(spark, sf):
    return rounded(cluster.insights(_vectors(spark, sf), [], "label", E), "avg_activity_level", "stability")


# Density clusters of the readings, numbered by their smallest core point, under the names that have texts.
@query("K9_cluster_interpretation", _DENSE + """,
k AS (SELECT event_type, root, row_number() OVER (PARTITION BY event_type ORDER BY min([a, b, c])) - 1 AS cluster FROM pt GROUP BY 1, 2),
v AS (SELECT CASE pt.event_type WHEN 'click' THEN 'heart_rate' WHEN 'view' THEN 'steps' ELSE pt.event_type END AS metric, k.cluster, g.value
      FROM pt JOIN k USING (event_type, root) JOIN g ON pt.event_type = g.event_type AND pt.pos = g.pos),
i AS (SELECT metric, cluster, count(*)::BIGINT AS size, avg(value) AS a, stddev_samp(value) AS d FROM v GROUP BY 1, 2)
SELECT metric, cluster::INT AS cluster, size, round(a, 6) AS avg_activity_level, round(d, 6) AS stability,
 CASE WHEN metric = 'heart_rate' THEN CASE WHEN a < 60 THEN 'Low resting heart rate pattern' WHEN a < 70 THEN 'Normal heart rate pattern'
        WHEN a < 80 THEN 'Elevated heart rate pattern' ELSE 'High heart rate pattern' END
      WHEN metric = 'steps' THEN CASE WHEN a < 5000 THEN 'Sedentary activity pattern' WHEN a < 10000 THEN 'Moderate activity pattern' ELSE 'Active lifestyle pattern' END
      ELSE 'Cluster ' || cluster || ' behavior pattern' END AS interpretation FROM i""")
def _(spark, sf):
    t = F.col("event_type")
    rows = _dense_cores(spark, sf).withColumn("metric", F.when(t == "click", "heart_rate").when(t == "view", "steps").otherwise(t))
    return rounded(cluster.insights(rows, ["metric"], "cluster", ["value"], F.col("metric")), "avg_activity_level", "stability")


def _analysis(spark, sf):
    return workflows.analyze(hourly(spark, sf), KEY, "event_type", "ts", "value")["report"]


# Windows and features that vary are counted from the features themselves, the fit is measured on the baseline.
REPORT_COLUMNS = ["event_type", "anomalies", "patterns", "windows", "features", "mae", "rmse", "trend_stability", "data_volatility"]
ANALYSIS_SQL = SEASONAL + ", " + FEATURES_SQL.split("WITH ", 1)[1].split(HOURLY.split("WITH ", 1)[1] + ", ", 1)[-1] + f""",
wn AS (SELECT event_type, count(*)::BIGINT AS windows, ({" + ".join(f"(stddev_samp({c}::DOUBLE) > 1e-9)::INT" for c in features.FEATURES)})::BIGINT AS features FROM feat GROUP BY 1),
st AS (SELECT *, yhat - lag(yhat) OVER (PARTITION BY event_type ORDER BY pos) AS step FROM fit),
fm AS (SELECT event_type, (count(*) FILTER (abs(residual) / nullif(sd, 0) > 3))::BIGINT AS anomalies, avg(abs(residual)) AS mae, sqrt(avg(residual ** 2)) AS rmse,
  1 / (1 + stddev_pop(step)) AS trend_stability, stddev_samp(value) AS data_volatility FROM st GROUP BY 1),
an AS (SELECT event_type, anomalies, CASE WHEN windows >= 4 THEN 4 ELSE 0 END::BIGINT AS patterns, windows, features, mae, rmse, trend_stability, data_volatility
  FROM fm LEFT JOIN wn USING (event_type))"""


@query("G4_analyze_report", ANALYSIS_SQL + " SELECT event_type, anomalies, patterns, windows, features, round(mae, 6) AS mae, round(rmse, 6) AS rmse, "
       "round(trend_stability, 6) AS trend_stability, round(data_volatility, 6) AS data_volatility FROM an")
def _(spark, sf):
    return rounded(_analysis(spark, sf).select(*REPORT_COLUMNS), *REPORT_COLUMNS[5:])


@query("G9_health_report", ANALYSIS_SQL + """,
l AS (SELECT event_type, 1::BIGINT AS metrics, anomalies, patterns, features,
  upper(event_type[1]) || event_type[2:] || CASE WHEN anomalies > 0 THEN ': Review ' || anomalies || ' detected anomalies for potential health concerns' ELSE ': Patterns appear normal and healthy' END AS recommendation FROM an)
SELECT * FROM l UNION ALL SELECT NULL, count(*)::BIGINT, sum(anomalies)::BIGINT, (count(*) FILTER (patterns > 0))::BIGINT, sum(features)::BIGINT, NULL FROM l""")
def _(spark, sf):
    return reports.health_report(_analysis(spark, sf), "event_type")


@query("G5_detect_all", DENSITY_SQL + RULES_AND_RESIDUAL + """
SELECT p.event_type, p.ts, round(p.value, 6) AS value, hi OR lo OR now AS threshold_anomaly,
  abs(residual - mu) > 3 * sd OR p.value > predicted + 1.96 * sd OR p.value < predicted - 1.96 * sd AS residual_anomaly, n.pos IS NULL AS cluster_anomaly
FROM p JOIN z USING (event_type) JOIN rl ON p.event_type = rl.event_type AND p.pos = rl.pos LEFT JOIN near_core n ON p.event_type = n.event_type AND p.pos = n.pos""")
def _(spark, sf):
    out = workflows.detect_all(hourly(spark, sf), KEY, "event_type", "ts", "value", rules=(EVENT_RULES[0], EVENT_RULES[2]), period=24)
    return rounded(out.select("event_type", "ts", "value", "threshold_anomaly", "residual_anomaly", "cluster_anomaly"), "value")


# The same with residuals from the line-and-slots fit and its 0.90 band.
@query("G5_detect_all_seasonal", DENSITY_SQL + SEASONAL.split(HOURLY, 1)[1] + """, rl AS (SELECT *, sum((value > 60)::INT) OVER w3 >= 3 AND event_type = 'click' AS hi,
   sum((value < 5)::INT) OVER w3 >= 3 AND event_type = 'click' AS lo, (value > 150 OR value < 2) AND event_type = 'error' AS now
   FROM g WINDOW w3 AS (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT f.event_type, f.ts, round(f.value, 6) AS value, hi OR lo OR now AS threshold_anomaly,
  abs(residual - mean_r) > 3 * sdp OR f.value > yhat_upper OR f.value < yhat_lower AS residual_anomaly, n.pos IS NULL AS cluster_anomaly
FROM fit f JOIN rl ON f.event_type = rl.event_type AND f.pos = rl.pos LEFT JOIN near_core n ON f.event_type = n.event_type AND f.pos = n.pos""")
def _(spark, sf):
    out = workflows.detect_all(hourly(spark, sf), KEY, "event_type", "ts", "value", rules=(EVENT_RULES[0], EVENT_RULES[2]), baseline="seasonal")
    return rounded(out.select("event_type", "ts", "value", "threshold_anomaly", "residual_anomaly", "cluster_anomaly"), "value")


@query("G6_ensemble_with_outliers")
def _(spark, sf):
    outliers = detect.multivariate_outliers(wide(spark, sf), ["ts"], METRICS)
    out = workflows.ensemble(hourly(spark, sf), KEY, "ts", "value", outliers=outliers, outlier_on=["ts"])
    return out.select("event_type", "ts", "value", "anomaly_threshold", "anomaly_trend", "is_outlier", "anomaly_score", "final_anomaly")


# -- streams

def _stream(spark, sf):
    events = table(spark, sf, "events")
    return live.read_stream(spark, sf, events.schema, "ts", glob="events.parquet")


@query("X1_stream_resample", """SELECT event_type, date_trunc('hour', ts) AS ts, round(avg(value), 6) AS value, count(*)::BIGINT AS n FROM events GROUP BY 1, 2
    HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def _(spark, sf):
    out = live.run_to_table(live.resample_stream(_stream(spark, sf), KEY, "ts", "value"))
    return rounded(out.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "value")


@query("X2_stream_alerts", """SELECT event_id, CASE WHEN event_type = 'click' AND value < 5 THEN 'click_value < 5' WHEN event_type = 'click' AND value > 60 THEN 'click_value > 60'
  WHEN event_type = 'view' AND value < 10 THEN 'view_value < 10' WHEN event_type = 'view' AND value > 40 THEN 'view_value > 40'
  WHEN event_type = 'error' AND value < 2 THEN 'error_value < 2' ELSE 'error_value > 150' END AS threshold_reason,
 CASE WHEN value < CASE event_type WHEN 'click' THEN 5 WHEN 'view' THEN 10 ELSE 2 END THEN 'high' ELSE 'medium' END AS threshold_severity FROM events
 WHERE (event_type = 'click' AND (value < 5 OR value > 60)) OR (event_type = 'view' AND (value < 10 OR value > 40)) OR (event_type = 'error' AND (value < 2 OR value > 150))""")
def _(spark, sf):
    out = live.run_to_table(live.alert_stream(_stream(spark, sf), "event_type", "value", [(*r[:4], 0) for r in EVENT_RULES]))
    return out.select("event_id", "threshold_reason", "threshold_severity")


@query("X3_stream_sustained_alerts", RULES_SQL + " SELECT event_id, threshold_reason, threshold_severity FROM rules WHERE threshold_reason <> ''")
def _(spark, sf):
    out = live.run_sustained_alerts(_stream(spark, sf), KEY, "event_type", "ts", "value", ["event_id"], EVENT_RULES)
    return out.select("event_id", "threshold_reason", "threshold_severity")
