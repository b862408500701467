"""Whole analyses over many series at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidewatch.functions.constants import THRESHOLD_RULES, VALIDATION_RULES
from tidewatch.functions.scalar import no_nan, to_number, to_time
from tidewatch.operators import clean, cluster, detect, features, grid, trend
from tidewatch.operators.fill import fill_gaps
from tidewatch.operators.profile import is_missing
from tidewatch.operators.vote import join_flags, vote
from tidewatch.plans.chunks import attach, match, with_position
from tidewatch.plans.staging import stage
from tidewatch.sources import writers
from tidewatch.sources.roles import ensure_timestamp, numeric_columns, synthetic_times, to_long


def prepare(df: DataFrame, keys: Sequence[str], ts: str, numeric: Sequence[str], other: Sequence[str] = (),
            order: Sequence[str] = (), max_null_pct: float = 90, drop_duplicates: bool = True, outlier_z: float = 4.0,
            freq: str | None = None, fill: str = "interpolate", window: int = 60, z: float = 3.5,
            detect_on: str | None = None, **kw) -> DataFrame:
    """G1: drop sparse and duplicate rows, null outliers, interpolate by row position, then
    optionally resample and fill, then flag by the rolling z-score.

    ``order`` completes ``ts`` to a unique row order within a series.
    """
    keys, numeric, other = list(keys), list(numeric), list(other)
    rows = clean.drop_sparse_rows(df, max_null_pct)
    if drop_duplicates:
        rows = clean.drop_duplicate_rows(rows)
    rows = clean.null_outliers(rows, numeric, outlier_z, keys)
    rows = with_position(rows.filter(F.col(ts).isNotNull()), keys, [ts, *order])
    rows = fill_gaps(rows, keys, "pos", numeric, "interpolate_both", **kw)
    if freq:
        rows = grid.resample_mixed(rows, keys, ts, freq, numeric, other, fill, tie=order[0] if order else None, **kw)
    return detect.rolling_zscore(rows, keys, detect_on or numeric[0], window, z, flag="is_anomaly", **kw)


def prepare_and_report(df: DataFrame, keys: Sequence[str] = (), ts: str | None = None, numeric: Sequence[str] | None = None,
                       other: Sequence[str] = (), order: Sequence[str] = (), out: str | None = None, fmt: str = "csv",
                       max_null_pct: float = 90, drop_duplicates: bool = True, rules=VALIDATION_RULES, **kw) -> dict[str, DataFrame]:
    """G1 from the raw table to the written one: finds the timestamp, profiles, validates, cleans, grids, flags and writes.

    The profile costs no pass of its own: what it counts is observed while the different rows are written for the steps that
    follow, so the input is scanned once (twice where the timestamp must be looked for). Returns "rows", the prepared
    rows, read from ``out`` if it is given ("csv", "json" or "parquet"); "profile", a row per column with its type, missing and present values and
    range; "summary", one row with the table's shape, duplicates, missing cells, rows kept and rows written; and "issues", the number of
    values that break each rule.
    """
    spark, keys = df.sparkSession, list(keys)
    timed, found = (df, ts) if ts is not None else ensure_timestamp(df)
    if found is None:
        timed, found = synthetic_times(df, order), "timestamp"
    ranged = numeric_columns(timed)
    numeric = list(numeric) if numeric is not None else [c for c in ranged if c not in (*keys, *order)]
    checks = [(col, low, high, issue) for col, low, high, issue in rules if col in timed.columns]
    seen, different, kept, written = (Observation(n) for n in ("seen", "different", "kept", "written"))
    number = lambda c: no_nan(F.col(c).cast("double"))
    broken = lambda c, low, high: F.coalesce(((number(c) < F.lit(low)) if low is not None else F.lit(False)) | ((number(c) > F.lit(high)) if high is not None else F.lit(False)), F.lit(False))
    raw = timed.observe(seen, F.count(F.lit(1)).alias("n"), *[F.count_if(is_missing(timed, c)).alias(f"m{i}") for i, c in enumerate(timed.columns)],
                        *[f(number(c)).alias(f"{a}{i}") for i, c in enumerate(ranged) for a, f in (("lo", F.min), ("hi", F.max))],
                        *[F.count_if(broken(c, low, high)).alias(f"b{i}") for i, (c, low, high, _) in enumerate(checks)])
    unique = raw.groupBy(*timed.columns).agg(F.count(F.lit(1)).alias("_copies")).observe(different, F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("n"))
    if not drop_duplicates:
        unique = unique.withColumn("_copies", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    rows = stage(clean.drop_sparse_rows(unique.select(*timed.columns), max_null_pct).observe(kept, F.count(F.lit(1)).alias("n")), "different")
    done = prepare(rows, keys, found, numeric, other, order, 0, False, **kw).observe(written, F.count(F.lit(1)).alias("n"))
    done = _written(done, out, fmt)
    got, n = seen.get, seen.get["n"]
    place = {c: i for i, c in enumerate(ranged)}
    profile = [(c, t, got[f"m{i}"], n - got[f"m{i}"], round(got[f"m{i}"] / n * 100, 2) if n else None,
                got[f"lo{place[c]}"] if c in place else None, got[f"hi{place[c]}"] if c in place else None) for i, (c, t) in enumerate(timed.dtypes)]
    return {
        "rows": done,
        "profile": spark.createDataFrame(profile, "column string, dtype string, missing_count bigint, present_count bigint, missing_pct double, min_value double, max_value double"),
        "summary": spark.createDataFrame([(found, n, len(timed.columns), different.get["n"], sum(p[2] for p in profile), kept.get["n"], written.get["n"])],
                                         "timestamp_column string, n_rows bigint, n_columns bigint, duplicates bigint, missing_cells bigint, rows_kept bigint, rows_written bigint"),
        "issues": spark.createDataFrame([(c, issue, got[f"b{i}"]) for i, (c, _, _, issue) in enumerate(checks)], "column string, issue string, n bigint")}


def _written(df: DataFrame, out: str | None, fmt: str) -> DataFrame:
    """``df`` as a table that is read from where it was written."""
    if out is None:
        return stage(df, "prepared")
    spark = df.sparkSession
    if fmt == "csv":
        writers.write_csv(df, out)
        return spark.read.schema(df.schema).options(header=True, **writers.TIME_OPTIONS).csv(out)
    if fmt == "json":
        writers.write_json(df, out)
        return spark.read.schema(df.schema).options(**writers.TIME_OPTIONS).json(out)
    if fmt != "parquet":
        raise ValueError(f"unsupported format {fmt!r}")
    df.write.parquet(out)
    return spark.read.schema(df.schema).parquet(out)


def preprocess(df: DataFrame, keys: Sequence[str] = (), order: Sequence[str] = (),
               metrics: Sequence[str] | None = None) -> DataFrame:
    """Find or make the timestamp, fill numeric NULLs by the median, drop duplicates,
    return long rows (keys, timestamp, metric, source_column, value)."""
    keys = list(keys)
    timed, ts = ensure_timestamp(df, mode="substring")
    if ts is None:
        timed = synthetic_times(df, order)
    elif ts != "timestamp":
        timed = timed.withColumnRenamed(ts, "timestamp")
    cols = list(metrics) if metrics is not None else [c for c in numeric_columns(timed) if c not in (*keys, "timestamp")]
    filled = clean.drop_duplicate_rows(clean.fill_median(timed, cols, keys))
    return to_long(filled, [*keys, "timestamp"], cols)


def clean_resample(df: DataFrame, keys: Sequence[str], ts: str, metrics: Sequence[str], freq: str = "1h",
                   order: Sequence[str] = (), **kw) -> DataFrame:
    """Parse times and numbers, interpolate by row position, mean per bin, fill again."""
    keys, metrics = list(keys), list(metrics)
    if grid.ALIASES.get(freq, freq) not in ("1h", "30min", "1D", "1W"):
        freq = "1h"
    is_text = dict(df.dtypes)[ts] == "string"
    rows = df.withColumns({**({ts: to_time(F.col(ts))} if is_text else {}), **{m: to_number(F.col(m)) for m in metrics}})
    rows = with_position(rows.filter(F.col(ts).isNotNull()), keys, [ts, *order])
    rows = fill_gaps(rows, keys, "pos", metrics, "chain", **kw)
    return grid.resample(rows, keys, ts, freq, {m: F.avg(no_nan(F.col(m))) for m in metrics}, "chain", **kw)


def parse_single_file(df: DataFrame, ts: str = "timestamp", keys: Sequence[str] = ()) -> DataFrame:
    """One wide table to long (keys, metric, timestamp, value): heart_rate as it is, step_count
    summed to 5 minutes with empty bins 0, duration_minutes summed per day."""
    if ts not in df.columns:
        raise ValueError(f"the table must have a {ts!r} column")
    keys = list(keys)
    time = F.to_timestamp_ntz(ts) if dict(df.dtypes)[ts] == "string" else F.col(ts)
    rows = df.withColumn(ts, time)
    parts = []
    if "heart_rate" in df.columns:
        parts.append(rows.filter(F.col("heart_rate").isNotNull()).select(
            *keys, F.lit("heart_rate").alias("metric"), ts, F.col("heart_rate").cast("double").alias("value")))
    if "step_count" in df.columns:
        steps = grid.resample_sum(rows.filter(F.col("step_count").isNotNull()), keys, ts, "step_count", "5min")
        parts.append(steps.select(*keys, F.lit("steps").alias("metric"), ts, F.col("step_count").alias("value")))
    if "duration_minutes" in df.columns:
        sleep = grid.daily_sum(rows.filter(F.col("duration_minutes").isNotNull()), keys, ts, "duration_minutes")
        parts.append(sleep.select(*keys, F.lit("sleep").alias("metric"), ts, F.col("duration_minutes").alias("value")))
    if not parts:
        return rows.select(*keys, F.lit("").alias("metric"), ts, F.lit(0.0).alias("value")).filter(F.lit(False))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def analyze(long: DataFrame, keys: Sequence[str], metric: str, ts: str, value: str, pos: str = "pos", size: int = 60,
            k: int = 4, method: str = "kmeans", baseline: str = "seasonal", seed: int = 42,
            n_init: int = 10) -> dict[str, DataFrame]:
    """Window features with clusters, trend anomalies, and one report row per metric: anomalies, patterns
    (clusters), features that vary, windows, silhouette, Davies-Bouldin and their band, and how well the trend fits.

    ``long`` must be gridded and filled. All metrics run together, however many there are. A metric with fewer windows than
    clusters has 0 patterns and a ``reason``.
    """
    keys = list(keys)
    long = stage(long, "series")
    feats = stage(features.impute_features(features.window_features(long, keys, value, size, pos), keys=[metric]), "features")
    varied = [(F.stddev_samp(c) != 0).cast("int") for c in features.FEATURES]
    varies = varied[0]
    for v in varied[1:]:
        varies = varies + F.coalesce(v, F.lit(0))
    counts = stage(feats.groupBy(metric).agg(F.count(F.lit(1)).alias("windows"), F.coalesce(varies, F.lit(0)).cast("bigint").alias("features")), "counts")
    able = attach(feats, counts, [metric]).filter((F.col("windows") >= k) & (F.col("features") > 0))
    # a feature that doesn't vary in a metric is 0 everywhere once standardized, and moves nothing there
    z, zs = clean.standardize(able, features.FEATURES, [metric], "_z"), [f"{c}_z" for c in features.FEATURES]
    if method == "kmeans":
        clustered = cluster.kmeans(able, features.FEATURES, k, seed, n_init, keys=[metric]).select(*feats.columns, "cluster")
    else:
        clustered = _by_density(z, zs, metric).select(*feats.columns, "cluster")
    clustered = stage(clustered, "clustered")
    z = stage(clean.standardize(clustered, features.FEATURES, [metric], "_z").select(metric, "cluster", *zs), "scaled")
    scored = stage(detect.residual_scores(trend.predict(long, keys, ts, value, baseline, pos), keys, metric), "scored")
    ratings = match(cluster.silhouette(z, "cluster", zs, keys=[metric]).select(metric, "silhouette"), cluster.davies_bouldin(z, "cluster", zs, [metric]), [metric])
    report = scored.groupBy(metric).agg(F.count_if("residual_anomaly").alias("anomalies"))
    patterns = clustered.groupBy(metric).agg(F.count_distinct("cluster").alias("patterns"))
    for part in (patterns, counts, ratings, trend.fit_metrics(scored, [metric], value, pos=pos)):
        report = match(report, part, [metric], "left")
    zero = F.lit(0).cast("bigint")
    report = report.withColumns({"patterns": F.coalesce("patterns", zero), "features": F.coalesce("features", zero), "windows": F.coalesce("windows", zero)})
    report = report.withColumns({
        "quality": F.when(F.col("silhouette").isNotNull(), cluster.quality(F.col("silhouette"), F.col("davies_bouldin"))),
        "reason": F.when(F.col("windows") < k, F.format_string("%d rows, %s needed", "windows", F.lit(str(k))))})
    return {"features": feats, "clusters": clustered, "scored": scored, "report": report,
            "sizes": clustered.groupBy(metric, "cluster").agg(F.count(F.lit(1)).alias("size")),
            "insights": cluster.insights(clustered, [metric], "cluster", features.FEATURES, F.col(metric))}


def _by_density(z: DataFrame, zs: Sequence[str], metric: str) -> DataFrame:
    """Density clusters per metric; a metric needs a tenth of its windows, 1 to 5, to be dense, and metrics of one such number run together."""
    sized = attach(z, z.groupBy(metric).agg(F.greatest(F.lit(1), F.least(F.lit(5), F.floor(F.count(F.lit(1)) / 10))).cast("int").alias("_least")), [metric])
    sized, out = stage(sized, "dense"), None
    for least in range(1, 6):
        part = detect.dbscan(sized.filter(F.col("_least") == least), [metric], zs, 0.5, least)
        out = part if out is None else out.unionByName(part)
    return out


def behaviour(df: DataFrame, row_key: Sequence[str], cols: Sequence[str], k: int = 3, eps: float = 0.5, min_samples: int = 5,
              contamination: float = 0.1, seed: int = 42, n_init: int = 10) -> DataFrame:
    """Rows of several metrics side by side with kmeans_cluster, density_cluster, is_outlier_dbscan, is_outlier_iso,
    is_outlier and pca1 to pca3, all of the standardized ``cols``. Rows with a missing metric must be filled before."""
    rows = cluster.kmeans(df, cols, k, seed, n_init, label="kmeans_cluster")
    z, zs = cluster.scaled(rows, cols)
    dense = detect.dbscan(z, [], zs, eps, min_samples).drop("is_core").withColumnsRenamed({"is_noise": "is_outlier_dbscan", "cluster": "density_cluster"})
    apart = detect.isolation_outliers(dense, row_key, zs, contamination, seed).drop("iso_score", *zs)
    out = apart.withColumn("is_outlier", F.col("is_outlier_dbscan") | F.col("is_outlier_iso"))
    return cluster.pca(out, cols, 3)


def detect_all(long: DataFrame, keys: Sequence[str], metric: str, ts: str, value: str, pos: str = "pos",
               rules=THRESHOLD_RULES, residual_k: float = 3.0, eps: float = 0.5, min_samples: int = 5,
               period: int | None = None, baseline: str = "decompose") -> DataFrame:
    """Threshold, residual and density flags on every reading of every metric. ``baseline``: what the
    residuals are taken from; "local" is the robust decomposition, the trend fits ("seasonal", "fourier") fall back to "decompose" for
    short series."""
    keys = list(keys)
    flagged = detect.threshold_rules(long, keys, metric, value, rules, pos)
    whole = fill_gaps(long, keys, pos, [value], "chain")
    if baseline == "decompose":
        season = trend.decompose(whole, keys, value, pos, period)
    else:
        season = trend.predict(whole, keys, ts, value, baseline, pos).withColumnRenamed("yhat", "predicted")
    joined = match(flagged, season.select(*keys, pos, "predicted", "yhat_lower", "yhat_upper"), [*keys, pos], "left")
    banded = stage(detect.residual_band(joined, keys, value, k=residual_k, pos=pos), "banded")
    dense = detect.density_outliers(banded.select(*keys, pos, value), keys, value, eps, min_samples, pos).select(
        *keys, pos, "cluster", "cluster_anomaly")
    return match(banded, dense, [*keys, pos], "left").withColumn(
        "cluster_anomaly", F.coalesce("cluster_anomaly", F.lit(False)))


def ensemble(grid_df: DataFrame, keys: Sequence[str], ts: str, value: str, pos: str = "pos", sigma: float = 2.0,
             baseline: str = "seasonal", outliers: DataFrame | None = None, outlier_on: Sequence[str] = (),
             policy: str = "vote") -> DataFrame:
    """K-sigma and trend flags, an outlier flag if given (absent = false), and the vote."""
    rows = stage(grid_df, "grid")  # read by the statistics, the fit and the result
    fitted = trend.predict(rows, keys, ts, value, baseline, pos)
    flagged = detect.residual_two_sigma(fitted, keys)
    flagged = detect.global_sigma(flagged, keys, value, sigma)
    if outliers is not None:
        flagged = join_flags(flagged, outliers.select(*outlier_on, "is_outlier"), outlier_on)
    else:
        flagged = flagged.withColumn("is_outlier", F.lit(False))
    return vote(flagged, ["anomaly_threshold", "anomaly_trend", "is_outlier"], policy=policy)
