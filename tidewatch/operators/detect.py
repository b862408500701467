"""Anomaly detectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.constants import (
    RESIDUAL_CUT_DEFAULT, RESIDUAL_CUTS, RESIDUAL_REASON, SEVERITY_BANDS, SEVERITY_BANDS_DEFAULT, THRESHOLD_RULES)
from tidewatch.functions.scalar import safe_div
from tidewatch.operators.clean import standardize
from tidewatch.operators.cluster import with_enough_rows
from tidewatch.operators.density import dbscan
from tidewatch.operators.fill import fill_gaps
from tidewatch.operators.forest import isolation_outliers
from tidewatch.operators.rolling import centered_stats, trailing_stats
from tidewatch.plans.chunks import attach, over_rows


def _by_metric(metric: Column, values: Mapping[str, float], default: float) -> Column:
    out = None
    for name, v in values.items():
        out = F.when(metric == name, F.lit(float(v))) if out is None else out.when(metric == name, F.lit(float(v)))
    return F.lit(float(default)) if out is None else out.otherwise(F.lit(float(default)))


def rolling_zscore(df: DataFrame, keys: Sequence[str], value: str, rows: int = 60, z: float = 3.5, pos: str = "pos",
                   flag: str = "rolling_anomaly", **kw) -> DataFrame:
    """More than ``z`` centered population deviations from the centered mean."""
    framed = centered_stats(df, keys, value, rows, pos, **kw)
    score = F.abs(safe_div(F.col(value) - F.col("center_mean"), F.col("center_std")))
    return framed.withColumn(flag, F.coalesce(score > z, F.lit(False))).drop("center_mean", "center_std")


def global_sigma(df: DataFrame, keys: Sequence[str], value: str, k: float = 2.0, flag: str = "anomaly_threshold") -> DataFrame:
    """Outside mean +/- k sample deviations of the series."""
    stats = df.groupBy(*keys).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std"))
    v = F.col(value)
    out = (v > F.col("_mean") + k * F.col("_std")) | (v < F.col("_mean") - k * F.col("_std"))
    return attach(df, stats, keys).withColumn(flag, F.coalesce(out, F.lit(False))).drop("_mean", "_std")


def threshold_rules(df: DataFrame, keys: Sequence[str], metric: str, value: str, rules=THRESHOLD_RULES,
                    pos: str = "pos", **kw) -> DataFrame:
    """Rule per metric (name in the reason, low, high, consecutive rows; 0 = at once).

    A sustained rule fires from the k-th consecutive row on. Sustained: above is high,
    below is medium; at once: above is medium, below is high; below wins.
    """
    v, m = F.col(value).cast("double"), F.col(metric)
    above, below = F.lit(False), F.lit(False)
    for name, _, low, high, _ in rules:
        above = above | ((m == name) & (v > F.lit(float(high))))
        below = below | ((m == name) & (v < F.lit(float(low))))
    framed = df.withColumns({"_above": F.coalesce(above, F.lit(False)).cast("int"),
                             "_below": F.coalesce(below, F.lit(False)).cast("int")})
    runs = sorted({k for *_, k in rules if k > 0})
    exprs = {}
    for k in runs:
        for side in ("above", "below"):
            exprs[f"_{side}_{k}"] = lambda w, k=k, s=side: F.sum(f"_{s}").over(w.rowsBetween(-(k - 1), 0)) >= k
    if exprs:
        framed = over_rows(framed, keys, pos, exprs, before=max(runs) - 1, **kw)
    reason, severity = F.lit(""), F.lit("normal")
    for name, label, low, high, k in rules:
        mine = m == name
        if k > 0:
            up, down, note, sev_up, sev_down = F.col(f"_above_{k}"), F.col(f"_below_{k}"), " (sustained)", "high", "medium"
        else:
            up, down, note, sev_up, sev_down = F.col("_above") == 1, F.col("_below") == 1, "", "medium", "high"
        reason = F.when(mine & down, f"{label} < {low}{note}").when(mine & up, f"{label} > {high}{note}").otherwise(reason)
        severity = F.when(mine & down, sev_down).when(mine & up, sev_up).otherwise(severity)
    return framed.withColumns({"threshold_reason": reason, "threshold_severity": severity}).withColumn(
        "threshold_anomaly", F.col("threshold_severity") != "normal").select(
        *df.columns, "threshold_anomaly", "threshold_reason", "threshold_severity")


def _with_residual_std(df: DataFrame, keys: Sequence[str], residual: str) -> DataFrame:
    """Sample std of the residuals per series; baselines bring it along."""
    if "residual_std" in df.columns:
        return df
    return attach(df, df.groupBy(*keys).agg(F.stddev_samp(residual).alias("residual_std")), keys)


def residual_two_sigma(df: DataFrame, keys: Sequence[str], residual: str = "residual", k: float = 2.0,
                       flag: str = "anomaly_trend") -> DataFrame:
    """|residual| above k sample deviations of the series' residuals."""
    return _with_residual_std(df, keys, residual).withColumn(
        flag, F.coalesce(F.abs(residual) > k * F.col("residual_std"), F.lit(False)))


def severity(metric: Column, score: Column) -> Column:
    """Low, Medium, High; bands closed on the right; NULL for scores not above 0."""
    low = _by_metric(metric, {m: b[0] for m, b in SEVERITY_BANDS.items()}, SEVERITY_BANDS_DEFAULT[0])
    mid = _by_metric(metric, {m: b[1] for m, b in SEVERITY_BANDS.items()}, SEVERITY_BANDS_DEFAULT[1])
    return F.when(score <= 0, None).when(score <= low, "Low").when(score <= mid, "Medium").when(score > mid, "High")


def residual_scores(df: DataFrame, keys: Sequence[str], metric: str, residual: str = "residual",
                    cuts: Mapping[str, float] = RESIDUAL_CUTS, default: float = RESIDUAL_CUT_DEFAULT) -> DataFrame:
    """Adds anomaly_score = |residual| / sample std, residual_anomaly (above the
    metric's cut; never where the std is 0) and severity of the anomalous rows."""
    scored = _with_residual_std(df, keys, residual).withColumn(
        "anomaly_score", safe_div(F.abs(residual), F.col("residual_std")))
    flagged = scored.withColumn("residual_anomaly", F.coalesce(
        F.col("anomaly_score") > _by_metric(F.col(metric), cuts, default), F.lit(False)))
    return flagged.withColumn("severity", F.when(F.col("residual_anomaly"), severity(F.col(metric), F.col("anomaly_score"))))


def residual_band(df: DataFrame, keys: Sequence[str], value: str, predicted: str = "predicted", k: float = 3.0,
                  pos: str = "pos", **kw) -> DataFrame:
    """Residual further than k population deviations from its mean, or value outside
    the prediction band. Missing predictions take the last, then the next one; missing
    bounds take prediction -/+ 1."""
    filled = fill_gaps(df, keys, pos, [predicted], "nearest", **kw)
    p, v = F.col(predicted), F.col(value)
    filled = filled.withColumns({"yhat_lower": F.coalesce("yhat_lower", p - 1.0), "yhat_upper": F.coalesce("yhat_upper", p + 1.0),
                                 "residual": v - p})
    stats = filled.groupBy(*keys).agg(F.avg("residual").alias("residual_mean"), F.stddev_pop("residual").alias("_std"))
    stats = stats.withColumn("residual_std", F.when(F.col("_std") == 0, 1.0).otherwise(F.col("_std"))).drop("_std")
    far = F.abs(F.col("residual") - F.col("residual_mean")) > k * F.col("residual_std")
    outside = (v > F.col("yhat_upper")) | (v < F.col("yhat_lower"))
    out = attach(filled, stats, keys).withColumn(
        "residual_anomaly", F.coalesce(far, F.lit(False)) | F.coalesce(outside, F.lit(False)))
    return out.withColumn("residual_reason", F.when(F.col("residual_anomaly"), RESIDUAL_REASON).otherwise(""))


DENSITY_FEATURES = ("value", "roll_mean_5", "roll_std_5")


def density_features(df: DataFrame, keys: Sequence[str], value: str, pos: str = "pos", **kw) -> DataFrame:
    """N9 inputs: the gap-filled value, its trailing 5-row mean and std (NULL as 0), standardized per series."""
    filled = fill_gaps(df, keys, pos, [value], "nearest", **kw)
    rolled = trailing_stats(filled.withColumn("_value", F.col(value)), keys, "_value", 5, pos, std_null=0.0, **kw)
    feats = rolled.withColumns({"f0": F.coalesce("_value", F.lit(0.0)), "f1": F.coalesce("roll_mean_5", F.lit(0.0)),
                                "f2": F.coalesce("roll_std_5", F.lit(0.0))}).drop("_value", "roll_mean_5", "roll_std_5")
    return standardize(feats, ["f0", "f1", "f2"], keys, suffix="_z").drop("f0", "f1", "f2")


def density_outliers(df: DataFrame, keys: Sequence[str], value: str, eps: float = 0.5, min_samples: int = 5,
                     pos: str = "pos", labels: bool = True, **kw) -> DataFrame:
    """Density noise of (value, rolling mean, rolling std) per series; series shorter
    than max(10, min_samples) are left unflagged."""
    enough = with_enough_rows(df, keys, max(10, min_samples))
    feats = density_features(enough, keys, value, pos, **kw)
    out = dbscan(feats, keys, ["f0_z", "f1_z", "f2_z"], eps, min_samples, labels).drop("f0_z", "f1_z", "f2_z", "is_core")
    return out.withColumnRenamed("is_noise", "cluster_anomaly")


def multivariate_outliers(df: DataFrame, row_key: Sequence[str], cols: Sequence[str], eps: float = 0.5,
                          min_samples: int = 5, contamination: float = 0.1, seed: int = 42,
                          by_density: bool = True, by_isolation: bool = True) -> DataFrame:
    """Rows that are density noise or isolated in the standardized metrics."""
    z = standardize(df, cols, suffix="_z")
    zs = [f"{c}_z" for c in cols]
    if by_density:
        z = dbscan(z, [], zs, eps, min_samples, labels=False).withColumnRenamed("is_noise", "is_outlier_dbscan").drop("is_core")
    else:
        z = z.withColumn("is_outlier_dbscan", F.lit(False))
    if by_isolation:
        z = isolation_outliers(z, row_key, zs, contamination, seed).drop("iso_score")
    else:
        z = z.withColumn("is_outlier_iso", F.lit(False))
    return z.withColumn("is_outlier", F.col("is_outlier_dbscan") | F.col("is_outlier_iso")).drop(*zs)
