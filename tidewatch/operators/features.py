"""Features of overlapping windows.

A window has a fixed, small number of rows, so one shuffle to (series, window_id)
aggregates everything: order-free features as plain aggregates, order-dependent ones
from the window's values as a sorted array. Two of them, the pairwise entropy and the
spectrum, are computed on whole Arrow batches of such arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalar import moment_kurtosis, moment_skew, safe_div
from tidewatch.operators.quantile import exact_quantiles
from tidewatch.operators.rolling import overlapping_windows
from tidewatch.plans.chunks import attach

FEATURES = (
    "mean", "median", "standard_deviation", "variance", "minimum", "maximum", "mean_abs_change", "mean_change",
    "skewness", "kurtosis", "quantile_25", "quantile_50", "quantile_75", "abs_energy", "absolute_sum_of_changes",
    "count_above_mean", "count_below_mean", "longest_strike_above_mean", "longest_strike_below_mean",
    "linear_trend_slope", "linear_trend_intercept", "autocorrelation_lag_1", "autocorrelation_lag_2",
    "autocorrelation_lag_5", "approximate_entropy", "cid_ce", "number_peaks", "range_count",
    "ratio_beyond_r_sigma", "fft_centroid", "time_reversal_asymmetry",
)


def _by_length(windows: pd.Series) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the windows of each length; a batch has few lengths, mostly one."""
    sizes = windows.map(len).to_numpy()
    return [(at, np.stack(windows.iloc[at].to_list()).astype(float)) for n in np.unique(sizes) if n for at in [np.flatnonzero(sizes == n)]]


def _phi(x: np.ndarray, m: int, tol: np.ndarray) -> np.ndarray:
    """Mean log share of the m-runs of each row that are within the row's tolerance of each m-run."""
    n = x.shape[1] - m + 1
    far = np.zeros((len(x), n, n))
    for k in range(m):
        part = x[:, k:k + n]
        np.maximum(far, np.abs(part[:, :, None] - part[:, None, :]), out=far)
    return np.log((far <= tol[:, None, None]).mean(axis=2)).mean(axis=1)


ENTROPY_CELLS = 1 << 22  # distances held at a time


@F.pandas_udf(T.DoubleType())
def approximate_entropy(windows: pd.Series, m: pd.Series, r: pd.Series) -> pd.Series:
    """|phi(m) - phi(m+1)| with tolerance r * population std, self-matches counted."""
    out = np.zeros(len(windows))
    orders, shares = m.to_numpy(dtype=int), r.to_numpy(dtype=float)
    for at, x in _by_length(windows):
        for order in np.unique(orders[at]):
            mine = orders[at] == order
            rows, places, n = x[mine], at[mine], x.shape[1]
            if n <= order + 1:
                continue
            tol = shares[places] * rows.std(axis=1)
            step = max(1, ENTROPY_CELLS // (n * n))
            for i in range(0, len(rows), step):
                part = slice(i, i + step)
                out[places[part]] = np.abs(_phi(rows[part], order, tol[part]) - _phi(rows[part], order + 1, tol[part]))
    return pd.Series(out)


@F.pandas_udf(T.DoubleType())
def fft_centroid(windows: pd.Series) -> pd.Series:
    """Centre of mass of the absolute real spectrum."""
    out = np.full(len(windows), np.nan)
    for at, x in _by_length(windows):
        a = np.abs(np.fft.rfft(x, axis=1))
        total = a.sum(axis=1)
        some = total > 0
        out[at[some]] = (a[some] @ np.arange(a.shape[1])) / total[some]
    return pd.Series(out)


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def _shifted(a: Column, n: Column, lag: int) -> tuple[Column, Column]:
    """(x_t, x_{t+lag}) as two aligned arrays."""
    keep = F.greatest(n - lag, F.lit(0))
    return F.slice(a, F.lit(1), keep), F.slice(a, F.lit(lag + 1), keep)


def _longest_run(flags: Column) -> Column:
    zero = F.struct(F.lit(0).alias("cur"), F.lit(0).alias("best"))

    def step(s: Column, hit: Column) -> Column:
        cur = F.when(hit, s["cur"] + 1).otherwise(0)
        return F.struct(cur.alias("cur"), F.greatest(s["best"], cur).alias("best"))

    return F.aggregate(flags, zero, step, lambda s: s["best"])


def _peaks(a: Column, n: Column, support: int) -> Column:
    """Points strictly above ``support`` neighbours on each side, all of which exist."""
    places = F.when(n > 2 * support, F.sequence(F.lit(support), n - 1 - support)).otherwise(F.array().cast("array<int>"))

    def is_peak(i: Column) -> Column:
        ok = F.lit(True)
        for d in range(1, support + 1):
            ok = ok & (F.get(a, i) > F.get(a, i - d)) & (F.get(a, i) > F.get(a, i + d))
        return ok

    return F.size(F.filter(places, is_peak))


def window_features(df: DataFrame, keys: Sequence[str], value: str, size: int = 60, pos: str = "pos") -> DataFrame:
    """One row per (series, window) with every feature of ``FEATURES``."""
    windows = overlapping_windows(df.select(*keys, pos, value), keys, size, pos)
    return features_of(windows, [*keys, "window_id"], value, "i")


def features_of(df: DataFrame, group: Sequence[str], value: str, index: str) -> DataFrame:
    """F1-F31 of each group of rows; ``index`` counts from 0 within the group. Groups must be small."""
    x, i = F.col(value).cast("double"), F.col(index).cast("double")
    n = F.count(x)
    base = df.groupBy(*group).agg(
        n.alias("n"), F.avg(x).alias("mean"), F.median(x).alias("median"), F.stddev_pop(x).alias("standard_deviation"),
        F.var_pop(x).alias("variance"), F.min(x).alias("minimum"), F.max(x).alias("maximum"),
        moment_skew(n, x).alias("skewness"), moment_kurtosis(n, x).alias("kurtosis"),
        F.percentile(x, 0.25).alias("quantile_25"), F.percentile(x, 0.5).alias("quantile_50"),
        F.percentile(x, 0.75).alias("quantile_75"), F.sum(x * x).alias("abs_energy"),
        F.regr_slope(x, i).alias("linear_trend_slope"), F.regr_intercept(x, i).alias("linear_trend_intercept"),
        F.count_if((x >= -1) & (x < 1)).alias("range_count"),
        F.sort_array(F.collect_list(F.struct(i.alias("i"), x.alias("x")))).alias("_ix"),
    ).withColumn("_a", F.col("_ix")["x"])
    a, size, mean, sd = F.col("_a"), F.col("n").cast("int"), F.col("mean"), F.col("standard_deviation")
    left, right = _shifted(a, size, 1)
    base = base.withColumn("_d", F.zip_with(left, right, lambda p, q: q - p))
    d = F.col("_d")

    def autocorrelation(lag: int) -> Column:
        p, q = _shifted(a, size, lag)
        products = _total(F.zip_with(p, q, lambda u, v: (u - mean) * (v - mean)))
        return F.when(size > lag, safe_div(products, (size - lag).cast("double") * F.col("variance")))

    low, _ = _shifted(a, size, 2)
    mid = F.slice(a, F.lit(2), F.greatest(size - 2, F.lit(0)))
    high = F.slice(a, F.lit(3), F.greatest(size - 2, F.lit(0)))
    asymmetry = _total(F.zip_with(F.zip_with(low, mid, lambda p, q: F.struct(p.alias("p"), q.alias("q"))), high,
                                  lambda s, h: h * h * s["q"] - s["q"] * s["p"] * s["p"]))
    moves = _total(F.transform(d, lambda v: F.abs(v)))
    squares = _total(F.transform(d, lambda v: v * v))
    out = base.withColumns({
        "absolute_sum_of_changes": moves,
        "mean_abs_change": safe_div(moves, (size - 1).cast("double")),
        "mean_change": safe_div(F.element_at(a, -1) - F.element_at(a, 1), (size - 1).cast("double")),
        "count_above_mean": F.size(F.filter(a, lambda v: v > mean)).cast("bigint"),
        "count_below_mean": F.size(F.filter(a, lambda v: v < mean)).cast("bigint"),
        "longest_strike_above_mean": _longest_run(F.transform(a, lambda v: v > mean)).cast("bigint"),
        "longest_strike_below_mean": _longest_run(F.transform(a, lambda v: v < mean)).cast("bigint"),
        "autocorrelation_lag_1": autocorrelation(1),
        "autocorrelation_lag_2": autocorrelation(2),
        "autocorrelation_lag_5": autocorrelation(5),
        "approximate_entropy": approximate_entropy(a, F.lit(2), F.lit(0.2)),
        "cid_ce": F.when(sd == 0, F.lit(0.0)).otherwise(safe_div(F.sqrt(squares), sd)),
        "number_peaks": _peaks(a, size, 3).cast("bigint"),
        "ratio_beyond_r_sigma": F.size(F.filter(a, lambda v: F.abs(v - mean) > 2.0 * sd)) / size.cast("double"),
        "fft_centroid": fft_centroid(a),
        "time_reversal_asymmetry": F.when(size > 2, safe_div(asymmetry, (size - 2).cast("double"))).otherwise(F.lit(0.0)),
    })
    return out.select(*group, *FEATURES)


def impute_features(df: DataFrame, features: Sequence[str] = FEATURES, keys: Sequence[str] = ()) -> DataFrame:
    """F32: +inf to the column's finite max, -inf to its min, NULL/NaN to its median (0 if there is none)."""
    keys = list(keys)
    inf = F.lit(float("inf"))
    finite = {c: F.when((F.abs(F.col(c).cast("double")) < inf), F.col(c).cast("double")) for c in features}
    long = df.select(*keys, F.inline(F.array(*[F.struct(F.lit(c).alias("_c"), v.alias("_v")) for c, v in finite.items()])))
    medians = exact_quantiles(long, [*keys, "_c"], "_v", {"_med": 0.5})
    wide = medians.groupBy(*keys).agg(*[F.max(F.when(F.col("_c") == c, F.col("_med"))).alias(f"_med_{c}") for c in features])
    ranges = df.groupBy(*keys).agg(*[f(v).alias(f"_{n}_{c}") for c, v in finite.items()
                                     for n, f in (("lo", F.min), ("hi", F.max))])
    out = attach(attach(df, wide, keys), ranges, keys)

    def clean(c: str) -> Column:
        v = F.col(c).cast("double")
        return (F.when(v.isNull() | F.isnan(v), F.coalesce(F.col(f"_med_{c}"), F.lit(0.0)))
                .when(v == inf, F.coalesce(F.col(f"_hi_{c}"), F.lit(0.0)))
                .when(v == -inf, F.coalesce(F.col(f"_lo_{c}"), F.lit(0.0))).otherwise(v))

    return out.withColumns({c: clean(c) for c in features}).select(*df.columns)


def constant_features(df: DataFrame, features: Sequence[str] = FEATURES) -> list[str]:
    """features of zero spread over all rows; one aggregation."""
    row = df.agg(*[F.stddev_samp(c).alias(c) for c in features]).first()
    return [c for c in features if row[c] == 0]


def drop_constant_features(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    return df.drop(*constant_features(df, features))
