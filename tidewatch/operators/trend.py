"""Trend and season baselines, forecasts and fit metrics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import pi

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalar import epoch_us, long
from tidewatch.operators.grid import FREQUENCIES, frequency
from tidewatch.operators.local import LONG_PERIOD, local_decompose
from tidewatch.operators.quantile import exact_quantiles
from tidewatch.plans.chunks import attach, match, moving_mean, over_rows
from tidewatch.plans.staging import stage

# Two-sided normal quantiles of the interval widths in use.
Z_OF_WIDTH = {0.80: 1.2815515655446004, 0.90: 1.6448536269514722, 0.95: 1.959963984540054}
MIN_POINTS = 10
DAY_US = 86_400_000_000.0


def _banded(df: DataFrame, keys: list[str], value: str, width: float) -> DataFrame:
    """Residual and yhat +/- z * residual std per series."""
    with_res = df.withColumn("residual", F.col(value) - F.col("yhat"))
    sigma = with_res.groupBy(*keys).agg(F.stddev_samp("residual").alias("_sigma"))
    z = F.lit(Z_OF_WIDTH[width])
    return attach(with_res, sigma, keys).withColumns({
        "residual_std": F.col("_sigma"), "yhat_lower": F.col("yhat") - z * F.col("_sigma"), "yhat_upper": F.col("yhat") + z * F.col("_sigma")})


# -- T1(a): line plus mean of the detrended values per (weekday, hour) slot

def _slot(ts: str) -> Column:
    return F.weekday(ts) * 24 + F.hour(ts)


def seasonal_fit(df: DataFrame, keys: Sequence[str], ts: str, value: str, pos: str = "pos") -> DataFrame:
    """One row per (series, slot) with line, season and residual std of the series.

    One pass over the rows: the moments of (position, value) per slot are enough for the
    line over all slots, the season of each slot and the spread of the residuals. Series
    with fewer than 10 points are left out.
    """
    x, y = F.when(F.col(value).isNotNull(), F.col(pos)).cast("double"), F.col(value)
    w = Window.partitionBy(*keys)  # at most 168 slots per series
    n, total = F.col("_k"), F.sum("_k").over(w)
    slots = df.groupBy(*keys, _slot(ts).alias("_slot")).agg(
        F.count(y).alias("_k"), F.avg(x).alias("_mx"), F.avg(y).alias("_my"), F.var_pop(x).alias("_vx"),
        F.var_pop(y).alias("_vy"), F.covar_pop(x, y).alias("_cxy"), F.max(pos).alias("_p"), F.max(ts).alias("_t"))
    means = slots.withColumns({"_n": total, "_ax": F.sum(n * F.col("_mx")).over(w) / total.cast("double"),
                               "_ay": F.sum(n * F.col("_my")).over(w) / total.cast("double"),
                               "_last_pos": F.max("_p").over(w), "_last_ts": F.max("_t").over(w)})
    dx, dy = F.col("_mx") - F.col("_ax"), F.col("_my") - F.col("_ay")
    lined = means.filter(F.col("_n") >= MIN_POINTS).withColumn(
        "_slope", F.sum(n * (F.col("_cxy") + dx * dy)).over(w)
        / F.nullif(F.sum(n * (F.col("_vx") + dx * dx)).over(w), F.lit(0.0)))
    slope = F.col("_slope")
    spread = n * (F.col("_vy") + slope * slope * F.col("_vx") - 2.0 * slope * F.col("_cxy"))
    return lined.withColumns({
        "_icpt": F.col("_ay") - slope * F.col("_ax"), "_season": dy - slope * dx,
        "_sigma": F.sqrt(F.greatest(F.sum(spread).over(w), F.lit(0.0)) / (F.col("_n") - 1).cast("double")),
    }).select(*keys, "_slot", "_slope", "_icpt", "_season", "_sigma", "_last_pos", "_last_ts")


BASELINE_COLUMNS = ("yhat", "residual", "residual_std", "yhat_lower", "yhat_upper")


def seasonal_baseline(df: DataFrame, keys: Sequence[str], ts: str, value: str, pos: str = "pos",
                      width: float = 0.90) -> DataFrame:
    """T1(a): adds yhat, residual, residual_std, yhat_lower, yhat_upper; NULL for series with too few points."""
    fit = seasonal_fit(df, keys, ts, value, pos).drop("_last_pos", "_last_ts")
    out = match(df.withColumn("_slot", _slot(ts)), fit, [*keys, "_slot"], "left")
    yhat = F.col("_icpt") + F.col("_slope") * F.col(pos).cast("double") + F.col("_season")
    z = F.lit(Z_OF_WIDTH[width])
    return out.withColumn("yhat", yhat).withColumns({
        "residual": F.col(value) - F.col("yhat"), "residual_std": F.col("_sigma"),
        "yhat_lower": F.col("yhat") - z * F.col("_sigma"), "yhat_upper": F.col("yhat") + z * F.col("_sigma"),
    }).select(*df.columns, *BASELINE_COLUMNS)


def seasonal_forecast(df: DataFrame, keys: Sequence[str], ts: str, value: str, hours: int = 24, step: str = "1min",
                      grid: str = "1h", pos: str = "pos", width: float = 0.90) -> DataFrame:
    """T5: ``hours`` ahead at ``step``; positions run on in units of the history's ``grid``."""
    keys = list(keys)
    fit = seasonal_fit(df, keys, ts, value, pos)
    line = fit.groupBy(*keys).agg(*[F.first(c).alias(c) for c in ("_slope", "_icpt", "_sigma", "_last_pos", "_last_ts")])
    step_us, grid_us = FREQUENCIES[frequency(step)], FREQUENCIES[frequency(grid)]
    n = hours * 60 * FREQUENCIES["1min"] // step_us
    ahead = line.withColumn("_k", F.explode(F.sequence(long(1), long(n)))).withColumn(
        ts, F.timestamp_micros(epoch_us(F.col("_last_ts")) + F.col("_k") * F.lit(step_us)).cast(df.schema[ts].dataType))
    ahead = match(ahead.withColumn("_slot", _slot(ts)), fit.select(*keys, "_slot", "_season"), [*keys, "_slot"], "left")
    x = F.col("_last_pos").cast("double") + F.col("_k") * F.lit(step_us) / F.lit(float(grid_us))
    z = F.lit(Z_OF_WIDTH[width])
    return ahead.withColumn("yhat", F.col("_icpt") + F.col("_slope") * x + F.coalesce("_season", F.lit(0.0))).select(
        *keys, ts, "yhat", (F.col("yhat") - z * F.col("_sigma")).alias("yhat_lower"),
        (F.col("yhat") + z * F.col("_sigma")).alias("yhat_upper"))


# -- T1(b)/T2: piecewise linear trend with few changes of slope plus Fourier seasons

# Fixed values: (period in days, Fourier order) of each season; changepoints and prior scales.
SEASONS = {"yearly": (365.25, 10), "weekly": (7.0, 3), "daily": (1.0, 4)}
CHANGEPOINTS, CHANGEPOINT_RANGE = 25, 0.8
CHANGEPOINT_PRIOR, SEASON_PRIOR = 0.05, 10.0


def _basis(us: Column, t: Column, seasons: Sequence[str]) -> list[Column]:
    """Regressors of one row: 1, t, hinges, then sin/cos terms of each season."""
    cols = [F.lit(1.0), t]
    for j in range(1, CHANGEPOINTS + 1):
        cols.append(F.greatest(t - F.lit(CHANGEPOINT_RANGE * j / CHANGEPOINTS), F.lit(0.0)))
    for name in seasons:
        period, order = SEASONS[name]
        for k in range(1, order + 1):
            angle = us.cast("double") * F.lit(2.0 * pi * k / (period * DAY_US))
            cols += [F.sin(angle), F.cos(angle)]
    return cols


def _gram_batches(keys: list[str], size: int):
    """Per Arrow batch and series: sums of cross-products of (regressors, y), flattened."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            z = batch.column(batch.schema.get_field_index("_z")).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            groups = {(): np.arange(batch.num_rows)}
            key_frame = batch.select(keys).to_pandas() if keys else None
            if keys:
                groups = key_frame.groupby(keys, sort=False).indices
            first = [int(rows[0]) for rows in groups.values()]
            sums = [(z[rows].T @ z[rows]).ravel() for rows in groups.values()]
            columns = [batch.column(batch.schema.get_field_index(k)).take(pa.array(first)) for k in keys]
            columns.append(pa.array([s.tolist() for s in sums], type=pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "_g"])

    return run


def _sparse(xx: np.ndarray, xy: np.ndarray, quadratic: np.ndarray, absolute: np.ndarray) -> np.ndarray:
    """Minimum of b'(xx + diag(quadratic))b / 2 - b'xy + sum(absolute * |b|), exact up to the solves: the set of
    coefficients off zero and their signs are searched, one entry at a time; each step lowers the value, so none comes twice."""
    g = xx + np.diag(quadratic)
    p = len(xy)
    free = absolute == 0
    beta, sign = np.zeros(p), np.zeros(p)
    on = free.copy()
    scale = max(float(np.abs(xy).max()), 1e-12)

    def value(b: np.ndarray) -> float:
        return float(b @ g @ b / 2 - b @ xy + absolute @ np.abs(b))

    for _ in range(50 * p):
        # to the minimum over the coefficients that are on, with their signs; at a change of sign the best point on the way
        at = np.flatnonzero(on)
        goal = np.zeros(p)
        goal[at] = np.linalg.solve(g[np.ix_(at, at)], xy[at] - absolute[at] * sign[at])
        turn = [i for i in at if not free[i] and goal[i] * sign[i] < 0]
        if turn:
            ways = [beta[i] / (beta[i] - goal[i]) for i in turn if beta[i] != goal[i]]
            points = [beta + w * (goal - beta) for w in sorted(set(ways))]
            for q in points:
                q[~free & (np.abs(q) < 1e-13 * max(1.0, np.abs(q).max()))] = 0.0
            best = min([*points, goal], key=value)
            beta = best
            off = on & ~free & (beta == 0)
            on &= ~off
            sign = np.where(free, 0.0, np.sign(beta))
            continue
        beta = goal
        slope = xy - g @ beta
        over = np.where(on, -np.inf, np.abs(slope) - absolute)
        j = int(over.argmax())
        if over[j] <= 1e-9 * scale:
            return beta
        on[j], sign[j] = True, np.sign(slope[j])
    return beta


def _map_solver(size: int, n_hinges: int):
    """Of the aggregated cross-products of one series: coefficients, the penalty on the slopes' changes, and their mean size.

    The changes have a Laplace prior of scale ``CHANGEPOINT_PRIOR`` on values of root mean square 1, so most are exactly
    zero; seasons have a normal one, level and base slope are all but free.
    """
    p = size - 1
    prior = np.full(p, SEASON_PRIOR)
    prior[:2] = 1e4
    hinge = np.zeros(p, bool)
    hinge[2:2 + n_hinges] = True

    def solve(g: np.ndarray) -> list[float] | None:
        g = np.asarray(g, dtype=float).reshape(size, size)
        xx, xy, yy, n = g[:p, :p], g[:p, p], g[p, p], g[0, 0]
        if n < MIN_POINTS:
            return None
        scale = max(np.sqrt(yy / n), 1e-12)
        xy, yy = xy / scale, yy / scale**2
        variance = 1e-2
        for _ in range(3):  # penalties rise with the variance of what is left
            used = variance
            beta = _sparse(xx, xy, np.where(hinge, 1e-9, used / prior**2 + 1e-9), np.where(hinge, used / CHANGEPOINT_PRIOR, 0.0))
            sse = max(yy - 2 * beta @ xy + beta @ xx @ beta, 0.0)
            variance = max(sse / n, 1e-9)
        return [*(beta * scale).tolist(), used / CHANGEPOINT_PRIOR * scale, float(np.abs(beta[hinge]).mean()) * scale]

    @F.pandas_udf("array<double>")
    def run(grams: pd.Series) -> pd.Series:
        return pd.Series([solve(g) for g in grams])

    return run


def fourier_fit(df: DataFrame, keys: Sequence[str], ts: str, value: str, seasons: Sequence[str] = ("weekly", "daily")) -> DataFrame:
    """T1(b): per series its first and last time (_t0, _t1, in microseconds), coefficients (_coef), the penalty on changes of
    slope (_penalty) and their mean size (_change). Series with fewer than 10 points have NULLs.

    Rows never meet in one place: each task sums cross-products of its Arrow batches, the sums are added elementwise by
    Spark, and only one small matrix per series is solved.
    """
    keys, us = list(keys), epoch_us(F.col(ts))
    known = df.filter(F.col(ts).isNotNull() & F.col(value).isNotNull()).select(*keys, ts, F.col(value).cast("double").alias(value))
    span = known.groupBy(*keys).agg(F.min(us).alias("_t0"), F.max(us).alias("_t1"))
    basis = fourier_basis(ts, seasons)
    size = len(basis) + 1
    terms = attach(known, span, keys).select(*keys, F.array(*basis, F.col(value)).alias("_z"))
    grams = terms.mapInArrow(_gram_batches(keys, size), T.StructType([*[df.schema[k] for k in keys], T.StructField("_g", T.ArrayType(T.DoubleType()))]))
    summed = grams.select(*keys, F.posexplode("_g").alias("_i", "_v")).groupBy(*keys, "_i").agg(F.sum("_v").alias("_v"))
    solved = summed.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_i", "_v"))).alias("_m")).select(
        *keys, _map_solver(size, CHANGEPOINTS)(F.col("_m")["_v"]).alias("_b"))
    p = len(basis)
    coefs = solved.select(*keys, F.slice("_b", 1, p).alias("_coef"), F.get("_b", F.lit(p)).alias("_penalty"), F.get("_b", F.lit(p + 1)).alias("_change"))
    return stage(attach(span, coefs, keys), "coefficients")


def fourier_basis(ts: str, seasons: Sequence[str]) -> list[Column]:
    """Regressors of a row that carries its series' _t0 and _t1: 1, t, one hinge per change point, sines and cosines."""
    us = epoch_us(F.col(ts))
    t = (us - F.col("_t0")).cast("double") / F.greatest((F.col("_t1") - F.col("_t0")).cast("double"), F.lit(1.0))
    return _basis(us, t, seasons)


def fourier_baseline(df: DataFrame, keys: Sequence[str], ts: str, value: str,
                     seasons: Sequence[str] = ("weekly", "daily"), width: float = 0.90,
                     hours: int = 0, step: str = "1h") -> DataFrame:
    """T1(b): keys, ts, value and the baseline columns; with ``hours`` also the future steps, their value NULL.

    Ahead of the history the band widens with the time h since its end (the history's length being 1): change points go on
    at the history's rate, and changes of slope with the Laplace spread of the fitted ones add 2/3 * rate * change^2 * h^3 to the variance.
    """
    keys, seasons = list(keys), list(seasons)
    rows = df.filter(F.col(ts).isNotNull()).select(*keys, ts, F.col(value).cast("double").alias(value))
    fit = fourier_fit(df, keys, ts, value, seasons)
    if hours:
        step_us = FREQUENCIES[frequency(step)]
        n = hours * 60 * FREQUENCIES["1min"] // step_us
        ahead = fit.withColumn("_k", F.explode(F.sequence(long(1), long(n)))).select(
            *keys, F.timestamp_micros(F.col("_t1") + F.col("_k") * F.lit(step_us)).cast(df.schema[ts].dataType).alias(ts),
            F.lit(None).cast("double").alias(value))
        rows = rows.unionByName(ahead)
    placed = attach(rows, fit, keys)
    terms = [F.col("_coef")[i] * b for i, b in enumerate(fourier_basis(ts, seasons))]
    yhat = terms[0]
    for term in terms[1:]:
        yhat = yhat + term
    us = epoch_us(F.col(ts))
    h = F.greatest((us - F.col("_t1")).cast("double") / F.greatest((F.col("_t1") - F.col("_t0")).cast("double"), F.lit(1.0)), F.lit(0.0))
    drift = F.lit(2.0 * CHANGEPOINTS / 3.0) * F.col("_change") * F.col("_change") * h * h * h
    banded = _banded(placed.withColumns({"yhat": yhat, "_drift": drift}), keys, value, width)
    half = F.lit(Z_OF_WIDTH[width]) * F.sqrt(F.col("residual_std") * F.col("residual_std") + F.col("_drift"))
    return banded.withColumns({"yhat_lower": F.col("yhat") - half, "yhat_upper": F.col("yhat") + half}).select(*keys, ts, value, *BASELINE_COLUMNS)


# -- T3: moving-average trend plus slot means

def _trend_long(df: DataFrame, keys: list[str], value: str, pos: str, period: int, **kw) -> DataFrame:
    before, after = period // 2, (period - 1) // 2
    return moving_mean(df, keys, pos, value, "_trend", before, after, **kw).withColumn("_period", F.lit(period).cast("bigint"))


def _trend_short(df: DataFrame, keys: list[str], value: str, pos: str) -> DataFrame:
    """Series shorter than ``LONG_PERIOD``: the frame depends on the length, so the moving
    sum is the difference of two running sums looked up in the series' own small array."""
    w = Window.partitionBy(*keys).orderBy(pos)
    summed = df.withColumns({"_run": F.sum(value).over(w), "_row": F.struct(*df.columns)})
    series = summed.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col("_run").alias("s"), F.col("_row").alias("r")))).alias("_a"))
    a = F.col("_a")
    n = F.size(a)
    period = F.greatest(F.lit(3), F.floor(n / 2).cast("int"))
    before, after = F.floor(period / 2).cast("int"), F.floor((period - 1) / 2).cast("int")

    def smooth(x: Column, i: Column) -> Column:
        hi, lo = F.least(i + after, n - 1), F.greatest(i - before, F.lit(0))
        head = F.when(lo > 0, F.get(a, lo - 1)["s"]).otherwise(F.lit(0.0))
        return F.struct(x["r"].alias("r"), ((F.get(a, hi)["s"] - head) / (hi - lo + 1).cast("double")).alias("t"))

    rows = series.select(period.cast("bigint").alias("_period"), F.inline(F.transform(a, smooth)))
    return rows.select("r.*", F.col("t").alias("_trend"), "_period")


def decompose(df: DataFrame, keys: Sequence[str], value: str, pos: str = "pos", period: int | None = None,
              robust: bool = False, **kw) -> DataFrame:
    """Adds trend, seasonal, predicted, residual, yhat_lower, yhat_upper (+/- 1.96 sigma).

    ``value`` must be filled. Without ``period``: 1440 for series of at least 1440
    rows, else half the length (at least 3). ``robust`` takes slot medians for means.
    """
    keys = list(keys)
    if period:
        smooth = _trend_long(df, keys, value, pos, period, **kw)
    else:
        sized = attach(df, df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys)
        long = sized.filter(F.col("_n") >= LONG_PERIOD).drop("_n")
        short = sized.filter(F.col("_n") < LONG_PERIOD).drop("_n")
        smooth = _trend_long(long, keys, value, pos, LONG_PERIOD, **kw).unionByName(_trend_short(short, keys, value, pos))
    smooth = stage(smooth.withColumns({
        "_slot": F.pmod(F.col(pos), F.col("_period")), "_detrended": F.col(value) - F.col("_trend")}), "trend")
    slots = [*keys, "_slot"]
    if robust:
        season = exact_quantiles(smooth, slots, "_detrended", {"seasonal": 0.5})
    else:
        season = smooth.groupBy(*slots).agg(F.avg("_detrended").alias("seasonal"))
    out = match(smooth, season, slots).withColumn("predicted", F.col("_trend") + F.col("seasonal"))
    out = out.withColumn("residual", F.col(value) - F.col("predicted"))
    sigma = out.groupBy(*keys).agg(F.stddev_pop("residual").alias("_sigma"))
    return attach(out, sigma, keys).select(
        *df.columns, F.col("_trend").alias("trend"), "seasonal", "predicted", "residual",
        (F.col("predicted") - 1.96 * F.col("_sigma")).alias("yhat_lower"),
        (F.col("predicted") + 1.96 * F.col("_sigma")).alias("yhat_upper"))


def predict(df: DataFrame, keys: Sequence[str], ts: str, value: str, baseline: str = "fourier", pos: str = "pos",
            **kw) -> DataFrame:
    """T4: yhat and its band by the chosen baseline ("decompose", "local", "seasonal", "fourier"); series with fewer
    than 10 points, which the trend fits refuse, take the decomposition."""
    keys = list(keys)
    wanted = [*df.columns, *BASELINE_COLUMNS]

    def as_yhat(d: DataFrame) -> DataFrame:
        std = d.groupBy(*keys).agg(F.stddev_samp("residual").alias("residual_std"))
        return attach(d.withColumnRenamed("predicted", "yhat"), std, keys).select(*wanted)

    if baseline == "decompose":
        return as_yhat(decompose(df, keys, value, pos, **kw))
    if baseline == "local":
        return as_yhat(local_decompose(df, keys, value, pos, **kw))
    sizes = df.groupBy(*keys).agg(F.count(value).alias("_n"))
    sized = attach(df, sizes, keys)
    enough = sized.filter(F.col("_n") >= MIN_POINTS).drop("_n")
    few = sized.filter(F.col("_n") < MIN_POINTS).drop("_n")
    if baseline == "seasonal":
        fitted = seasonal_baseline(enough, keys, ts, value, pos, **kw)
    elif baseline == "fourier":
        model = fourier_baseline(enough, keys, ts, value, **kw).drop(value)
        fitted = match(enough, model, [*keys, ts], "left")
    else:
        raise ValueError(f"unknown baseline {baseline!r}")
    return fitted.select(*wanted).unionByName(as_yhat(decompose(few, keys, value, pos)))


def fit_metrics(df: DataFrame, keys: Sequence[str], value: str, yhat: str = "yhat", pos: str = "pos", **kw) -> DataFrame:
    """MAE, RMSE, stability 1 / (1 + population std of the steps of yhat), sample std of the data."""
    err = F.col(value) - F.col(yhat)
    stepped = over_rows(df, keys, pos, {"_step": lambda w: F.col(yhat) - F.lag(yhat).over(w)}, before=1, **kw)
    return stepped.groupBy(*keys).agg(
        F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
        F.coalesce(1.0 / (1.0 + F.stddev_pop("_step")), F.lit(1.0)).alias("trend_stability"),
        F.stddev_samp(value).alias("data_volatility"))
