"""Robust trend and season by local regression."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.quantile import exact_quantiles
from tidewatch.plans.chunks import CHUNK_ROWS, attach, chunk_of, match
from tidewatch.plans.staging import drop, stage, stage_at

# Period of a minute grid, reach of the bisquare in medians of the absolute residuals.
LONG_PERIOD = 1440
BISQUARE_MEDIANS = 6.0
LEAST_WEIGHT = 0.001  # so that no window is without weight
FLAT = 1e-9  # below this share of the squared weight a window has one place only, and takes its mean
DIRECT = 64  # wider windows are summed by Fourier transforms


def half_width(period: int) -> int:
    """Rows to each side of the trend's window: 21/11 periods in all, the width at which a season of seven periods' smoothness stays out."""
    return (21 * period + 10) // 11 // 2


def local_line(y: np.ndarray, w: np.ndarray, half: int) -> np.ndarray:
    """At each place the value of the line through the places within ``half``, weighted by ``w`` and the tricube of their distance.

    ``y`` counts only where ``w`` is above 0; NaN where a window has no weight.
    """
    total = w.sum()
    centre = float((w * y).sum() / total) if total else 0.0
    d = np.arange(-half, half + 1) / (half + 1.0)
    k = (1 - np.abs(d) ** 3) ** 3
    if half <= DIRECT:
        def around(a: np.ndarray, kernel: np.ndarray) -> np.ndarray:
            return np.convolve(a, kernel[::-1])[half: half + len(a)]
    else:
        size = 1 << (len(y) + 2 * half).bit_length()

        def around(a: np.ndarray, kernel: np.ndarray) -> np.ndarray:
            return np.fft.irfft(np.fft.rfft(a, size) * np.fft.rfft(kernel[::-1], size), size)[half: half + len(a)]

    z = w * (y - centre)
    s0, s1, s2 = (around(w, k * d**p) for p in range(3))
    t0, t1 = around(z, k), around(z, k * d)
    det = s0 * s2 - s1 * s1
    with np.errstate(divide="ignore", invalid="ignore"):
        line = np.where(det > FLAT * s0 * s0, (s2 * t0 - s1 * t1) / det, t0 / s0)
    return np.where(s0 > 1e-12, line + centre, np.nan)


def moving_median(y: np.ndarray, period: int) -> np.ndarray:
    """Median of the known values of about one period around each place."""
    return pd.Series(y).rolling(2 * (period // 2) + 1, center=True, min_periods=1).median().to_numpy()


def _trend(rows: DataFrame, keys: list[str], reach: int, chunk_rows: int, start: bool) -> DataFrame:
    """``rows`` (keys, _pos, _v, _period, _s, _w) with ``_trend`` of _v - _s. A chunk gets ``reach`` rows of its neighbours."""
    size = max(chunk_rows, reach, 1)
    home, offset = chunk_of("_pos", size), F.pmod(F.col("_pos"), F.lit(size))
    targets = F.array(home, F.when(offset >= size - reach, home + 1), F.when(offset < reach, home - 1))
    spread = rows.withColumn("_chunk", F.explode(F.filter(targets, lambda c: c.isNotNull())))

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("_pos")
        col = lambda name: table[name].to_numpy()
        y, period = col("_v") - col("_s"), int(col("_period")[0])
        line = moving_median(y, period) if start else local_line(np.nan_to_num(y), col("_w"), half_width(period))
        out = table.drop_columns(["_chunk"]).append_column("_trend", pa.array(line, pa.float64(), from_pandas=True))
        return out.filter(pa.array(col("_pos") // size == col("_chunk")))

    return spread.groupBy(*keys, "_chunk").applyInArrow(fit, T.StructType([*rows.schema.fields, T.StructField("_trend", T.DoubleType())]))


def _weight(residual: Column, scale: Column) -> Column:
    u = F.abs(residual) / (scale * F.lit(BISQUARE_MEDIANS))
    square = F.when(u < 1, (1 - u * u) * (1 - u * u)).otherwise(0.0)
    return F.when(residual.isNull(), 0.0).when(scale > 0, F.greatest(square, F.lit(LEAST_WEIGHT))).when(residual == 0, 1.0).otherwise(LEAST_WEIGHT)


def local_decompose(df: DataFrame, keys: Sequence[str], value: str, pos: str = "pos", period: int | None = None,
                    rounds: int = 3, chunk_rows: int | None = None) -> DataFrame:
    """Adds trend, seasonal, predicted, residual, yhat_lower, yhat_upper (+/- 1.96 sigma).

    A first turn takes the median of a period around each row and the median of each slot, which no outlier moves. In ``rounds``
    turns each row is then weighted by the bisquare of its last residual over six medians; the trend is a local line under tricube
    weights through the values without their season, the season the weighted mean of each slot's values without their trend. ``pos`` is dense from 0 and ``value`` filled; a NULL or NaN value has
    no weight and no residual. Without ``period``: 1440 for series of at least 1440 rows, else half the length (at least 3).

    Each turn reads the rows in chunks with the window's reach of the neighbours' rows, so a series may have any length.
    """
    spark, keys, chunk = df.sparkSession, list(keys), chunk_rows or CHUNK_ROWS
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    rows = df.select(*keys, F.col(pos).cast("bigint").alias("_pos"), v.alias("_v"))
    if period:
        rows, reach = rows.withColumn("_period", F.lit(period).cast("bigint")), half_width(period)
    else:
        n = F.col("_n")
        sized = attach(rows, df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys)
        rows = sized.withColumn("_period", F.when(n >= LONG_PERIOD, LONG_PERIOD).otherwise(F.greatest(F.lit(3), F.floor(n / 2))).cast("bigint")).drop("_n")
        reach = half_width(LONG_PERIOD)
    rows, path = stage_at(rows.withColumns({"_s": F.lit(0.0), "_w": F.when(F.col("_v").isNull(), 0.0).otherwise(1.0)}), "weights")
    for turn in range(rounds + 1):
        fitted, fitted_path = stage_at(_trend(rows, keys, reach, chunk, turn == 0).drop("_s").withColumn("_slot", F.pmod("_pos", "_period")), "trend")
        drop(spark, path)
        slot, apart = [*keys, "_slot"], F.col("_v") - F.col("_trend")
        if turn == 0:
            slots = exact_quantiles(fitted.withColumn("_a", apart), slot, "_a", {"_s": 0.5})
        else:
            slots = fitted.groupBy(*slot).agg((F.sum(F.col("_w") * apart) / F.nullif(F.sum("_w"), F.lit(0.0))).alias("_s"))
        whole = match(fitted, slots, slot, "left").withColumn("_r", F.col("_v") - F.col("_trend") - F.col("_s"))
        if turn == rounds:
            break
        whole, whole_path = stage_at(whole, "residuals")
        scale = exact_quantiles(whole.withColumn("_a", F.abs("_r")), keys, "_a", {"_scale": 0.5})
        rows, path = stage_at(attach(whole, scale, keys).withColumn("_w", _weight(F.col("_r"), F.col("_scale")))
                              .select(*keys, "_pos", "_v", "_period", F.coalesce("_s", F.lit(0.0)).alias("_s"), "_w"), "weights")
        drop(spark, fitted_path, whole_path)
    parts = whole.select(*keys, F.col("_pos").alias(pos), F.col("_trend").alias("trend"), F.col("_s").alias("seasonal"),
                         (F.col("_trend") + F.col("_s")).alias("predicted"), F.col("_r").alias("residual"))
    parts = stage(parts, "parts")
    drop(spark, fitted_path)
    half = 1.96 * F.col("_sigma")
    out = match(df, attach(parts, parts.groupBy(*keys).agg(F.stddev_pop("residual").alias("_sigma")), keys), [*keys, pos])
    return out.select(*df.columns, "trend", "seasonal", "predicted", "residual", (F.col("predicted") - half).alias("yhat_lower"),
                      (F.col("predicted") + half).alias("yhat_upper"))
