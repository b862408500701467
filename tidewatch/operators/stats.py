"""Per-series and per-group statistics (A1-A12, T6, K7-K9 bands)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.constants import RELEVANCE, RELEVANCE_DEFAULT
from tidewatch.functions.scalar import count_true, epoch_us, moment_kurtosis, moment_skew, no_nan, safe_div
from tidewatch.operators.quantile import exact_quantiles
from tidewatch.plans.chunks import attach, match

DAY_US = 86_400_000_000
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def basic_features(df: DataFrame, keys: Sequence[str], value: str, pos: str = "pos", tail: int = 24) -> DataFrame:
    """A1: moments, range, median, mean/std of the last ``tail`` rows and the slope on the row index."""
    keys = list(keys)
    long = df.select(*keys, F.col(pos).alias("_p"), F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    last = long.groupBy(*keys).agg(F.max("_p").alias("_last"))
    recent = F.when(F.col("_p") > F.col("_last") - tail, F.col("_v"))
    v, n = F.col("_v"), F.count("_v")
    out = attach(long, last, keys).groupBy(*keys).agg(
        n.alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
        F.max(v).alias("max"), F.var_samp(v).alias("variance"), moment_skew(n, v).alias("skewness"),
        moment_kurtosis(n, v).alias("kurtosis"), F.avg(recent).alias(f"rolling_mean_{tail}"),
        F.stddev_samp(recent).alias(f"rolling_std_{tail}"),
        F.coalesce(F.regr_slope(v, F.col("_p").cast("double")), F.lit(0.0)).alias("trend_slope"))
    return attach(out, exact_quantiles(long, keys, "_v", {"median": 0.5}), keys)


def group_stats(df: DataFrame, group: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """A2: mean and sample std of each column per group."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    return df.groupBy(*group).agg(*aggs)


def hourly_profile(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """A3: mean by hour of day."""
    return df.groupBy(*keys, F.hour(ts).alias("hour")).agg(F.avg(value).alias("mean_value"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: Pearson correlation of every pair of columns, over the rows that have both; NULL where a column doesn't vary.

    Up to ``FEW_COLUMNS`` columns make one aggregation without leaving the JVM. Of more, each task adds up products of whole Arrow batches, of values less their column's mean, and of who has a value at all: the work
    of a pair is a cell of four matrix products, and what moves are the sums of one task's cells.
    """
    cols = list(cols)
    c = len(cols)
    rows = df.select(*[no_nan(F.col(x).cast("double")).alias(f"x{i}") for i, x in enumerate(cols)])
    names = F.array(*[F.lit(x) for x in cols])
    name = lambda k: F.get(names, F.col(k))
    if c <= FEW_COLUMNS:
        return _few_correlations(rows).select(name("i").alias("column_a"), name("j").alias("column_b"), "correlation")
    middle = np.array([v or 0.0 for v in rows.agg(*[F.avg(x) for x in rows.columns]).first()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, c, c))
        for b in batches:
            x = np.column_stack([col.to_numpy(zero_copy_only=False) for col in b.columns]).astype(float)
            has = (~np.isnan(x)).astype(float)
            x = np.where(has > 0, x - middle, 0.0)
            sums, squares = x.T @ has, (x * x).T @ has
            total += np.stack([has.T @ has, sums, sums.T, squares, squares.T, x.T @ x])
        i, j = np.triu_indices(c)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *[pa.array(t[i, j]) for t in total]], ["i", "j", *_CELL])

    cells = rows.mapInArrow(run, "i int, j int, " + ", ".join(f"{x} double" for x in _CELL)).groupBy("i", "j").agg(*[F.sum(x).alias(x) for x in _CELL])
    n = F.nullif(F.col("n"), F.lit(0.0))
    spread = lambda s, q: F.col(q) - F.col(s) * F.col(s) / n
    vx, vy = spread("sx", "qx"), spread("sy", "qy")
    flat = (vx <= F.col("qx") * 1e-12) | (vy <= F.col("qy") * 1e-12)
    r = F.when(~flat, (F.col("p") - F.col("sx") * F.col("sy") / n) / F.sqrt(vx * vy))
    done = cells.select("i", "j", F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("correlation"))
    both = done.unionByName(done.filter("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "correlation"))
    return both.select(name("i").alias("column_a"), name("j").alias("column_b"), "correlation")


FEW_COLUMNS = 8


def _few_correlations(rows: DataFrame) -> DataFrame:
    """(i, j, correlation) of all columns, from covariances and variances over the rows that have both."""
    n, pairs = len(rows.columns), []
    for i in range(n):
        for j in range(i, n):
            x, y = F.col(f"x{i}"), F.col(f"x{j}")
            spread = F.sqrt(F.var_pop(F.when(y.isNotNull(), x)) * F.var_pop(F.when(x.isNotNull(), y)))
            r = F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))
            pairs.append(F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias(f"r{i}_{j}"))
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"r{min(i, j)}_{max(i, j)}").alias("correlation")) for i in range(n) for j in range(n)])
    return rows.agg(*pairs).select(F.inline(cells))


_CELL = ("n", "sx", "sy", "qx", "qy", "p")  # rows with both, sums, squares, products


def histogram(df: DataFrame, keys: Sequence[str], value: str, bins: int = 50) -> DataFrame:
    """A5: counts of ``bins`` equal-width bins between min and max per group, empty bins included.
    The last bin is closed; a constant group falls into bin 0."""
    keys = list(keys)
    v = F.col(value).cast("double")
    ranges = df.filter(v.isNotNull()).groupBy(*keys).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    number = F.when(width > 0, F.least(F.floor((v - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = attach(df.filter(v.isNotNull()), ranges, keys).groupBy(*keys, number.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return match(grid, counts, [*keys, "bin"], "left").select(
        *keys, "bin", (F.col("_lo") + width * F.col("bin")).alias("bin_start"),
        (F.col("_lo") + width * (F.col("bin") + 1)).alias("bin_end"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def _fences(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    iqr = F.col("q75") - F.col("q25")
    return exact_quantiles(df, keys, value, QUARTILES).withColumns({
        "_low_fence": F.col("q25") - 1.5 * iqr, "_high_fence": F.col("q75") + 1.5 * iqr})


def box_summary(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Quartiles, whiskers (the furthest points within 1.5 IQR) and number of outliers."""
    keys = list(keys)
    v = F.col(value).cast("double")
    inside = (v >= F.col("_low_fence")) & (v <= F.col("_high_fence"))
    fences = _fences(df, keys, value)
    return attach(df.filter(v.isNotNull()), fences, keys).groupBy(*keys, "q25", "q50", "q75").agg(
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        count_true(~inside).alias("outliers"))


def box_outliers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The rows outside the whiskers."""
    v = F.col(value).cast("double")
    return attach(df.filter(v.isNotNull()), _fences(df, list(keys), value), keys).filter(
        (v < F.col("_low_fence")) | (v > F.col("_high_fence"))).select(*df.columns)


def totals(df: DataFrame, ts: str, flag: str, metrics: int | Column) -> DataFrame:
    """Records, metrics, whole days covered, anomalies and their percentage."""
    metric_col = F.lit(metrics).cast("bigint") if isinstance(metrics, int) else metrics
    span = F.max(epoch_us(F.col(ts))) - F.min(epoch_us(F.col(ts)))
    return df.agg(
        F.count(F.lit(1)).alias("total_records"), metric_col.alias("metrics_tracked"),
        F.call_function("div", span, F.lit(DAY_US)).alias("duration_days"), count_true(F.col(flag)).alias("total_anomalies"),
        F.coalesce(safe_div(count_true(F.col(flag)) * 100.0, F.count(F.lit(1)).cast("double")), F.lit(0.0)).alias("anomaly_pct"))


def method_breakdown(df: DataFrame, flags: dict[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Number of flagged rows per method, ``flags`` being method name to column."""
    row = df.groupBy(*keys).agg(*[count_true(F.col(c)).alias(f"_f{i}") for i, c in enumerate(flags.values())])
    return row.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(m).alias("method"), F.col(f"_f{i}").alias("anomalies")) for i, m in enumerate(flags)])))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def relevance(name: Column) -> Column:
    """Category of a feature name."""
    low, out = F.lower(name), None
    for words, label in RELEVANCE:
        hit = low.rlike("|".join(words))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(RELEVANCE_DEFAULT)


def top_features(df: DataFrame, features: Sequence[str], n: int = 15) -> DataFrame:
    """The ``n`` features of largest variance with mean, std and category."""
    exprs = []
    for i, c in enumerate(features):
        exprs += [F.var_samp(c).alias(f"_v{i}"), F.avg(c).alias(f"_m{i}"), F.stddev_samp(c).alias(f"_s{i}")]
    long = df.agg(*exprs).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_v{i}").alias("variance"), F.col(f"_m{i}").alias("mean"),
                 F.col(f"_s{i}").alias("std")) for i, c in enumerate(features)])))
    return long.orderBy(F.desc_nulls_last("variance"), "feature").limit(n).withColumn(
        "relevance", relevance(F.col("feature")))
