"""Report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalar import count_true
from tidewatch.operators.profile import describe
from tidewatch.operators.stats import method_breakdown

DETECTORS = {"threshold": "threshold_anomaly", "residual": "residual_anomaly", "cluster": "cluster_anomaly"}


def detector_report(df: DataFrame, metric: str = "metric", detectors: dict[str, str] = DETECTORS,
                    residual: str | None = None) -> DataFrame:
    """Per metric and method the flagged rows and their share; with ``residual`` also the
    mean and population std of the residuals (1 if it is 0) on the residual method's row."""
    n = F.count(F.lit(1))
    aggs = [n.alias("_n"), *[count_true(F.col(c)).alias(f"_f{i}") for i, c in enumerate(detectors.values())]]
    if residual:
        aggs += [F.avg(residual).alias("_mean"), F.stddev_pop(residual).alias("_std")]
    cells = []
    for i, m in enumerate(detectors):
        stats = []
        if residual:
            mine = F.lit(m == "residual")
            std = F.when(F.col("_std") == 0, 1.0).otherwise(F.col("_std"))
            stats = [F.when(mine, F.col("_mean")).alias("residual_mean"), F.when(mine, std).alias("residual_std")]
        cells.append(F.struct(
            F.lit(m).alias("method"), F.col(f"_f{i}").alias("anomalies_detected"),
            (F.col(f"_f{i}").cast("double") / F.greatest(F.col("_n"), F.lit(1)) * 100).alias("anomaly_percentage"), *stats))
    return df.groupBy(metric).agg(*aggs).select(metric, F.inline(F.array(*cells)))


def summary_counts(report: DataFrame, metric: str = "metric") -> DataFrame:
    """Label '<metric>-<method>' and count."""
    return report.select(F.concat_ws("-", metric, "method").alias("label"), "anomalies_detected")


def health_report(per_metric: DataFrame, metric: str = "metric") -> DataFrame:
    """One line per metric and a totals row (metric NULL) from (metric, anomalies,
    patterns, features)."""
    title = F.initcap(F.replace(F.col(metric), F.lit("_"), F.lit(" ")))
    line = F.when(F.col("anomalies") > 0, F.concat(
        title, F.lit(": Review "), F.col("anomalies").cast("string"), F.lit(" detected anomalies for potential health concerns"))
    ).otherwise(F.concat(title, F.lit(": Patterns appear normal and healthy")))
    out = per_metric.rollup(metric).agg(
        F.count(F.lit(1)).alias("metrics"), F.sum("anomalies").alias("anomalies"), F.grouping(metric).alias("_total"),
        F.sum("patterns").alias("_patterns"), F.count_if(F.col("patterns") > 0).alias("_with_patterns"), F.sum("features").alias("features"))
    is_total = F.col("_total") == 1
    return out.select(metric, "metrics", "anomalies", F.when(is_total, F.col("_with_patterns")).otherwise(F.col("_patterns")).alias("patterns"),
                      "features", F.when(~is_total, line).alias("recommendation"))


def json_report(df: DataFrame, ts: str, cols: Sequence[str], flags: dict[str, str], final: str,
                analysis_date=None) -> DataFrame:
    """Shape, columns, date range, describe rounded to 3 and anomaly breakdown as one JSON text."""
    stats = describe(df, cols).select(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", F.struct(
            "count", *[F.round(c, 3).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]).alias("s"))))).alias("m"))
    breakdown = method_breakdown(df, flags).select(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("method", "anomalies")))).alias("m"))
    n, hits = F.count(F.lit(1)), count_true(F.col(final))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    row = df.agg(n.alias("_n"), hits.alias("_hits"), day(F.min(ts)).alias("_from"), day(F.max(ts)).alias("_to"))
    pct = F.format_string("%.2f%%", F.coalesce(F.col("_hits") * 100.0 / F.nullif(F.col("_n").cast("double"), F.lit(0.0)), F.lit(0.0)))
    date = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if analysis_date is None else F.lit(analysis_date)
    return row.select(F.to_json(F.struct(
        date.alias("analysis_date"),
        F.array(F.col("_n"), F.lit(len(cols)).cast("bigint")).alias("data_shape"),
        F.array(*[F.lit(c) for c in cols]).alias("data_columns"),
        F.struct(F.col("_from").alias("start"), F.col("_to").alias("end")).alias("date_range"),
        stats.scalar().alias("summary_statistics"),
        F.struct(F.col("_hits").alias("total_anomalies"), pct.alias("anomaly_percentage"),
                 breakdown.scalar().alias("breakdown")).alias("anomaly_summary"))).alias("report"))
