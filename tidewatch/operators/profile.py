"""Profiling and validation of raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.constants import VALIDATION_RULES
from tidewatch.functions.scalar import no_nan
from tidewatch.operators.quantile import column_quantiles
from tidewatch.sources.roles import numeric_columns


def is_missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN in a floating column."""
    floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
    return F.col(c).isNull() | F.isnan(c) if floating else F.col(c).isNull()


def null_counts(df: DataFrame) -> DataFrame:
    """Column, dtype, missing and present counts, missing % rounded to 2; one pass."""
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(df.columns)])
    n = F.col("_n")
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col(f"_m{i}").alias("missing_count"),
            (n - F.col(f"_m{i}")).alias("present_count"),
            F.round(F.col(f"_m{i}") / F.nullif(n.cast("double"), F.lit(0.0)) * 100, 2).alias("missing_pct"))
        for i, (c, t) in enumerate(df.dtypes)
    ])
    return row.select(F.inline(cells))


def missing_total(df: DataFrame) -> DataFrame:
    """Missing cells and the sum of the column percentages."""
    return null_counts(df).agg(F.sum("missing_count").alias("missing_cells"),
                               F.round(F.sum("missing_pct"), 2).alias("missing_pct_sum"))


def column_types(df: DataFrame) -> DataFrame:
    """P3."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows (NULL equals NULL)."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("bigint")).alias("duplicates"))


def numeric_ranges(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P5: min and max per numeric column, columns without values left out."""
    cols = list(cols or numeric_columns(df))
    exprs = []
    for i, c in enumerate(cols):
        v = no_nan(F.col(c).cast("double"))
        exprs += [F.min(v).alias(f"_lo{i}"), F.max(v).alias(f"_hi{i}")]
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_lo{i}").alias("min_value"), F.col(f"_hi{i}").alias("max_value"))
        for i, c in enumerate(cols)])
    return df.agg(*exprs).select(F.inline(cells)).filter(F.col("min_value").isNotNull())


def shape(df: DataFrame) -> DataFrame:
    """P6."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint"))


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max of each column."""
    out = column_quantiles(df, list(cols or numeric_columns(df)), {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return out.select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def validate(df: DataFrame, row_key: Sequence[str], rules=VALIDATION_RULES) -> DataFrame:
    """One row per broken rule (row key, column, value, issue); a single pass."""
    found = []
    for col, low, high, issue in rules:
        if col not in df.columns:
            continue
        v = F.col(col).cast("double")
        bad = F.lit(False)
        if low is not None:
            bad = bad | (v < F.lit(float(low)))
        if high is not None:
            bad = bad | (v > F.lit(float(high)))
        found.append(F.when(bad, F.struct(F.lit(col).alias("column"), v.alias("value"), F.lit(issue).alias("issue"))))
    if not found:
        return df.select(*row_key, F.lit("").alias("column"), F.lit(0.0).alias("value"),
                         F.lit("").alias("issue")).filter(F.lit(False))
    hits = F.filter(F.array(*found), lambda x: x.isNotNull())
    return df.select(*row_key, F.inline(hits))


def preparation_report(raw: DataFrame, long: DataFrame, metric: str = "metric") -> DataFrame:
    """P10: points per metric and in total (metric NULL), with the raw row and column counts."""
    rows = raw.agg(F.count(F.lit(1)).alias("n")).scalar()
    metrics = long.agg(F.count_distinct(metric).alias("n")).scalar()
    return long.rollup(metric).agg(F.count(F.lit(1)).alias("points")).select(
        metric, "points", rows.alias("raw_rows"), metrics.alias("metrics"),
        F.lit(len(numeric_columns(raw))).cast("bigint").alias("numeric_columns"))


def missing_matrix(df: DataFrame, row_key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(row key, column, is_missing 0/1)."""
    return df.select(*row_key, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), is_missing(df, c).cast("int").alias("is_missing")) for c in cols])))
