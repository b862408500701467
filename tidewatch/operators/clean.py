"""Row dropping, deduplication, outlier removal, constant fills, scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalar import no_nan
from tidewatch.operators.quantile import exact_quantiles
from tidewatch.plans.chunks import attach


def required_present(max_null_pct: float, n_columns: int) -> int:
    """Fewest non-null cells a row must have."""
    return max(int((1 - max_null_pct / 100) * n_columns), 1)


def drop_sparse_rows(df: DataFrame, max_null_pct: float = 90) -> DataFrame:
    """Drop rows with too many missing cells; 0 turns the step off."""
    if max_null_pct <= 0:
        return df
    return df.na.drop(thresh=required_present(max_null_pct, len(df.columns)))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """C2."""
    return df.dropDuplicates()


def null_outliers(df: DataFrame, cols: Sequence[str], z: float = 4.0, keys: Sequence[str] = ()) -> DataFrame:
    """Values more than ``z`` population deviations from the mean become NULL; columns
    (per series) with fewer than 3 values are left alone."""
    keys = list(keys)
    aggs = []
    for c in cols:
        v = no_nan(F.col(c).cast("double"))
        aggs += [F.count(v).alias(f"_n_{c}"), F.avg(v).alias(f"_m_{c}"), F.stddev_pop(v).alias(f"_s_{c}")]
    with_stats = attach(df, df.groupBy(*keys).agg(*aggs), keys)

    def kept(c: str) -> Column:
        score = F.abs((F.col(c) - F.col(f"_m_{c}")) / (F.col(f"_s_{c}") + F.lit(1e-9)))
        return F.when((F.col(f"_n_{c}") >= 3) & (score > F.lit(float(z))), F.lit(None)).otherwise(F.col(c))

    return with_stats.withColumns({c: kept(c) for c in cols}).select(*df.columns)


def fill_median(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """C4: NULLs take the exact median of their column (per series)."""
    keys = list(keys)
    long = df.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in cols])))
    medians = exact_quantiles(long, [*keys, "_c"], "_v", {"_med": 0.5})
    wide = medians.groupBy(*keys).agg(*[F.max(F.when(F.col("_c") == c, F.col("_med"))).alias(f"_med_{c}") for c in cols])
    return attach(df, wide, keys).withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")) for c in cols}).select(*df.columns)


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C9."""
    return df.na.fill(0, subset=list(cols))


def fill_expr(df: DataFrame, fallbacks: dict[str, Column]) -> DataFrame:
    """C11: NULLs take the value of an expression."""
    return df.withColumns({c: F.coalesce(F.col(c), e) for c, e in fallbacks.items()})


def standardize(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), suffix: str = "_scaled") -> DataFrame:
    """(x - mean) / population std; a constant column is divided by 1."""
    keys = list(keys)
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"_m_{c}"), F.stddev_pop(c).alias(f"_s_{c}")]
    out = attach(df, df.groupBy(*keys).agg(*aggs), keys).withColumns({
        f"{c}{suffix}": (F.col(c) - F.col(f"_m_{c}"))
        / F.when(F.col(f"_s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s_{c}")) for c in cols})
    return out.select(*df.columns, *[f"{c}{suffix}" for c in cols])
