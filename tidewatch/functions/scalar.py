"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS = 1_000_000


def no_nan(c: Column) -> Column:
    """NaN to NULL, so that averages and comparisons skip it."""
    return F.when(~F.isnan(c), c)


def to_number(c: Column) -> Column:
    """Cast to DOUBLE; what does not parse becomes NULL."""
    return no_nan(c.try_cast("double"))


def to_time(c: Column, fmt: str | None = None) -> Column:
    """Parse a timestamp; what does not parse becomes NULL."""
    text = c.cast("string")
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def epoch_us(c: Column) -> Column:
    """Microseconds since 1970 of a TIMESTAMP or TIMESTAMP_NTZ (session zone UTC)."""
    return F.unix_micros(c.cast("timestamp"))


def from_epoch_us(c: Column, like: T.DataType) -> Column:
    """Inverse of :func:`epoch_us`, in the timestamp type of the source column."""
    ts = F.timestamp_micros(c)
    return ts.cast("timestamp_ntz") if isinstance(like, T.TimestampNTZType) else ts


def floor_div(c: Column, n: int) -> Column:
    """Exact floor division of a BIGINT (also below zero)."""
    n_col = F.lit(n).cast("bigint")
    return F.call_function("div", c - F.pmod(c, n_col), n_col)


def long(n: int) -> Column:
    """BIGINT literal."""
    return F.lit(n).cast("bigint")


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL for a zero divisor (ANSI mode would raise)."""
    return a / F.nullif(b, F.lit(0.0))


def skew_corrected(n: Column, population_skew: Column) -> Column:
    """Bias-corrected skewness G1 from the population moment; NULL below 3 points."""
    n = n.cast("double")
    return F.when(n >= 3, population_skew * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def kurtosis_corrected(n: Column, population_excess: Column) -> Column:
    """Bias-corrected excess kurtosis G2; NULL below 4 points."""
    n = n.cast("double")
    denom = F.nullif((n - 2) * (n - 3), F.lit(0.0))
    return F.when(n >= 4, (n - 1) / denom * ((n + 1) * population_excess + 6))


def moment_skew(n: Column, x: Column) -> Column:
    return skew_corrected(n, no_nan(F.skewness(x)))


def moment_kurtosis(n: Column, x: Column) -> Column:
    return kurtosis_corrected(n, no_nan(F.kurtosis(x)))


def any_true(cols: Sequence[Column]) -> Column:
    """OR over flags where NULL counts as false."""
    out = F.lit(False)
    for c in cols:
        out = out | F.coalesce(c, F.lit(False))
    return out


def count_true(c: Column) -> Column:
    """Number of rows where the flag holds, as BIGINT, 0 for none."""
    return F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("bigint")), F.lit(0).cast("bigint"))
