"""Row-count windows over a position column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.plans.chunks import attach, over_rows


def trailing_stats(df: DataFrame, keys: Sequence[str], value: str, rows: int = 24, pos: str = "pos",
                   std_null: float | None = None, **kw) -> DataFrame:
    """Mean and sample std of the last ``rows`` rows; std of one row is NULL or ``std_null``."""
    back = rows - 1

    def std(w) -> Column:
        s = F.stddev_samp(value).over(w.rowsBetween(-back, 0))
        return s if std_null is None else F.coalesce(s, F.lit(float(std_null)))

    return over_rows(df, keys, pos, {
        f"roll_mean_{rows}": lambda w: F.avg(value).over(w.rowsBetween(-back, 0)),
        f"roll_std_{rows}": std,
    }, before=back, **kw)


def centered_stats(df: DataFrame, keys: Sequence[str], value: str, rows: int = 60, pos: str = "pos", **kw) -> DataFrame:
    """Centered mean and population std; an even window reaches one row further back."""
    before, after = rows // 2, (rows - 1) // 2
    return over_rows(df, keys, pos, {
        "center_mean": lambda w: F.avg(value).over(w.rowsBetween(-before, after)),
        "center_std": lambda w: F.stddev_pop(value).over(w.rowsBetween(-before, after)),
    }, before=before, after=after, **kw)


def sustained(df: DataFrame, keys: Sequence[str], conditions: dict[str, Column], rows: int, pos: str = "pos",
              **kw) -> DataFrame:
    """True where the condition held on this and the ``rows - 1`` rows before."""
    temp = {f"_is_{n}": F.coalesce(c, F.lit(False)).cast("int") for n, c in conditions.items()}
    out = over_rows(df.withColumns(temp), keys, pos, {
        n: (lambda w, n=n: F.sum(f"_is_{n}").over(w.rowsBetween(-(rows - 1), 0)) >= rows) for n in conditions
    }, before=rows - 1, **kw)
    return out.drop(*temp)


def difference(df: DataFrame, keys: Sequence[str], value: str, pos: str = "pos", name: str = "diff", **kw) -> DataFrame:
    """Change from the row before; NULL on the first row."""
    return over_rows(df, keys, pos, {name: lambda w: F.col(value) - F.lag(value).over(w)}, before=1, **kw)


def overlapping_windows(df: DataFrame, keys: Sequence[str], size: int = 60, pos: str = "pos") -> DataFrame:
    """Copies each row into the full windows that hold it: ``window_id`` and ``i``, the
    row's place in the window. Windows start every ``size // 2`` rows."""
    step = max(1, size // 2)
    keys = list(keys)
    lengths = df.groupBy(*keys).agg((F.max(pos) + 1).alias("_len"))
    p, step_c = F.col(pos), F.lit(step).cast("bigint")
    div = lambda a: F.call_function("div", a, step_c)
    lo = F.when(p < size, F.lit(0).cast("bigint")).otherwise(div(p - size + step))
    hi = F.least(div(p), div(F.col("_len") - size))
    return (
        attach(df, lengths, keys)
        .filter((F.col("_len") >= size) & (lo <= hi))
        .withColumn("window_id", F.explode(F.sequence(lo, hi)))
        .withColumn("i", p - F.col("window_id") * step)
        .drop("_len")
    )
