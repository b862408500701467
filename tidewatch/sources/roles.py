"""Finding the role of columns and typing them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.constants import METRIC_PATTERNS, TIMESTAMP_HINTS, TIMESTAMP_NAMES
from tidewatch.functions.scalar import epoch_us, from_epoch_us, to_number, to_time
from tidewatch.plans.chunks import with_position

TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def numeric_columns(df: DataFrame) -> list[str]:
    """D7."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def parse_share(df: DataFrame, fmt: str | None = None, columns: Sequence[str] | None = None) -> dict[str, tuple[float, bool]]:
    """For each text or time column (of ``columns``): share of all rows that parse as a timestamp, and
    whether every present value does. One aggregation over all of them."""
    fields = [f for f in df.schema if isinstance(f.dataType, (T.StringType, *TIME_TYPES)) and (columns is None or f.name in columns)]
    if not fields:
        return {}
    exprs = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(fields):
        parsed = F.col(f.name) if isinstance(f.dataType, TIME_TYPES) else to_time(F.col(f.name), fmt)
        exprs += [F.count(F.col(f.name)).alias(f"present{i}"), F.count(parsed).alias(f"parsed{i}")]
    row = df.agg(*exprs).first()
    n = max(row["n"], 1)
    return {f.name: (row[f"parsed{i}"] / n, row[f"parsed{i}"] == row[f"present{i}"] > 0)
            for i, f in enumerate(fields)}


def timestamp_column(df: DataFrame, mode: str = "exact", fmt: str | None = None) -> str | None:
    """The timestamp column or None.

    exact: a column with a known name whose values all parse, else the first column of
    which more than half of the rows parse. substring: the first column, in order, that
    is a time or text with a hint in its name, or text of which all values parse. A number
    with a hint in its name stays a metric. Only text before the first such name is read.
    """
    if mode == "exact":
        known = [c for c in df.columns if c.lower() in TIMESTAMP_NAMES]
        shares = parse_share(df, fmt, known)
        named = next((c for c in known if shares.get(c, (0.0, False))[1]), None)
        if named is not None:
            return named
        shares = parse_share(df, fmt)
        return next((c for c in df.columns if shares.get(c, (0.0, False))[0] > 0.5), None)
    if mode != "substring":
        raise ValueError(f"unknown mode {mode!r}")
    candidates = []  # text columns before the first one that its name decides
    for c in df.columns:
        kind = df.schema[c].dataType
        text = isinstance(kind, T.StringType)
        if any(h in c.lower() for h in TIMESTAMP_HINTS) and (text or isinstance(kind, TIME_TYPES)):
            shares = parse_share(df, fmt, candidates)
            return next((x for x in candidates if shares[x][1]), c)
        if text:
            candidates.append(c)
    shares = parse_share(df, fmt, candidates)
    return next((c for c in candidates if shares[c][1]), None)


def ensure_timestamp(df: DataFrame, mode: str = "exact", fmt: str | None = None) -> tuple[DataFrame, str | None]:
    """The frame with its timestamp column parsed, and that column's name."""
    name = timestamp_column(df, mode, fmt)
    if name is None or isinstance(df.schema[name].dataType, TIME_TYPES):
        return df, name
    return df.withColumn(name, to_time(F.col(name), fmt)), name


def parse_times(df: DataFrame, ts: str, strict: bool = False, fmt: str | None = None) -> DataFrame:
    """Parse timestamps. Strict fails on junk; otherwise junk and NULL rows are dropped."""
    if strict:
        return df.withColumn(ts, F.to_timestamp(F.col(ts), fmt) if fmt else F.to_timestamp(F.col(ts)))
    return df.withColumn(ts, to_time(F.col(ts), fmt)).na.drop(subset=[ts])


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """To DOUBLE, junk to NULL."""
    return df.withColumns({c: to_number(F.col(c)) for c in cols})


def synthetic_times(df: DataFrame, order: Sequence[str], ts: str = "timestamp",
                    start: str = "2024-01-01 00:00:00") -> DataFrame:
    """D3: one minute per row from ``start``, in an explicit unique row order."""
    base = epoch_us(F.lit(start).cast("timestamp_ntz"))
    placed = with_position(df, [], order, pos="_pos", count="_n")
    return placed.withColumn(ts, from_epoch_us(base + F.col("_pos") * F.lit(60_000_000), T.TimestampNTZType())).drop("_pos", "_n")


def metric_of(columns: Sequence[str]) -> list[tuple[str, str]]:
    """(metric, source column) by name pattern; unmatched columns become metric_1, metric_2, ..."""
    out, other = [], 0
    for c in columns:
        name = next((m for m, pats in METRIC_PATTERNS.items() if any(p in c.lower() for p in pats)), None)
        if name is None:
            other += 1
            name = f"metric_{other}"
        out.append((name, c))
    return out


def to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Wide readings to (ids, metric, source_column, value)."""
    columns = list(columns) if columns is not None else [c for c in numeric_columns(df) if c not in ids]
    pairs = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit(c).alias("source_column"), F.col(c).cast("double").alias("value"))
        for m, c in metric_of(columns)
    ])
    return df.select(*ids, F.inline(pairs))
