"""Combining flags, reasons, summaries and evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.constants import REASON_CODES
from tidewatch.functions.scalar import any_true, count_true, safe_div


def join_forecast(actual: DataFrame, forecast: DataFrame, on: Sequence[str]) -> DataFrame:
    """Observations left join forecast; the forecast must be unique on ``on``."""
    return actual.join(forecast, on=list(on), how="left")


def join_flags(df: DataFrame, flags: DataFrame, on: Sequence[str]) -> DataFrame:
    """Flags by row key, missing ones false."""
    names = [c for c in flags.columns if c not in on]
    return df.join(flags, on=list(on), how="left").na.fill(False, subset=names)


def union_tagged(frames: dict[str, DataFrame], tag: str = "data_type") -> DataFrame:
    """Union by name, absent columns NULL, each frame's rows tagged with its name."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def vote(df: DataFrame, flags: Sequence[str], needed: int = 2, policy: str = "vote") -> DataFrame:
    """anomaly_score = number of true flags (absent or NULL = false); final_anomaly
    when at least ``needed`` are, or with policy ``any`` when one is."""
    if policy not in ("vote", "any"):
        raise ValueError(f"unknown policy {policy!r}")
    present = [F.coalesce(F.col(c), F.lit(False)).cast("int") for c in flags if c in df.columns]
    score = sum(present, F.lit(0))
    return df.withColumn("anomaly_score", score).withColumn(
        "final_anomaly", F.col("anomaly_score") >= (1 if policy == "any" else needed))


def any_flag(df: DataFrame, flags: Sequence[str], name: str = "is_anomaly") -> DataFrame:
    """N12."""
    return df.withColumn(name, any_true([F.col(c) for c in flags]))


def reasons(codes: Sequence[tuple[str, str]] = REASON_CODES) -> Column:
    """Codes of the true flags joined by ';' in the given order."""
    return F.concat_ws(";", *[F.when(F.col(c), code) for c, code in codes])


def flagged_rows(df: DataFrame, flag: str, order: Sequence[str]) -> DataFrame:
    """Flagged rows in order."""
    return df.filter(F.col(flag)).orderBy(*order)


def anomaly_list(df: DataFrame, flag: str, ts: str, value: str, score: str, keys: Sequence[str] = (),
                 severity: str = "severity") -> DataFrame:
    """Flagged rows, most severe first, time formatted to the minute."""
    return df.filter(F.col(flag)).orderBy(F.desc(score), *keys, ts).select(
        *keys, F.date_format(ts, "yyyy-MM-dd HH:mm").alias("timestamp_text"), F.col(value).alias("value"),
        F.col(score).alias("anomaly_score"), F.col(severity).alias("severity"))


def evaluate(df: DataFrame, label: str, flag: str) -> DataFrame:
    """Confusion counts, precision and recall; a NULL label or flag is false."""
    t, f = F.coalesce(F.col(label), F.lit(False)), F.coalesce(F.col(flag), F.lit(False))
    counts = df.agg(count_true(t & f).alias("tp"), count_true(~t & f).alias("fp"),
                    count_true(t & ~f).alias("fn"), count_true(~t & ~f).alias("tn"))
    ratio = lambda a, b: safe_div(F.col(a).cast("double"), (F.col(a) + F.col(b)).cast("double"))
    return counts.withColumns({"precision": ratio("tp", "fp"), "recall": ratio("tp", "fn")})
