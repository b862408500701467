"""Registry of queries and shared inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.grid import resample_mean

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


# Values exactly between two roundings would come out by the order of summation. Both sides
# add this before rounding to 6 digits.
NUDGE = 1e-9


def nudged(sql: str) -> str:
    """``round(x, 6)`` to ``round(x + NUDGE, 6)`` throughout."""
    out, stack, i = [], [], 0
    while i < len(sql):
        if sql.startswith("round(", i):
            stack.append("round")
            out.append("round((")
            i += 6
            continue
        c = sql[i]
        if c == "(":
            stack.append("(")
        elif c == ")" and stack:
            if stack.pop() == "round":
                body = "".join(out)
                if body.endswith(", 6"):
                    out = [body[:-3], f") + {NUDGE}::DOUBLE, 6"]
                else:
                    cut = body.rindex(",")
                    out = [body[:cut], ")", body[cut:]]
        out.append(c)
        i += 1
    return "".join(out)


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = nudged(sql)
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


KEY = ["event_type"]


def hourly(spark: SparkSession, sf: str, fill: str = "chain") -> DataFrame:
    """events as hourly means per event type: event_type, ts, pos, value."""
    return resample_mean(table(spark, sf, "events"), KEY, "ts", "value", "1h", fill)


def r6(c: str | Column) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) + NUDGE, 6)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Those columns rounded to 6 digits, as the SQL checks do."""
    return df.withColumns({c: r6(c) for c in cols})


# -- SQL fragments -----------------------------------------------------------

def grid_sql(trunc: str = "date_trunc('hour', ts)", step: str = "INTERVAL 1 HOUR", agg: str = "avg(value)",
             key: str = "event_type", source: str = "events") -> str:
    """CTEs ending in ``cells`` (key, ts, value, pos): all bins, empty ones NULL."""
    return f"""
obs AS (SELECT {key}, {trunc} AS ts, {agg} AS value FROM {source} GROUP BY 1, 2),
span AS (SELECT {key}, min(ts) AS lo, max(ts) AS hi FROM obs GROUP BY 1),
spine AS (SELECT {key}, unnest(generate_series(lo, hi, {step})) AS ts FROM span),
cells AS (SELECT s.{key}, s.ts, o.value,
                 row_number() OVER (PARTITION BY s.{key} ORDER BY s.ts) - 1 AS pos
          FROM spine s LEFT JOIN obs o ON s.{key} = o.{key} AND s.ts = o.ts)"""


def near_sql(source: str = "cells", key: str = "event_type", name: str = "near") -> str:
    """CTE with the nearest values (pv, nv) and their positions (pp, np)."""
    back = f"OVER (PARTITION BY {key} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = f"OVER (PARTITION BY {key} ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    p = "CASE WHEN value IS NOT NULL THEN pos END"
    return f"""
{name} AS (SELECT *, last_value(value IGNORE NULLS) {back} AS pv, last_value({p} IGNORE NULLS) {back} AS pp,
                  first_value(value IGNORE NULLS) {ahead} AS nv, first_value({p} IGNORE NULLS) {ahead} AS np
           FROM {source})"""


LINE = "pv + (nv - pv) * (pos - pp) / nullif(np - pp, 0)"
CHAIN = f"coalesce(value, {LINE}, pv, nv)"

# hourly means per event type, filled both ways: CTE ``g`` (event_type, ts, value, pos)
HOURLY = f"""WITH {grid_sql()}, {near_sql()},
g AS (SELECT event_type, ts, pos, {CHAIN} AS value FROM near)"""
