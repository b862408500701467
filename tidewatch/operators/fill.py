"""Gap filling by position within a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.plans.chunks import CHUNK_ROWS, to_chunks

METHODS = ("interpolate", "interpolate_both", "chain", "ffill", "bfill", "nearest", "zero", "none")


def point(pos: str, col: str) -> Column:
    """(position, value) where the value is present."""
    return F.when(F.col(col).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(col).alias("v")))


def edge_points(pos: str, cols: Sequence[str]) -> list[Column]:
    """Per-chunk aggregates: the first and last present point of each column."""
    return [agg(point(pos, c)).alias(f"_{side}_{c}")
            for c in cols for side, agg in (("first", F.min), ("last", F.max))]


# Looking ahead is looking back in descending order: a frame that runs to the end of the
# partition is rebuilt for every row, one that starts at its beginning only grows.
SO_FAR = (Window.unboundedPreceding, 0)
EARLIER = (Window.unboundedPreceding, -1)


def carried_points(keys: Sequence[str], cols: Sequence[str]) -> dict[str, Column]:
    """Window over chunks: last point of earlier chunks, first point of later ones."""
    w = Window.partitionBy(*keys)
    back, ahead = w.orderBy("_chunk").rowsBetween(*EARLIER), w.orderBy(F.desc("_chunk")).rowsBetween(*EARLIER)
    out: dict[str, Column] = {}
    for c in cols:
        out[f"_carry_prev_{c}"] = F.last(f"_last_{c}", ignorenulls=True).over(back)
        out[f"_carry_next_{c}"] = F.last(f"_first_{c}", ignorenulls=True).over(ahead)
    return out


def nearest_points(keys: Sequence[str], pos: str, cols: Sequence[str], strictly_after: bool = False) -> dict[str, Column]:
    """Nearest present point at or before / at or after each row, with the carried one
    where the chunk has none; if asked also the nearest one strictly after. Needs the
    ``_carry_*`` columns."""
    w = Window.partitionBy(*keys, "_chunk")
    back, ahead = w.orderBy(pos), w.orderBy(F.desc(pos))
    out: dict[str, Column] = {}
    for c in cols:
        near = F.last(point(pos, c), ignorenulls=True)
        out[f"_prev_{c}"] = F.coalesce(near.over(back.rowsBetween(*SO_FAR)), F.col(f"_carry_prev_{c}"))
        out[f"_next_{c}"] = F.coalesce(near.over(ahead.rowsBetween(*SO_FAR)), F.col(f"_carry_next_{c}"))
        if strictly_after:
            out[f"_after_{c}"] = F.coalesce(near.over(ahead.rowsBetween(*EARLIER)), F.col(f"_carry_next_{c}"))
    return out


def filled(value: Column, pos: Column, prev: Column, nxt: Column, method: str) -> Column:
    """The filled value given the nearest points."""
    line = prev["v"] + (nxt["v"] - prev["v"]) * (pos - prev["p"]) / F.nullif(
        (nxt["p"] - prev["p"]).cast("double"), F.lit(0.0))
    if method == "interpolate":
        return F.coalesce(value, line, prev["v"])
    if method in ("interpolate_both", "chain"):
        return F.coalesce(value, line, prev["v"], nxt["v"])
    if method == "ffill":
        return F.coalesce(value, prev["v"])
    if method == "bfill":
        return F.coalesce(value, nxt["v"])
    if method == "nearest":
        return F.coalesce(value, prev["v"], nxt["v"])
    if method == "zero":
        return F.coalesce(value, F.lit(0).cast("double"))
    if method == "none":
        return value
    raise ValueError(f"unknown fill method {method!r}; one of {METHODS}")


def fill_gaps(df: DataFrame, keys: Sequence[str], pos: str, cols: Sequence[str], method: str = "chain",
              chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Fill NULLs of ``cols`` by position.

    interpolate: linear, leading NULLs stay, trailing take the last value;
    interpolate_both / chain: leading take the first value as well;
    nearest: the last value, before the first one the next; ffill, bfill, zero, none as named.
    """
    if method not in METHODS:
        raise ValueError(f"unknown fill method {method!r}; one of {METHODS}")
    if method == "none":
        return df
    if method == "zero":
        return df.na.fill(0, subset=list(cols))
    # One shuffle to (series, chunk); both branches below read the same exchange.
    base, key = to_chunks(df, keys, pos, chunk_rows)
    carry = (
        base.groupBy(*key, "_chunk").agg(*edge_points(pos, cols))
        .select(*key, "_chunk", *[c.alias(n) for n, c in carried_points(key, cols).items()])
    )
    near = base.join(carry, on=[*key, "_chunk"]).withColumns(nearest_points(key, pos, cols))
    done = near.withColumns({
        c: filled(F.col(c), F.col(pos), F.col(f"_prev_{c}"), F.col(f"_next_{c}"), method) for c in cols
    })
    return done.select(*df.columns)
