"""Ordered work on series of any length.

A window partitioned by series alone puts a hot series into one task. Everything
here that depends on row order therefore works on *chunks*: a series is cut into
runs of at most ``CHUNK_ROWS`` consecutive positions, windows are partitioned by
(series, chunk), and what has to cross a chunk edge travels in one of two ways:

* bounded frames (rolling, lag, lead): the few rows next to the edge are copied
  into the neighbouring chunk as a halo and removed again after the window;
* unbounded carries (fills, running totals, gaps): one summary row per chunk goes
  through a small window over chunks and is joined back.

The contract is a BIGINT position column, dense from 0 within each series. The
grid operator computes it from the bin number; :func:`with_position` computes it
for raw rows with a range-partitioned sort.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewatch.functions.scalar import floor_div
from tidewatch.plans.staging import stage

CHUNK_ROWS = 1 << 16
Exprs = Mapping[str, Callable[[WindowSpec], Column]]


def match(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns, NULL being equal to NULL: rows without a series key are a series, too."""
    other = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & left[c].eqNullSafe(other[f"_on_{c}"])
    return left.join(other, same, how).drop(*[f"_on_{c}" for c in on])


def one_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The series keys as one struct, which is never NULL and equals another with NULLs in the same places."""
    return (df.withColumn("_key", F.struct(*keys)), ["_key"]) if keys else (df, [])


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add per-series statistics (unique on ``keys``) to every row.

    Without keys ``stats`` is one row and becomes a scalar subquery. With keys it is
    a left join without a hint: Spark broadcasts ``stats`` while its measured size is
    under the session threshold and otherwise sort-merges with skew splitting.
    """
    extra = [c for c in stats.columns if c not in keys]
    if keys:
        return match(df, stats, keys, "left")
    row = stats.select(F.struct(*extra).alias("row")).scalar()
    df = df.withColumn("_stats", row)
    return df.withColumns({c: F.col("_stats")[c] for c in extra}).drop("_stats")


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: Column,
                  before: str, total: str) -> DataFrame:
    """Exact exclusive running sum of ``weight`` per series in ``order``.

    ``order`` must be unique within a series. Rows are range-partitioned on
    (keys, order), which balances any skew, and staged; one sum per (series,
    partition) gives the offset of each partition.
    """
    keys, order = list(keys), list(order)
    w_total = "_w"
    staged = stage(
        df.withColumn(w_total, weight.cast("bigint"))
        .repartitionByRange(*[F.col(c) for c in keys + order])
        .withColumn("_part", F.spark_partition_id()),
        "ordered",
    )
    staged, key = one_key(staged, keys)
    by_key = Window.partitionBy(*key)
    parts = staged.groupBy(*key, "_part").agg(F.sum(w_total).alias("_sum")).select(
        *key, "_part",
        F.coalesce(F.sum("_sum").over(by_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"),
        F.sum("_sum").over(by_key).alias(total),
    )
    inside = Window.partitionBy(*key, "_part").orderBy(*order)
    return (
        staged.join(parts, on=[*key, "_part"])
        .withColumn(before, F.sum(w_total).over(inside.rowsBetween(Window.unboundedPreceding, 0))
                    - F.col(w_total) + F.col("_offset"))
        .drop("_part", "_offset", w_total, "_key")
    )


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], pos: str = "pos",
                  count: str = "n_rows") -> DataFrame:
    """Add the 0-based position of each row within its series and the series length."""
    return running_total(df, keys, order, F.lit(1), pos, count)


def chunk_of(pos: str, rows: int) -> Column:
    return floor_div(F.col(pos), rows)


def to_chunks(df: DataFrame, keys: Sequence[str], pos: str, rows: int) -> tuple[DataFrame, list[str]]:
    """Shuffle once to (series, chunk) for a branch of chunk summaries and its join back: the rows and the columns to join on.

    The explicit non-null filter is the one Spark would infer on one side of that join
    only; with it on both, the two branches are the same plan and share one exchange.
    """
    keyed, key = one_key(df.withColumn("_chunk", chunk_of(pos, rows)), keys)
    known = F.lit(True)
    for c in (*key, "_chunk"):
        known = known & F.col(c).isNotNull()
    return keyed.filter(known).repartition(*key, "_chunk"), key


def over_rows(df: DataFrame, keys: Sequence[str], pos: str,
              exprs: Exprs | Sequence[Exprs], before: int = 0, after: int = 0,
              chunk_rows: int | None = None) -> DataFrame:
    """Evaluate window expressions whose frames reach at most ``before`` rows back and
    ``after`` rows ahead.

    Each expression gets the ordered window of its chunk and may frame it, lag or lead.
    A list of mappings is evaluated in turn, later ones seeing the columns of earlier ones.
    """
    rows = max(chunk_rows or CHUNK_ROWS, before, after, 1)
    home = chunk_of(pos, rows)
    offset = F.pmod(F.col(pos), F.lit(rows))
    targets = [home]
    if before:
        targets.append(F.when(offset >= rows - before, home + 1))
    if after:
        targets.append(F.when(offset < after, home - 1))
    halo = F.explode(F.filter(F.array(*targets), lambda c: c.isNotNull()))
    spread = df.withColumn("_chunk", halo if len(targets) > 1 else home)
    window = Window.partitionBy(*keys, "_chunk").orderBy(pos)
    out = spread
    for step in [exprs] if isinstance(exprs, Mapping) else exprs:
        out = out.withColumns({name: build(window) for name, build in step.items()})
    return out.filter(F.col("_chunk") == home).drop("_chunk")


def moving_mean(df: DataFrame, keys: Sequence[str], pos: str, value: str, name: str, before: int, after: int,
                chunk_rows: int | None = None) -> DataFrame:
    """Mean over a long frame as the difference of two running sums: the cost of a row does
    not grow with the frame, as it does for a sliding window."""
    every = (Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = (Window.unboundedPreceding, 0)
    known = F.col(value).isNotNull().cast("bigint")
    sums = {}
    for side, v in (("s", F.coalesce(F.col(value), F.lit(0.0))), ("c", known)):
        sums[f"_{side}"] = lambda w, v=v: F.sum(v).over(w.rowsBetween(*so_far))
        sums[f"_{side}_all"] = lambda w, v=v: F.sum(v).over(w.rowsBetween(*every))
    ends = {}
    for side in ("s", "c"):
        ends[f"_{side}_in"] = lambda w, side=side: (
            F.coalesce(F.lead(f"_{side}", after).over(w) if after else F.col(f"_{side}"), F.col(f"_{side}_all"))
            - F.coalesce(F.lag(f"_{side}", before + 1).over(w), F.lit(0)))
    out = over_rows(df, keys, pos, [sums, ends], before, after, chunk_rows)
    return out.withColumn(name, F.col("_s_in") / F.nullif(F.col("_c_in").cast("double"), F.lit(0.0))).select(*df.columns, name)
