"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.scalar import no_nan
from tidewatch.plans.chunks import attach, running_total


# The rank error of the bracketing sketch is at most n / ACCURACY; a bracket must also reach
# two ranks further, the neighbours a quantile is interpolated between. In ranks: a big
# group has 3 n / ACCURACY > 6 against an error of n / ACCURACY, a small one n / 50 > 4
# against at most 2; a tiny one keeps all its values.
ACCURACY = 10_000
BIG_SLACK, SMALL_SLACK = 3.0 / ACCURACY, 0.02
SMALL, TINY = 2 * ACCURACY, 200


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, qs: dict[str, float]) -> DataFrame:
    """Linear-interpolated quantiles per group: keys and one column per name in ``qs``.

    Two passes, neither shuffling the rows: a quantile sketch per group brackets each wanted
    rank with certainty, then only the few values inside the brackets are kept one by one,
    all smaller ones as one count. Those values are merged into (value, count) and range
    sorted, so that even a bracket of any size never lands in a single task.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    edges = []  # per quantile: low and high for big groups, low and high for small ones
    for q in qs.values():
        for slack in (BIG_SLACK, SMALL_SLACK):
            edges += [max(q - slack, 0.0), min(q + slack, 1.0)]
    sketch = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_total"), F.percentile_approx("_v", edges, ACCURACY).alias("_edge"),
        F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    n = F.col("_total")

    def edge(at: int, outermost: str) -> Column:
        def one(i: int) -> Column:
            return F.col(outermost) if edges[i] in (0.0, 1.0) else F.col("_edge")[i]
        return F.when(n <= TINY, F.col(outermost)).when(n <= SMALL, one(at + 2)).otherwise(one(at))

    brackets = sketch.select(*keys, F.array(*[
        F.struct(F.lit(i).alias("q"), ((n - 1).cast("double") * F.lit(float(q))).alias("rank"),
                 edge(4 * i, "_min").alias("lo"), edge(4 * i + 1, "_max").alias("hi"))
        for i, q in enumerate(qs.values())]).alias("_brackets"))
    placed = attach(rows, brackets, keys).withColumn("_b", F.explode("_brackets"))
    inside = F.when(F.col("_v") >= F.col("_b.lo"), F.col("_v"))  # NULL: below the bracket
    counts = (
        placed.filter(F.col("_v") <= F.col("_b.hi"))
        .groupBy(*keys, F.col("_b.q").alias("_q"), F.col("_b.rank").alias("_rank"), inside.alias("_x"))
        .agg(F.count(F.lit(1)).alias("_n")))
    ranked = running_total(counts, [*keys, "_q"], ["_x"], F.col("_n"), "_before", "_kept")
    low, high = F.floor("_rank"), F.ceil("_rank")
    covers = lambda r: (F.col("_before") <= r) & (r < F.col("_before") + F.col("_n"))
    ends = ranked.filter(covers(low) | covers(high)).groupBy(*keys, "_q").agg(
        F.max(F.when(covers(low), F.col("_x"))).alias("_lo"), F.max(F.when(covers(high), F.col("_x"))).alias("_hi"),
        F.max(F.col("_rank") - low).alias("_f"))
    bracketed = F.when(F.col("_lo").isNotNull() & F.col("_hi").isNotNull(), F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f"))
    checked = F.coalesce(bracketed, F.raise_error(F.lit("quantile outside its bracket")).cast("double"))
    return ends.withColumn("_value", checked).groupBy(*keys).agg(
        *[F.max(F.when(F.col("_q") == i, F.col("_value"))).alias(name) for i, name in enumerate(qs)])


WINDOW_ROWS = 10_000_000  # bracketed values of one quantile that a single sorted window may hold


def column_quantiles(df: DataFrame, cols: Sequence[str], qs: dict[str, float]) -> DataFrame:
    """(column, count, mean, std, min, max, one column per name in ``qs``) of numeric columns, NaN counting as missing.

    The columns stay side by side: one pass for the moments and the sketches, one for the counts below and inside
    the brackets, and one that makes rows only of the values inside. The first two run when this is called, as do the
    sort of a bracket of over ``WINDOW_ROWS`` values; the moments of each column, one row each, pass the driver.
    """
    value = {c: no_nan(F.col(c).cast("double")) for c in cols}
    edges = [e for q in qs.values() for slack in (BIG_SLACK, SMALL_SLACK) for e in (max(q - slack, 0.0), min(q + slack, 1.0))]
    stats = []
    for i, v in enumerate(value.values()):
        stats += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"), F.min(v).alias(f"min{i}"),
                  F.max(v).alias(f"max{i}"), F.percentile_approx(v, edges, ACCURACY).alias(f"edge{i}")]
    row = df.agg(*stats).first()
    brackets = []  # (column number, quantile number, rank, low, high)
    for i in range(len(cols)):
        n, edge = row[f"n{i}"], row[f"edge{i}"]
        for j, q in enumerate(qs.values()):
            at = 4 * j + (2 if n <= SMALL else 0)
            low = row[f"min{i}"] if n <= TINY or edges[at] == 0.0 else edge[at]
            high = row[f"max{i}"] if n <= TINY or edges[at + 1] == 1.0 else edge[at + 1]
            if n:
                brackets.append((i, j, (n - 1) * q, low, high))
    moments = df.sparkSession.createDataFrame(
        [(c, *[row[f"{x}{i}"] for x in ("n", "mean", "std", "min", "max")]) for i, c in enumerate(cols)],
        "column string, count bigint, mean double, std double, min double, max double")
    names = list(qs)
    if not brackets:
        return moments.select("*", *[F.lit(None).cast("double").alias(x) for x in names])
    of = [value[cols[i]] for i, *_ in brackets]
    below = df.agg(*[F.count_if(v < F.lit(b[3])).alias(f"b{k}") for k, (v, b) in enumerate(zip(of, brackets))],
                   *[F.count_if(v.between(b[3], b[4])).alias(f"i{k}") for k, (v, b) in enumerate(zip(of, brackets))]).first()
    cells = F.array(*[F.when(v.between(b[3], b[4]), F.struct(F.lit(k).alias("k"), v.alias("v"))) for k, (v, b) in enumerate(zip(of, brackets))])
    inside = df.select(F.inline(F.filter(cells, lambda x: x.isNotNull()))).groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    if max(below[f"i{k}"] for k in range(len(brackets))) > WINDOW_ROWS:
        ranked = running_total(inside, ["k"], ["v"], F.col("n"), "before", "_all")
    else:
        ranked = inside.withColumn("before", F.sum("n").over(Window.partitionBy("k").orderBy("v")) - F.col("n"))
    facts = F.array(*[F.struct(F.lit(below[f"b{k}"]).cast("bigint").alias("below"), F.lit(float(b[2])).alias("rank"), F.lit(b[0]).alias("c"), F.lit(b[1]).alias("q"))
                      for k, b in enumerate(brackets)])
    ranked = ranked.withColumn("f", facts[F.col("k")]).withColumn("before", F.col("before") + F.col("f.below"))
    low, high = F.floor("f.rank"), F.ceil("f.rank")
    covers = lambda r: (F.col("before") <= r) & (r < F.col("before") + F.col("n"))
    ends = ranked.filter(covers(low) | covers(high)).groupBy(F.col("f.c").alias("c"), F.col("f.q").alias("q")).agg(
        F.max(F.when(covers(low), F.col("v"))).alias("lo"), F.max(F.when(covers(high), F.col("v"))).alias("hi"), F.max(F.col("f.rank") - low).alias("w"))
    known = F.when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("w"))
    known = F.coalesce(known, F.raise_error(F.lit("quantile outside its bracket")).cast("double"))
    column = F.array(*[F.lit(c) for c in cols])[F.col("c")]
    found = ends.withColumn("x", known).groupBy(column.alias("column")).agg(*[F.max(F.when(F.col("q") == j, F.col("x"))).alias(x) for j, x in enumerate(names)])
    return moments.join(found, "column", "left")
