"""Mixing sources to target weights.

Weights share a budget of words; a source that would exceed its epochs is held there and the
excess goes to the others by weight, until none exceeds (water filling). A source at e epochs
takes every document floor(e) times and, in seeded order, documents once more until the rest is met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.plans.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
# The seeded order is 60 bits of a digest; the cut in it is narrowed by 15 bits a pass.
KEY_BITS, STEP_BITS = 60, 15


def size_of(text: str | Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded(doc_id: Column, seed: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def water_fill(sources: DataFrame, budget: float, epochs: float) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight), which has one row per source.

    Sources are held at their limit in rising order of limit per weight; the first k are held
    when the level that the rest would get is not above the next one's limit.
    """
    up = W.orderBy("_ratio", F.col("source").asc_nulls_last())
    before, after = up.rowsBetween(W.unboundedPreceding, -1), up.rowsBetween(0, W.unboundedFollowing)
    all_rows = W.partitionBy()
    out = (sources.withColumn("_limit", F.col("source_size") * F.lit(float(epochs)))
           .withColumn("_ratio", F.col("_limit") / F.col("weight"))
           .withColumn("_held", F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
           .withColumn("_open", F.sum("weight").over(after))
           .withColumn("_budget", F.sum("source_size").over(all_rows) * F.lit(float(budget)))
           .withColumn("_level", (F.col("_budget") - F.col("_held")) / F.col("_open"))
           .withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))).over(all_rows)["_level"]))
    free = F.col("weight") * F.col("_level")
    return out.withColumn("target", F.when(F.col("_level").isNull() | (free > F.col("_limit")), F.col("_limit")).otherwise(free)) \
        .select("source", "source_size", "weight", "target")


def _cuts(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source the last seeded key that is taken once more (-1: none).

    Keys up to the cut add up to the rest of the target; the key at the edge goes with the nearer side.
    Each pass sums sizes by the next 15 bits within the slice that holds the edge, so that no task
    sees more than 32,768 sums of a source.
    """
    same = F.col("source").eqNullSafe(F.col("_source"))
    state = plan.select(F.col("source").alias("_source"), "rest", F.lit(0).cast("long").alias("_slice"), F.lit(0).cast("long").alias("_before"))
    for shift in range(KEY_BITS - STEP_BITS, -1, -STEP_BITS):
        within = sized.join(F.broadcast(state), same & (F.shiftright(F.col("key"), shift + STEP_BITS) == F.col("_slice")))
        sums = within.groupBy("_source", "rest", "_before", F.shiftright(F.col("key"), shift).alias("_part")).agg(F.sum("size").alias("_size"))
        run = W.partitionBy("_source").orderBy("_part")
        sums = sums.withColumn("_end", F.col("_before") + F.sum("_size").over(run)).withColumn("_start", F.col("_end") - F.col("_size"))
        if shift:
            edge = F.min(F.when(F.col("_end") >= F.col("rest"), F.struct("_part", "_start"))).alias("_edge")
            last = F.max(F.struct("_part", "_start")).alias("_last")
            state = stage(sums.groupBy("_source", "rest").agg(edge, last).withColumn("_edge", F.coalesce("_edge", "_last"))
                          .select("_source", "rest", F.col("_edge._part").alias("_slice"), F.col("_edge._start").alias("_before")), "edge")
    taken = F.max(F.when(F.col("_start") + F.col("_size") / 2 <= F.col("rest"), F.col("_part")))
    below = F.min("_part") - 1
    return sums.groupBy("_source").agg(F.coalesce(taken, below).alias("cut"))


def mix(docs: DataFrame, weights: DataFrame, budget: float = 1.5, epochs: float = 2.0, seed: int = 17,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken (words, repeats counted), copies.

    ``weights`` has a row (source, weight > 0) for each source, null being a source of its own; documents
    of a source without a row are not taken (target 0). ``budget`` is a share of all words. Every document
    is taken floor or ceil of its source's epochs times, so never more than ``epochs`` times when that is whole.
    Null and empty texts have size 0. Documents with one id are taken alike. An empty table gives no rows.
    Texts are read once; all later passes read (id, source, size). One row per source is broadcast
    where its table is small by its measured size, which holds for any list of named sources.
    """
    sized = stage(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size_of(F.col(text)).alias("size"),
                              seeded(F.col(doc_id), seed).alias("key")), "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    given = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("weight"))
    totals = totals.join(given, F.col("source").eqNullSafe(F.col("_s")), "left").select("source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    filled = water_fill(totals.filter("weight > 0"), budget, epochs).unionByName(totals.filter("weight <= 0").withColumn("target", F.lit(0.0)))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = stage(filled.withColumn("whole", F.floor(ratio)).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "plan")
    cuts = _cuts(sized, plan)
    plan = stage(plan.join(cuts, F.col("source").eqNullSafe(F.col("_source")), "left")
                 .select(F.col("source").alias("_source"), "source_size", "target", "whole", F.when(F.col("rest") > 0, F.col("cut")).otherwise(-1).alias("cut")), "plan")
    copies = F.col("whole") + F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)
    return (sized.join(plan, F.col("source").eqNullSafe(F.col("_source")))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * copies).cast("long").alias("taken"), copies.cast("int").alias("copies")))


def cycled_weights(docs: DataFrame, cycle: tuple[int, ...] = (3, 1, 2), source: str = "source") -> DataFrame:
    """(source, weight): sources by code point, null last, with the weights of ``cycle`` in turn."""
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    steps = F.array(*[F.lit(float(c)) for c in cycle])
    return docs.select(F.col(source).alias("source")).distinct().withColumn("weight", steps[(rank % len(cycle)).cast("int")])
