"""Connected components over links between longs, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.plans.staging import drop, stage_at


def _roots(parents: DataFrame, path: str) -> tuple[DataFrame, str]:
    """Follows (node, up) to the top by doubling, until nothing moves."""
    spark = parents.sparkSession
    while True:
        above = parents.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
        step = parents.join(above, F.col("up") == F.col("_n"), "left")
        nxt, nxt_path = stage_at(step.select("node", F.coalesce("_u", "up").alias("up"), (F.coalesce("_u", "up") != F.col("up")).alias("moved")), "climb")
        still = nxt.filter("moved").limit(1).count()
        drop(spark, path)
        parents, path = nxt.select("node", "up"), nxt_path
        if not still:
            return parents, path


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node that it reaches.

    Each round hooks every node to its smallest neighbour, climbs to the roots and draws the links
    that still join two trees between their roots; the number of trees at least halves. A staged
    table per round cuts the lineage; replaced ones are dropped.
    """
    spark = links.sparkSession
    links, path = stage_at(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    done, done_path = None, None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked, hooked_path = stage_at(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
                                       .select("node", F.least("node", "up").alias("up")), "hook")
        roots, roots_path = _roots(hooked, hooked_path)
        if done is None:
            done, done_path = roots.select("node", F.col("up").alias("root")), roots_path
        else:
            lift = roots.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
            was = done_path
            done, done_path = stage_at(done.join(lift, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_u", "root").alias("root")), "roots")
            drop(spark, was)
        top = roots.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
        rest = (links.join(top.select(F.col("_n").alias("a"), F.col("_u").alias("ra")), "a")
                .join(top.select(F.col("_n").alias("b"), F.col("_u").alias("rb")), "b").filter("ra != rb")
                .select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct())
        rest, rest_path = stage_at(rest, "links")
        more = rest.limit(1).count()
        drop(spark, path, *([roots_path] if roots_path != done_path else []))
        links, path = rest, rest_path
        if not more:
            drop(spark, path)
            return done
