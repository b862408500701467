"""Exact duplicates by two passes over a Bloom filter.

Pass one marks the bits that two texts or more probe; a text whose bits are not all marked
has no equal and passes without a shuffle. Only the others are grouped.
Null texts count as empty. Rows that share text and id are one row to `exact_groups`
(both carry the same verdict); `exact_dedup` keeps one of them, picked by the other columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.bloom import hit_twice, size_for, with_hits
from tidewatch.plans.staging import stage


def _digest(text: str):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _suspects(slim: DataFrame) -> tuple[DataFrame, int]:
    bits = size_for(slim.count())
    return stage(hit_twice(slim, F.col("text_sha256"), bits), "twice"), bits


def _groups(suspects: DataFrame, doc_id: str) -> DataFrame:
    """(sha, keep, size) of the texts that occur more than once; summed up before the shuffle."""
    return stage(suspects.groupBy(F.col("text_sha256").alias("_sha"))
                 .agg(F.max(doc_id).alias("keep_id"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1"), "groups")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id (largest id among equal texts), group_size, kept, text_sha256.

    A null id is smaller than any other and stays only where no equal text has an id. An empty table gives no rows.
    """
    slim = stage(docs.select(F.col(doc_id).alias("doc_id"), _digest(text).alias("text_sha256")), "digests")
    marked, bits = _suspects(slim)
    rows = with_hits(slim, marked, F.col("text_sha256"), bits, "_again")
    groups = _groups(rows.filter("_again"), "doc_id")
    again = rows.filter("_again").join(groups, F.col("text_sha256") == F.col("_sha"), "left")
    found = F.col("_sha").isNotNull()
    keep = F.when(found, F.col("keep_id")).otherwise(F.col("doc_id"))
    alone = rows.filter("not _again")
    return (alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                         F.lit(True).alias("kept"), "text_sha256")
            .unionByName(again.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                                      F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")))


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row per text, that with the largest id; all columns as they were.

    Whole rows are shuffled only for texts that do have an equal or hit the filter by chance.
    """
    columns = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(doc_id).alias("id"), _digest(text).alias("text_sha256"))
    slim = stage(keyed.select("id", "text_sha256"), "digests")
    marked, bits = _suspects(slim)
    groups = _groups(with_hits(slim, marked, F.col("text_sha256"), bits, "_again").filter("_again"), "id")
    rows = with_hits(keyed, marked, F.col("text_sha256"), bits, "_again")
    again = rows.filter("_again").join(groups, F.col("text_sha256") == F.col("_sha"), "left")
    single = again.filter("_sha is null").select("row")
    largest = again.filter(F.col("_sha").isNotNull() & F.col("id").eqNullSafe(F.col("keep_id")))
    one = largest.groupBy("_sha").agg(F.max_by("row", F.to_json("row")).alias("row")).select("row")
    return rows.filter("not _again").select("row").unionByName(single).unionByName(one).select("row.*")
