"""Substring duplicates by spans of sentences.

From every sentence the run of several sentences that first holds enough words is hashed, and sentences long
enough to be a passage by themselves are hashed alone; of equal runs anywhere in the corpus the first by
(id, position) stays, and sentences covered by any other are removed. All in built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.bloom import hit, size_for, with_hits
from tidewatch.plans.staging import stage

# A sentence runs to its stops and the space behind them, or to the end of its line; together they are the whole text.
SENTENCE = r"[^.!?\n]+[.!?\n]*\s*|[.!?\n]+\s*"
LEAST_WORDS = 10  # shorter runs are phrases that unrelated texts share
ALONE_WORDS = 20  # a sentence of so many words counts without a neighbour


def split(text: str | Column) -> Column:
    """The text as an array of sentences that, joined, give it back."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SENTENCE), F.lit(0))


def _known(docs: DataFrame) -> DataFrame:
    """(id, text) with two hashes of the text, which tell apart the texts of one id."""
    return docs.select("id", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("again"), "text").alias("t2"))


def _plain(sentence: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(sentence)), r"\s+", " ")


def _spans(docs: DataFrame, least: int, alone: int) -> DataFrame:
    """(id, t1, t2, at, n, h1, h2, digest) of every run: from sentence ``at`` on the fewest, two or more, that hold ``least`` words,
    and sentences by themselves that hold ``alone`` words or, with ``least``, are their whole text. ``n`` goes into the hashes.

    Only the first sentence can be without words, so a run has at most ``least`` + 1 sentences.
    """
    sentences = docs.select("id", "t1", "t2", F.transform(split("text"), _plain).alias("s")).filter(F.size("s") > 0)
    sentences = sentences.withColumn("w", F.transform("s", lambda x: F.regexp_count(x, F.lit(r"\S+"))))
    full = lambda a: (a["n"] >= 2) & (a["words"] >= least)

    def length(i: Column) -> Column:
        none = F.struct(F.lit(0).alias("words"), F.lit(0).alias("n"))
        longer = lambda a, x: F.when(full(a), a).otherwise(F.struct((a["words"] + x).alias("words"), (a["n"] + 1).alias("n")))
        return F.aggregate(F.slice("w", i + 1, max(least, 1) + 1), none, longer, lambda a: F.when(full(a), a["n"]))

    every = F.sequence(F.lit(0), F.size("s") - 1)
    single = F.filter(every, lambda i: (F.get("w", i) >= alone) | ((F.size("s") == 1) & (F.get("w", i) >= least)))
    places = F.concat(F.transform(every, lambda i: F.struct(i.alias("at"), length(i).alias("n"))),
                      F.transform(single, lambda i: F.struct(i.alias("at"), F.lit(1).alias("n"))))
    wide = sentences.select("id", "t1", "t2", "s", F.filter(places, lambda p: p["n"].isNotNull()).alias("p"))
    runs = wide.select("id", "t1", "t2", F.explode(F.transform("p", lambda p: F.struct(
        p["at"].alias("at"), p["n"].alias("n"), F.array_join(F.slice("s", p["at"] + 1, p["n"]), " ").alias("run")))).alias("r")).select("id", "t1", "t2", "r.*")
    h1, h2 = F.xxhash64("n", "run"), F.xxhash64(F.lit("again"), "n", "run")
    return runs.select("id", "t1", "t2", "at", "n", h1.alias("h1"), h2.alias("h2")).withColumn("digest", _code("h1", "h2"))


def _code(h1: str, h2: str) -> Column:
    return F.concat(F.lower(F.lpad(F.hex(h1), 16, "0")), F.lower(F.lpad(F.hex(h2), 16, "0")))


def repeated_sentences(docs: DataFrame, least: int = LEAST_WORDS, alone: int = ALONE_WORDS) -> DataFrame:
    """(id, t1, t2, gone) of (id, text, t1, t2): per text the sorted positions of the sentences that a repeated run covers.

    The first run of each kind is found by an aggregate that is summed up before its shuffle. Then runs are
    made a second time, and only those whose hash may be a repeated one are shuffled to be joined.
    """
    where = F.struct(F.col("id").isNull().alias("void"), "id", "at", "t1", "t2")
    first = (_spans(docs, least, alone).groupBy("h1", "h2").agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
             .select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "first"))
    first = stage(first, "repeated")
    bits = size_for(first.count())
    marked = stage(hit(first.select(_code("_h1", "_h2").alias("digest")), F.col("digest"), bits), "marked")
    again = with_hits(_spans(docs, least, alone), marked, F.col("digest"), bits, "_maybe").filter("_maybe").select("id", "t1", "t2", "at", "n", "h1", "h2")
    later = again.join(first, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).filter(where > F.col("first"))
    covered = later.select("id", "t1", "t2", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("at")).distinct()
    return covered.groupBy("id", "t1", "t2").agg(F.array_sort(F.collect_list("at")).alias("gone"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, alone: int = ALONE_WORDS) -> DataFrame:
    """One row per document: doc_id, n_sentences, n_removed, n_spans (runs of removed sentences), text (what is left).

    Case and spaces don't matter to equality. However short its sentences are, a passage of ``least`` words in whole sentences
    counts, and one sentence by itself from ``alone`` words on or where it is the whole text; a text under ``least`` words never goes.
    Null and empty texts have no sentence and stay empty. Texts with one id (or none) are told apart by two hashes, which
    also order what they repeat at the same position; rows that repeat id and text get equal verdicts. An empty table gives no rows.
    """
    slim = _known(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")))
    gone = stage(repeated_sentences(slim, least, alone), "gone")
    # texts without a repeat are not shuffled, as long as the filter holds the number of those with one
    name = F.concat(F.lower(F.lpad(F.hex(F.xxhash64("id", "t1", "t2")), 16, "0")), F.lower(F.lpad(F.hex(F.xxhash64(F.lit("again"), "id", "t1", "t2")), 16, "0")))
    bits = size_for(gone.count())
    rows = with_hits(slim, stage(hit(gone, name, bits), "marked"), name, bits, "_maybe")
    none = F.array().cast("array<int>")
    same = (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")) & F.col("id").eqNullSafe(F.col("_id"))
    hurt = rows.filter("_maybe").join(gone.withColumnsRenamed({"id": "_id", "t1": "_t1", "t2": "_t2"}), same, "left")
    joined = (rows.filter("not _maybe").select("id", F.coalesce("text", F.lit("")).alias("text"), none.alias("gone"))
              .unionByName(hurt.select("id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("gone", none).alias("gone"))))
    rest = joined.select("id", "gone", F.when(F.size("gone") > 0, split("text")).alias("s"), "text",
                         F.coalesce(F.regexp_count("text", F.lit(SENTENCE)), F.lit(0)).alias("n"))
    mine = F.filter("gone", lambda i: i < F.col("n"))
    stay = F.array_except(F.sequence(F.lit(0), F.col("n") - 1), "gone")  # by hashing: long texts may lose very many sentences
    kept = F.when(F.size(mine) > 0, F.array_join(F.transform(stay, lambda i: F.get("s", i)), "")).otherwise(F.col("text"))
    heads = F.size(F.filter(mine, lambda i, k: F.coalesce(F.get("gone", k - 1) != i - 1, F.lit(True))))
    return rest.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_sentences"), F.size(mine).cast("long").alias("n_removed"),
                       heads.cast("long").alias("n_spans"), kept.alias("text"))
