"""A corpus made from documents in five stages: toxic documents out, exact and near duplicates out,
benchmark leaks out, and the rest mixed to target weights.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. In every stage a null
text counts as empty, texts of any length are read whole, other columns pass through under any name, and an
empty table gives an empty one of the same columns. What a stage does with rows without an id, repeated rows
and ties stands with the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontaminate, exact, mix, simhash, toxic
from tidewatch.plans.staging import stage

# The toxicity model is learned, so SQL can't give its rows: tested against brute force instead.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the segment scores don't call toxic. Rows are judged by their text alone, so repeated ones go
    or stay together; an empty text has no segment and stays."""
    return toxic.keep_clean(docs, toxic.learn(docs, _table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id (rows without an id come last); of rows that repeat id and
    text one stays. All empty texts are one text."""
    return exact.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: SimHash fingerprints of three-word shingles that link at two bits.
    The smallest id stays (rows without an id come last); of rows that repeat it one stays."""
    return simhash.near_dedup(docs, shingle=3, bits=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item. Rows are judged by their text alone; an empty text, and a null or empty
    item, matches nothing."""
    return decontaminate.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document, with its source's size and target. No source is a source of its own,
    last in order; rows that repeat an id share its key and are taken alike; an empty text takes nothing."""
    return mix.mix(docs, mix.cycled_weights(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again by the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
