"""Labelled rows to learn from, and small models fitted on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.plans.staging import stage

# The most labelled rows that a classifier here is fitted on, drawn by a hash of the id. At 16 bytes a row
# their ids and labels may be broadcast; with more labels the draw gets thinner, never the scored table.
TRAIN_ROWS = 200_000


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; rows without an id are in none."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % folds


def held_out(doc_id: str | Column, folds: int, remainder: int) -> Column:
    return F.coalesce(fold(doc_id, folds) == remainder, F.lit(False))


def drawn(rows: DataFrame, doc_id: str, most: int = TRAIN_ROWS) -> DataFrame:
    """About ``most`` of the rows, all if there are no more; the same ones in every run."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.filter(F.pmod(F.xxhash64(F.lit("draw"), doc_id), F.lit(1 << 30)) < int((1 << 30) * most / n))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, most: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, label, half) of labelled documents outside the held-out fold, one for each distinct text.

    Labels other than 0 and 1 are left out; where one id or one text has several, the largest counts.
    Texts don't move: the bounded list of ids and labels is sent to them.
    """
    given = (labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held))
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    given = stage(drawn(given, "doc_id", most), "labelled")
    slim = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).join(F.broadcast(given), "doc_id")
    one = stage(slim.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.max("label").alias("label"))
                .groupBy("doc_id").agg(F.max("label").alias("label")), "distinct")
    half = F.pmod(F.xxhash64(F.lit("half"), F.col("doc_id")), F.lit(2)).cast("int").alias("half")
    return docs.select("doc_id", "text").join(F.broadcast(one), "doc_id").select("doc_id", "text", "label", half)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Coefficients (first the constant) of a logistic fit by Newton's rule."""
    a = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        g = a.T @ (y - p) - ridge * beta
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(beta))
        step = np.linalg.solve(h, g)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta
