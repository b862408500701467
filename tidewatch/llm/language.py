"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts per (n-gram bucket, language) become a matrix of log-probabilities that is sent to all tasks;
texts are scored in numpy, a batch at a time, by summing the rows of their n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import labels as lab
from tidewatch.llm.flat import BASE, MIX, pieces, small_batches, sums
from tidewatch.plans.staging import stage

GRAMS = (1, 2, 3)
MATRIX_CELLS = 1 << 22  # 16 MB: with more languages there are fewer buckets
MOST_BUCKETS = 1 << 16
SMOOTHING = 0.5
UNKNOWN = "und"


@dataclass
class Model:
    langs: list[str]
    buckets: int
    log_p: np.ndarray  # bucket x language
    log_prior: np.ndarray


def _grams(data: np.ndarray, bounds: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per n the buckets of all n-grams that lie within a text, and the texts' bounds among them."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[bounds]
    shift = np.uint64(64 - (buckets - 1).bit_length())
    h = np.zeros(len(points), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        h = h[: max(0, len(points) - n + 1)] * np.uint64(MIX) + points[n - 1:] + np.uint64(n)
        if n in GRAMS:
            inside = np.ones(len(h), bool)
            for k in range(1, n):
                at = ends[1:] - k
                inside[at[(at >= 0) & (at < len(h))]] = False
            mixed = ((h ^ (h >> np.uint64(31))) * np.uint64(BASE)) >> shift
            yield mixed[inside].astype(np.int64), np.concatenate(([0], np.cumsum(inside)))[np.minimum(ends, len(h))]


def learn(docs: DataFrame, folds: int = 3, held: int = 1, most: int = lab.TRAIN_ROWS, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """The model from documents with text and language outside the held-out fold, drawn by a hash of the id if there are over ``most``.

    One row per (bucket, language) comes to the driver, bounded by MATRIX_CELLS. Without any such document there is no language.
    """
    small_batches(docs)
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull() & (lab.fold(doc_id, folds) != held))
    ids = rows.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"))
    per = stage(ids.groupBy("lang").count(), "langs")
    langs = sorted(r["lang"] for r in per.select("lang").collect())
    if not langs:
        return Model([], 2, np.zeros((2, 0), np.float32), np.zeros(0))
    total = per.agg(F.sum("count")).first()[0]
    if total > most:
        rows = rows.filter(F.pmod(F.xxhash64(F.lit("draw"), doc_id), F.lit(1 << 30)) < int((1 << 30) * most / total))
    buckets = max(256, min(MOST_BUCKETS, 1 << ((MATRIX_CELLS // len(langs)).bit_length() - 1)))
    index = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, texts = np.zeros((len(langs), buckets), np.int64), np.zeros(len(langs), np.int64)
        for b in batches:
            of = np.array([index[x] for x in b.column(1).to_pylist()])
            texts += np.bincount(of, minlength=len(langs))
            for i, j, data, bounds in pieces(b.column(0)):
                for grams, ends in _grams(data, bounds, buckets):
                    own = np.repeat(of[i:j], np.diff(ends))
                    count += np.bincount(own * buckets + grams, minlength=count.size).reshape(count.shape)
        lang_at, at = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, np.full(len(langs), -1)).astype(np.int32)), pa.array(np.append(lang_at, np.arange(len(langs))).astype(np.int32)),
                                          pa.array(np.append(count[lang_at, at], texts))], ["bucket", "lang", "n"])

    got = (rows.select(F.lower(F.col(text)).alias("text"), F.col(lang).alias("lang")).mapInArrow(run, "bucket int, lang int, n long")
           .groupBy("bucket", "lang").agg(F.sum("n").alias("n")).toArrow())
    at, of, n = (got.column(c).to_numpy() for c in ("bucket", "lang", "n"))
    count, texts = np.full((buckets, len(langs)), SMOOTHING), np.full(len(langs), SMOOTHING)
    real = at >= 0
    count[at[real], of[real]] += n[real]
    texts[of[~real]] += n[~real]
    return Model(langs, buckets, (np.log(count) - np.log(count.sum(axis=0))).astype(np.float32), np.log(texts / texts.sum()))


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) per document: the likeliest language and its probability.

    Texts that are null or have no letter are ``und`` with score 0, as is everything if no language was learned;
    ties go to the language that is first by name. Repeated rows get equal results.
    """
    small_batches(docs)
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.lower(F.col(text)).alias("text"), letters.alias("letters"))
    names = np.array([*model.langs, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            best, score = np.full(b.num_rows, len(model.langs)), np.zeros(b.num_rows)
            known = b.column(2).to_numpy(zero_copy_only=False) & bool(model.langs)
            for i, j, data, bounds in pieces(b.column(1)) if model.langs else ():
                z = np.repeat(model.log_prior[None, :], j - i, axis=0)
                for grams, ends in _grams(data, bounds, model.buckets):
                    z += sums(model.log_p[grams], ends, np.float64)
                z -= z.max(axis=1, keepdims=True)
                p = np.exp(z)
                best[i:j] = z.argmax(axis=1)
                score[i:j] = 1 / p.sum(axis=1)
            best[~known], score[~known] = len(model.langs), 0.0
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names[best], pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
