"""Vectors as short codes: product quantisation over per-dimension value dictionaries.

Components are integers, and a dimension has few different ones. Each dimension gets a dictionary of its
distinct integers and every vector is written once as dictionary codes. In a round the squared difference of
every dictionary value to each entry of the codebook is tabulated, so the distance of a part to all entries
is a gather from one table per dimension and a sum. Dictionaries are bounded: a component outside the
``VALUES`` integers around its dimension's mean has the code that stands for none, and its differences are
computed. All sums are of integers, so results are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.centroids import matrix, whole_vectors
from tidewatch.plans.chunks import match
from tidewatch.plans.staging import drop, stage, stage_at

VALUES = 8192  # integers that a dimension's dictionary may span


def dictionaries(vectors: DataFrame, dims: int) -> list[np.ndarray]:
    """Per dimension the distinct integers of all vectors, in order, as far as they lie within the ``VALUES`` around its mean
    (all of them where the whole range is no wider)."""
    of = [F.get("x", F.lit(i)) for i in range(dims)]
    r = vectors.agg(*[f(c).alias(f"{a}{i}") for i, c in enumerate(of) for a, f in (("lo", F.min), ("hi", F.max), ("mid", F.avg))]).first()
    low = np.array([r[f"lo{i}"] if r[f"hi{i}"] - r[f"lo{i}"] < VALUES else int(np.floor(r[f"mid{i}"])) - VALUES // 2 for i in range(dims)], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((dims, VALUES), bool)
        for b in batches:
            at = matrix(b.column(0), dims) - low
            inside = (at >= 0) & (at < VALUES)
            seen[np.broadcast_to(np.arange(dims), at.shape)[inside], at[inside]] = True
        bits = np.packbits(seen, axis=1, bitorder="little").view(np.int64)
        dim, piece = np.nonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(dim.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(bits[dim, piece])], ["dim", "piece", "bits"])

    found = vectors.select("x").mapInArrow(run, "dim int, piece int, bits long").groupBy("dim", "piece").agg(F.bit_or("bits"))
    bits = np.zeros((dims, VALUES // 64), np.int64)
    for r in found.collect():  # VALUES / 64 rows a dimension
        bits[r[0], r[1]] = r[2]
    seen = np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little")
    return [np.flatnonzero(seen[i]) + low[i] for i in range(dims)]


def encoded(vectors: DataFrame, words: list[np.ndarray], kind: str, label_kind: str) -> DataFrame:
    """(vec_id, label, codes, rest): 16-bit dictionary codes, ``VALUES`` for a value outside; rest: all components of a row that has one."""
    dims = len(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(2), dims).astype(np.int64)
            codes = np.empty(x.shape, np.uint16)
            for i, w in enumerate(words):
                at = np.minimum(np.searchsorted(w, x[:, i]), max(len(w) - 1, 0))
                codes[:, i] = np.where(w[at] == x[:, i], at, VALUES) if len(w) else VALUES
            out = (codes == VALUES).any(axis=1)
            rest = [row.tobytes() if o else None for row, o in zip(x, out)] if out.any() else [None] * len(x)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([row.tobytes() for row in codes], pa.binary()), pa.array(rest, pa.binary())],
                                             ["vec_id", "label", "codes", "rest"])

    return vectors.mapInArrow(run, f"vec_id {kind}, label {label_kind}, codes binary, rest binary")


class Tables:
    """Squared differences of every dictionary value to every entry, one table per dimension; the last line, of the code for none, is zero."""

    def __init__(self, words: list[np.ndarray], books: np.ndarray):
        self.parts, self.entries, self.wide = books.shape
        self.words, self.books = words, books
        self.values = [np.append(w, 0) for w in words]
        self.by_dim = []
        for i, w in enumerate(words):
            d = (w[:, None] - books[i // self.wide, :, i % self.wide][None, :]) ** 2
            self.by_dim.append(np.vstack([d, np.zeros((1, self.entries), np.int64)]))

    def read(self, codes: pa.Array, rest: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions in the tables per component, rows with values outside, and the components of those rows."""
        dims = len(self.words)
        at = np.frombuffer(b"".join(codes.to_pylist()), np.uint16).reshape(-1, dims).astype(np.int64)
        last = np.array([len(w) for w in self.words])
        out = np.flatnonzero((at == VALUES).any(axis=1))
        raw = np.frombuffer(b"".join(rest.take(pa.array(out)).to_pylist()), np.int64).reshape(-1, dims)
        return np.where(at == VALUES, last, at), out, raw

    def nearest(self, at: np.ndarray, out: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each part of each row and the squared distance to it."""
        entry, error = np.empty((len(at), self.parts), np.uint8), np.zeros(len(at), np.int64)
        for p in range(self.parts):
            d = np.zeros((len(at), self.entries), np.int64)
            for i in range(p * self.wide, (p + 1) * self.wide):
                d += self.by_dim[i][at[:, i]]
                if len(out):
                    none = at[out, i] == len(self.words[i])
                    d[out[none]] += (raw[none, i][:, None] - self.books[p, :, i % self.wide][None, :]) ** 2
            entry[:, p] = d.argmin(axis=1)
            error += d[np.arange(len(at)), entry[:, p]]
        return entry, error

    def components(self, at: np.ndarray, out: np.ndarray, raw: np.ndarray, i: int) -> np.ndarray:
        v = self.values[i][at[:, i]]
        if len(out):
            v[out] = raw[:, i]
        return v


def _means(rows: DataFrame, words: list[np.ndarray], books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each used entry at the floor of its parts' mean."""
    parts, entries, wide = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(words, books)
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, wide), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            at, out, raw = tables.read(b.column(0), b.column(1))
            entry, _ = tables.nearest(at, out, raw)
            for p in range(parts):
                n[p] += np.bincount(entry[:, p], minlength=entries)
                member = (entry[:, p][:, None] == np.arange(entries)[None, :]).astype(np.int64)
                v = np.stack([tables.components(at, out, raw, i) for i in range(p * wide, (p + 1) * wide)], axis=1)
                total[p] += member.T @ v
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(n[p, e]), pa.array(total[p, e].tolist(), pa.list_(pa.int64()))],
                                         ["part", "entry", "n", "total"])

    sums = rows.select("codes", "rest").mapInArrow(run, "part int, entry int, n long, total array<long>")
    per = sums.groupBy("part", "entry").agg(F.sum("n"), *[F.sum(F.get("total", F.lit(i))) for i in range(wide)])
    out = books.copy()
    for r in per.collect():  # one row per entry
        out[r[0], r[1]] = [v // r[2] for v in r[3:]]
    return out


def encode(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16,
           rounds: int = 6, scale: int = 4096, dims: int = 64) -> DataFrame:
    """One row per kept vector: vec_id, code (two hex digits a part), error, label, label_error, codebooks_sha256.

    Left out are vectors that are null, hold null or non-finite components, or haven't ``dims`` components, which can't be cut
    into equal parts; other columns but the label aren't read. The codebook of a part starts as that part of the ``entries`` vectors of
    the smallest ids (tied ids: by components; no id: last; fewer vectors make fewer entries). Each round assigns all parts, ties
    to the lower index, and moves each used entry to the floor of its parts' mean. Rows without a label are one group.
    Repeated rows each count. An empty table gives no rows.
    """
    if dims % parts:
        raise ValueError("the parts must be of one width")
    vectors = whole_vectors(rows.withColumn("_pair", F.struct(F.col(id_col).alias("id"), F.col(label).alias("label"))), "_pair", vector, scale, dims)
    vectors = vectors.select(F.col("vec_id.id").alias("vec_id"), F.col("vec_id.label").alias("label"), "x")
    kind, label_kind = (vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    first = vectors.select("vec_id", "x").orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
    if not first:
        return vectors.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), "label", F.lit(0).cast("long").alias("label_error"),
                              F.lit("").alias("codebooks_sha256"))
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, dims // parts).transpose(1, 0, 2).copy()
    words = dictionaries(vectors, dims)
    coded, path = stage_at(encoded(vectors, words, kind, label_kind), "codes")
    for _ in range(rounds):
        books = _means(coded, words, books)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(words, books)
        for b in batches:
            if not b.num_rows:
                continue
            entry, error = tables.nearest(*tables.read(b.column(2), b.column(3)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([e.tobytes().hex() for e in entry]), pa.array(error)], ["vec_id", "label", "code", "error"])

    done = stage(coded.mapInArrow(final, f"vec_id {kind}, label {label_kind}, code string, error long"), "coded")
    drop(rows.sparkSession, path)
    per = done.groupBy("label").agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return match(done, per, ["label"]).select("vec_id", "code", "error", "label", "label_error", F.lit(digest).alias("codebooks_sha256"))
