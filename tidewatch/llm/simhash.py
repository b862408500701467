"""Near duplicates by SimHash fingerprints under a generalised pigeonhole.

The 64 bits are dealt into parts, correlated bits together. Part i gets a threshold T(i) of -1 or
more with the sum t - m + 1; two fingerprints within t bits are then within T(i) bits on at least
one part (-1: never asked). The thresholds come from dynamic programming over candidate counts
estimated on a bounded sample; links never depend on the sample.
A part with T(i) = 0 is probed by its own value, with 1 by its values with one bit struck out, and
so on. Fingerprints that share a probe are candidates and verified; a probe shared by more than
``CROWD`` distinct fingerprints is split further on its open bits by the same principle, so no
crowd is ever compared with itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.components import components
from tidewatch.llm.flat import SPACES, pieces, small_batches, sums, words
from tidewatch.plans.staging import drop, stage, stage_at

SAMPLE = 20_000  # fingerprints that the estimates are made on
CROWD = 512  # distinct fingerprints compared directly; nine open bits can't hold more
PARTS = (3, 4, 5)


# -- fingerprints ------------------------------------------------------------

def _fingerprint_piece(data: np.ndarray, bounds: np.ndarray, shingle: int, seed: int) -> np.ndarray:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = np.ones(256, bool)
    inside[list(SPACES)] = False
    starts, ends, own = words(data, bounds, inside)
    n_words = np.diff(own)
    if not len(starts):
        return np.zeros(len(n_words), np.uint64)
    # words with one space behind each
    length = ends - starts + 1
    at = np.concatenate(([0], np.cumsum(length)))
    source = np.repeat(starts - at[:-1], length) + np.arange(at[-1])
    joined = lower[data[np.minimum(source, len(data) - 1)]]
    joined[at[1:] - 1] = 32
    count = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    first = np.repeat(own[:-1] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    last = np.minimum(first + shingle, np.repeat(own[1:], count))
    view, digest = memoryview(joined.tobytes()), xxhash.xxh64_intdigest
    h = np.fromiter((digest(view[a:b], seed) for a, b in zip(at[first].tolist(), (at[last] - 1).tolist())), np.uint64, len(first))
    cuts = np.concatenate(([0], np.cumsum(count)))
    ones = np.zeros((len(count), 64), np.int64)
    for k in range(64):  # a bit at a time: no row of 64 counters per shingle
        ones[:, k] = sums((h >> np.uint64(k)) & np.uint64(1), cuts, np.int64)
    return ((ones * 2 > count[:, None]).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint as a long. Texts without words, null ones included, have 0."""
    small_batches(docs)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, bounds in pieces(b.column(1)):
                fp = _fingerprint_piece(data, bounds, shingle, seed).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], pa.array(fp)], ["doc_id", "fp"])

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, fp long")


# -- parts and thresholds ------------------------------------------------------

def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def correlated_parts(bits: np.ndarray, m: int) -> list[list[int]]:
    """The columns of ``bits`` in m parts of about equal size, each grown by the bit that goes best with it."""
    spread = bits.std(axis=0)
    c = np.abs(np.nan_to_num((bits - bits.mean(axis=0)).T @ (bits - bits.mean(axis=0)) / max(1, len(bits)) / np.maximum(np.outer(spread, spread), 1e-9)))
    left, out = list(range(64)), []
    for k in range(m):
        size = len(left) // (m - k)
        part = [max(left, key=lambda b: c[b, left].sum())]
        left.remove(part[0])
        while len(part) < size:
            best = max(left, key=lambda b: c[b, part].sum())
            part.append(best)
            left.remove(best)
        out.append(sorted(part))
    return out


def masks_of(part: list[int], threshold: int) -> list[int]:
    """Masks of the bits that must agree: all of the part but ``threshold`` of them."""
    if threshold < 0:
        return []
    return [sum(1 << b for b in part if b not in out) for out in combinations(part, min(threshold, len(part)))]


def estimated(values: np.ndarray, masks: list[int], total: int) -> float:
    """Rows and candidates that these probes make over ``total`` fingerprints, from a sample of them."""
    cost = float(total * len(masks))
    for mask in masks[:64]:
        _, n = np.unique(values & np.uint64(mask), return_counts=True)
        cost += float((n * (n - 1) / 2).sum()) * (total / max(1, len(values))) ** 2 * max(1.0, len(masks) / 64)
    return cost


def allocate(values: np.ndarray, parts: list[list[int]], t: int, total: int) -> tuple[float, list[int]]:
    """Cheapest thresholds of -1 or more with the sum t - m + 1, part after part."""
    best = {0: (0.0, [])}
    for part in parts:
        costs = {k: estimated(values, masks_of(part, k), total) for k in range(-1, min(t, 2) + 1)}
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for k, more in costs.items():
                if used + k not in nxt or cost + more < nxt[used + k][0]:
                    nxt[used + k] = (cost + more, [*chosen, k])
        best = nxt
    return best[t - len(parts) + 1]


def plan_probes(values: np.ndarray, t: int, total: int) -> list[int]:
    """Masks of the cheapest division found."""
    bits = ((values[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    tried = []
    for m in (t + 1, t + 2, t + 3):
        parts = correlated_parts(bits, m)
        cost, chosen = allocate(values, parts, t, total)
        tried.append((cost, [mask for part, k in zip(parts, chosen) for mask in masks_of(part, k)]))
    return min(tried)[1]


# -- links -----------------------------------------------------------------------

def _keys(rows: DataFrame, masks: list[int]) -> DataFrame:
    """(mask, key, fp): each fingerprint under every mask."""
    probe = [F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for m in masks]
    return rows.select("fp", F.explode(F.array(*probe)).alias("p")).select("p.mask", "p.key", "fp")


def _near(a: str | Column, b: str | Column, t: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= t


def _forest(batches: Iterator[pa.RecordBatch], t: int) -> Iterator[pa.RecordBatch]:
    """For arrays of at most CROWD fingerprints: each one with the smallest that it reaches inside the array."""
    for b in batches:
        a_out, b_out = [], []
        for values in b.column(0):
            fp = np.unique(np.array(values.as_py(), np.int64))
            u = fp.view(np.uint64)
            near = np.bitwise_count(u[:, None] ^ u[None, :]) <= t
            label = np.arange(len(fp))
            while True:
                nxt = np.where(near, label[None, :], len(fp)).min(axis=1)
                nxt = nxt[nxt]
                if (nxt == label).all():
                    break
                label = nxt
            moved = np.flatnonzero(label != np.arange(len(fp)))
            a_out.append(fp[moved])
            b_out.append(fp[label[moved]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*a_out, np.zeros(0, np.int64)])), pa.array(np.concatenate([*b_out, np.zeros(0, np.int64)]))], ["a", "b"])


def _finer(hot: DataFrame, t: int) -> dict[int, list[int]]:
    """For every crowded mask t + 1 masks that also fix a share of its open bits, each share holding as much of the variation.

    A mask has more than t open bits here, so no share is empty and every new mask is finer.
    """
    ones = [F.avg(F.shiftrightunsigned(F.col("fp"), b).bitwiseAND(1).cast("double")).alias(f"b{b}") for b in range(64)]
    out, lanes = {}, 2 * (t + 1)
    for r in hot.groupBy("mask").agg(*ones).collect():  # one row per mask
        fixed = r["mask"] & (2**64 - 1)
        open_bits = sorted((b for b in range(64) if not fixed >> b & 1), key=lambda b: -r[f"b{b}"] * (1 - r[f"b{b}"]))
        shares = [[b for i, b in enumerate(open_bits) if min(i % lanes, lanes - 1 - i % lanes) == j] for j in range(t + 1)]
        out[r["mask"]] = [fixed | sum(1 << b for b in share) for share in shares]
    return out


def link(distinct: DataFrame, t: int = 2) -> DataFrame:
    """(a, b) pairs of the distinct fingerprints in column ``fp`` that join all that are within t bits, transitively.

    Not every near pair is listed: inside a probe's group each fingerprint points to the smallest that it reaches.
    """
    small_batches(distinct)
    spark = distinct.sparkSession
    total = distinct.count()
    share = min(1.0, SAMPLE / max(1, total))
    order = F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    sample = np.array([r[0] for r in distinct.filter(order).select("fp").collect()], np.int64).view(np.uint64)
    # below a mask with struck-out bits, too, a pair differs in t open bits at most: it agrees on one of t + 1 shares of them
    keys, found, used = _keys(distinct, plan_probes(sample, t, total)), None, []
    while True:
        groups, path = stage_at(keys.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1"), "probes")
        used.append(path)
        pairs = groups.filter("n = 2").filter(_near("a", "b", t)).select("a", "b")
        some = groups.filter("n > 2").select(F.col("mask").alias("_m"), F.col("key").alias("_k"), "n", F.col("a").alias("least"))
        members, path = stage_at(keys.join(some, (F.col("mask") == F.col("_m")) & (F.col("key") == F.col("_k"))).select("mask", "key", "fp", "n", "least"), "members")
        used.append(path)
        few = (members.filter(f"n <= {CROWD}").groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
               .select("fps").mapInArrow(lambda batches: _forest(batches, t), "a long, b long"))
        crowds = members.filter(f"n > {CROWD}")
        all_near = F.bit_count(F.bitwise_not("mask")) <= t  # nothing that is open can keep two of the group apart
        whole = crowds.filter(all_near).filter("fp != least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
        part = stage(pairs.unionByName(few).unionByName(whole), "near")
        found = part if found is None else found.unionByName(part)
        hot = crowds.filter(~all_near).select("mask", "fp").distinct()
        finer = _finer(hot, t)
        if not finer:
            break
        nested = [(m, [_signed(x) for x in finer[m]]) for m in sorted(finer)]
        options = F.create_map(*[x for m, parts in nested for x in (F.lit(m), F.array(*[F.lit(v) for v in parts]))])
        keys = (hot.select("fp", F.explode(options[F.col("mask")]).alias("mask"))
                .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp").distinct())
    drop(spark, *used)
    return found


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable over links).

    Null and empty texts have fingerprint zero and are linked like any other. A document without id has the
    component of its group, null where no member has an id. Repeated rows get equal verdicts; an empty table gives no rows.
    """
    fps = stage(fingerprints(docs, doc_id, text, shingle), "fps")
    distinct = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(link(distinct.select("fp"), bits))
    rooted = stage(distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    lowest = rooted.groupBy(F.col("root").alias("_r")).agg(F.min("first").alias("component_id"))
    classes = stage(rooted.join(lowest, F.col("root") == F.col("_r")).select(F.col("fp").alias("_fp"), "component_id"), "classes")
    return (fps.join(classes, F.col("fp") == F.col("_fp"))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def with_key(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Each row as ``row``, with ``who`` (id, h: a hash of the text) and ``text``."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*columns).alias("row"), F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h")).alias("who"),
                       F.col(text).alias("text"))


def keep_first(keyed: DataFrame, fps: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of ``keyed`` that stay: of each component of ``roots`` over the ``fp`` of (who, fp) the first."""
    order = F.struct(F.col("who.id").isNull().alias("void"), F.col("who.id").alias("id"), F.col("who.h").alias("h"))
    distinct = stage(fps.groupBy("fp").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")), "distinct")
    rooted = stage(distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root")), "rooted")
    lowest = (rooted.groupBy(F.col("root").alias("_r")).agg(F.min("first").alias("stays"), F.sum("n").alias("size")).filter("size > 1"))
    crowded = stage(rooted.join(lowest, F.col("root") == F.col("_r")).select(F.col("fp").alias("_fp"), "stays"), "crowded")
    gone = (fps.join(crowded, F.col("fp") == F.col("_fp"))
            .filter(~(F.col("who.id").eqNullSafe(F.col("stays.id")) & (F.col("who.h") == F.col("stays.h"))))
            .select(F.col("who.id").alias("_id"), F.col("who.h").alias("_h")).distinct())
    gone = stage(gone, "gone")
    kept = keyed.join(gone, F.col("who.id").eqNullSafe(F.col("_id")) & (F.col("who.h") == F.col("_h")), "left_anti")
    # an id and text that occur again, of which one row stays: only such rows are grouped
    again = stage(fps.groupBy(F.col("who.id").alias("_id"), F.col("who.h").alias("_h")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_id", "_h"), "again")
    same = F.col("who.id").eqNullSafe(F.col("_id")) & (F.col("who.h") == F.col("_h"))
    if not again.limit(1).count():
        return kept.select("row.*")
    first = kept.join(again, same, "left_semi").groupBy("who.id", "who.h").agg(F.max_by("row", F.to_json("row")).alias("row")).select("row")
    return kept.join(again, same, "left_anti").select("row").unionByName(first).select("row.*")


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component, that with the smallest id; all columns as they were.

    Of rows that repeat this id one stays, by text and then by the other columns. Only the rows that go
    are looked up, by id and a hash of the text, so kept texts move only where that list is too large to broadcast.
    """
    keyed = with_key(docs, doc_id, text)
    fps = stage(fingerprints(keyed, "who", "text", shingle).withColumnRenamed("doc_id", "who"), "fps")
    return keep_first(keyed, fps, components(link(stage(fps.select("fp").distinct(), "fingerprints"), bits)))
