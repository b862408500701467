"""Repeated substrings found by run-length indexes over gathered neighbourhoods.

A string of ``length`` bytes has one anchor: the ``gram`` bytes in it with the smallest hash, the first of
them on a tie. Equal strings have their anchors at the same place, so whatever repeats lies in regions (all
strings of one anchor, overlapped) around anchors that occur twice. Regions that are equal as a whole are
settled by their hash. Of the others one of each kind is gathered by anchor, and runs of gathered regions
are indexed: suffix order, Burrows-Wheeler transform, and at the ends of its runs the position, the
position before it in suffix order and their common length. Within a run the common length falls by one
a byte, so these samples give the matching statistics of every position; those of ``length`` or more are marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.bloom import hit, size_for, with_hits
from tidewatch.llm.flat import flat, pieces, prefix, small_batches, span_hash
from tidewatch.plans.staging import stage

LENGTH, GRAM = 400, 64
CROWD = 4096  # regions of one anchor that are indexed together, 3 MB at most; more are settled string by string
INDEX_BYTES = 1 << 19
LONG = 1 << 23  # longer texts are read in overlapping parts


# -- anchors ---------------------------------------------------------------------

def _sliding_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """For each run of w values the place of the smallest, by its upper 40 bits and then the first."""
    v = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
    blocks = -(-len(v) // w)
    padded = np.full(blocks * w, np.uint64(2**64 - 1))
    padded[: len(v)] = v
    padded = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(v) - w + 1
    return (np.minimum(back[:n], ahead[w - 1: w - 1 + n]) & np.uint64((1 << 24) - 1)).astype(np.int64)


def _regions(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, first byte, end byte) of every region of these texts."""
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    run = prefix(data)
    starts = np.arange(len(data) - gram + 1)
    h = span_hash(run, starts, starts + gram)
    anchor = _sliding_argmin(h, length - gram + 1)
    at = np.arange(len(anchor))
    text = np.searchsorted(bounds, at, side="right") - 1
    inside = at + length <= bounds[text + 1]
    at, text, anchor = at[inside], text[inside], anchor[inside]
    if not len(at):
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return text[first], h[anchor[first]], at[first], at[last] + length


def _parts(data: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The piece itself, or a long text in parts that overlap by ``length`` - 1 bytes, with where each begins."""
    if len(data) <= LONG + length:
        yield data, bounds, 0
        return
    for a in range(0, len(data) - length + 1, LONG):
        part = data[a: a + LONG + length - 1]
        yield part, np.array([0, len(part)]), a


def anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, g, r1, r2, first, end, uses) per different region of each row of (k1, k2, text).

    Regions that a text repeats are told once, with 2 uses; rows with uses 0 are stretches of bytes that they cover, marked at once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k1, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, _, data, bounds in pieces(b.column(2)):
                for part, part_bounds, shift in _parts(data, bounds, length):
                    text, g, first, end = _regions(part, part_bounds, length, gram)
                    view, digest = memoryview(part.tobytes()), xxhash.xxh3_128_digest
                    r = np.frombuffer(b"".join([digest(view[a:e]) for a, e in zip(first.tolist(), end.tolist())]), np.int64).reshape(-1, 2)
                    order = np.lexsort((first, r[:, 1], r[:, 0], g, text))
                    same = np.zeros(len(order), bool)
                    s = order
                    same[1:] = (text[s[1:]] == text[s[:-1]]) & (g[s[1:]] == g[s[:-1]]) & (r[s[1:]] == r[s[:-1]]).all(axis=1)
                    head = np.flatnonzero(~same)
                    uses = np.minimum(np.diff(np.append(head, len(order))), 2)
                    one = order[head]
                    again = order[same | np.append(same[1:], False)]
                    again = again[np.argsort(first[again], kind="stable")]
                    a, e, t = first[again], end[again], text[again]
                    # stretches: a new one where the text changes or the bytes so far end before
                    fresh = np.ones(len(a), bool)
                    fresh[1:] = (t[1:] != t[:-1]) | (a[1:] > np.maximum.accumulate(e)[:-1])
                    f = np.flatnonzero(fresh)
                    stops = np.maximum.reduceat(e, f) if len(f) else e[:0]
                    zero = np.zeros(len(f), np.int64)
                    rows, base = np.append(text[one], t[f]), part_bounds[:-1]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(k1[i + rows]), pa.array(k2[i + rows]), pa.array(np.append(g[one].view(np.int64), zero)), pa.array(np.append(r[one, 0], zero)),
                        pa.array(np.append(r[one, 1], zero)), pa.array(np.append(first[one], a[f]) - base[rows] + shift), pa.array(np.append(end[one], stops) - base[rows] + shift),
                        pa.array(np.append(uses, zero).astype(np.int32))], ["k1", "k2", "g", "r1", "r2", "first", "end", "uses"])

    return texts.mapInArrow(run, "k1 long, k2 long, g long, r1 long, r2 long, first long, end long, uses int")


# -- the index --------------------------------------------------------------------

def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes of a text of small numbers in which the last symbol and all separators are unique, by doubling of ranks."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(3, symbols.dtype)]).astype(np.int64)
    key = (padded[:n] << 39) | (padded[1: n + 1] << 26) | (padded[2: n + 2] << 13) | padded[3: n + 3]
    k = 4
    while True:
        order = np.argsort(key)
        step = np.ones(n, np.int64)
        step[0] = 0
        step[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        if rank[order[-1]] == n - 1 or k >= n:
            return order
        key = rank * (n + 1)
        key[: n - k] += rank[k:] + 1
        k *= 2


def run_samples(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with a separator after each part, end of the part per byte, symbols)."""
    data = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    symbols = data.astype(np.int64) + len(parts)
    symbols[ends] = np.arange(len(parts))
    return data, ends, symbols


def long_matches(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, first, end) of the maximal stretches covered by strings of ``length`` bytes that occur twice in the parts."""
    data, ends, symbols = run_samples(parts)
    order = suffix_order(symbols)
    bwt = symbols[order - 1]
    head = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1  # starts of runs; what stands before each is the end of the last one
    p, q = order[head], order[head - 1]
    left = np.minimum(ends[np.searchsorted(ends, p)] - p, ends[np.searchsorted(ends, q)] - q)
    keep = left >= length
    p, q, left = p[keep], q[keep], left[keep]
    run = prefix(data)
    equal = lambda n: span_hash(run, p, p + n) == span_hash(run, q, q + n)
    keep = equal(np.full(len(p), length))
    p, q, left = p[keep], q[keep], left[keep]
    low = np.full(len(p), length)
    while (low < left).any():
        mid = (low + left + 1) // 2
        good = equal(mid)
        low, left = np.where(good, mid, low), np.where(good, left, mid - 1)
    cover = np.bincount(np.concatenate([p, q]), minlength=len(data) + 1) - np.bincount(np.concatenate([p + low, q + low]), minlength=len(data) + 1)
    marked = np.concatenate(([0], (np.cumsum(cover)[: len(data)] > 0).astype(np.int8), [0]))
    edge = np.diff(marked)
    a, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    part = np.searchsorted(ends, a)
    base = np.concatenate(([0], ends[:-1] + 1))[part]
    return part, a - base, e - base


def _indexed(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (g, k1, k2, first, uses, bytes) sorted by g to marks, in indexes of whole anchors of INDEX_BYTES or more."""
    held: list[tuple] = []
    size = 0

    def settle() -> pa.RecordBatch:
        part, a, e = long_matches([h[5] for h in held], length)
        rows = [(held[i][1], held[i][2], held[i][3] + s, held[i][3] + t) for i, s, t in zip(part.tolist(), a.tolist(), e.tolist()) if held[i][4] == 1]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (list(zip(*rows)) or [[]] * 4)], ["k1", "k2", "first", "end"])

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if size >= INDEX_BYTES and row[0] != held[-1][0]:
                yield settle()
                held, size = [], 0
            held.append(row)
            size += len(row[5])
    if held:
        yield settle()


# -- the operator --------------------------------------------------------------------

def _hex(*longs: str) -> Column:
    return F.concat(*[F.lower(F.lpad(F.hex(c), 16, "0")) for c in longs])


def _maybe_in(df: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with boolean _maybe: whether its key may be among ``keys`` (a written table); false is certain."""
    keyed = lambda d: d.withColumn("_g2", F.xxhash64(*columns))
    bits = size_for(keys.count())
    marked = stage(hit(keyed(keys).select(_hex(columns[0], "_g2").alias("digest")), F.col("digest"), bits), "marked")
    return with_hits(keyed(df), marked, _hex(columns[0], "_g2"), bits, "_maybe").drop("_g2")


def repeated_stretches(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(k1, k2, spans) per text of (k1, k2, text) with repeats: [first, end) stretches of bytes, not yet merged."""
    small_batches(texts)
    found = stage(anchors(texts, length, gram), "anchors")
    local = found.filter("uses = 0").select("k1", "k2", "first", "end")
    found = found.filter("uses > 0")
    twice = stage(found.groupBy("g").agg(F.sum("uses").alias("n")).filter("n > 1").select("g"), "anchors-twice")
    found = _maybe_in(found, twice, ["g"]).filter("_maybe").drop("_maybe")
    where = F.struct("k1", "k2", "first", "end")
    kinds = stage(found.groupBy("g", "r1", "r2").agg(F.sum("uses").alias("uses"), F.min(where).alias("at")), "kinds")
    # regions that occur again as a whole
    again = kinds.filter("uses > 1").select(F.col("g").alias("_g"), F.col("r1").alias("_r1"), F.col("r2").alias("_r2"))
    whole = found.join(again, (F.col("g") == F.col("_g")) & (F.col("r1") == F.col("_r1")) & (F.col("r2") == F.col("_r2"))).select("k1", "k2", "first", "end")
    # anchors with different regions: one of each kind is gathered
    mixed = stage(kinds.groupBy(F.col("g").alias("_g")).agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "mixed")
    wanted = stage(kinds.join(mixed, F.col("g") == F.col("_g")).select("g", "kinds", "uses", "at.*")
                   .groupBy("k1", "k2").agg(F.collect_list(F.struct("g", "kinds", "uses", "first", "end")).alias("wanted")), "wanted")
    read = _maybe_in(texts, wanted.select("k1", "k2"), ["k1", "k2"]).filter("_maybe").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    read = read.join(wanted.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "wanted"), (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds_of = [pa.int64()] * 4 + [pa.int64(), pa.int64(), pa.binary()]
        for b in batches:
            rows, held = [], 0
            data, bounds = flat(b.column(2))
            for i, (a, c, wants) in enumerate(zip(*(b.column(x).to_pylist() for x in (0, 1, 3)))):
                text = memoryview(data[bounds[i]: bounds[i + 1]])
                for w in wants:
                    rows.append((w["g"], w["kinds"], a, c, w["first"], w["uses"], bytes(text[w["first"]: w["end"]])))
                    held += 200 + w["end"] - w["first"]
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds_of)], ["g", "kinds", "k1", "k2", "first", "uses", "bytes"])
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds_of)], ["g", "kinds", "k1", "k2", "first", "uses", "bytes"])

    regions = read.select("k1", "k2", "text", "wanted").mapInArrow(cut, "g long, kinds long, k1 long, k2 long, first long, uses long, bytes binary")
    regions = stage(regions, "regions")
    columns = ["g", "k1", "k2", "first", "uses", "bytes"]
    few = (regions.filter(f"kinds <= {CROWD}").select(*columns).repartition("g").sortWithinPartitions("g")
           .mapInArrow(lambda batches: _indexed(batches, length), "k1 long, k2 long, first long, end long"))
    parts = [local, whole, few]
    if mixed.filter(f"kinds > {CROWD}").limit(1).count():
        parts.append(_string_by_string(regions.filter(f"kinds > {CROWD}").select(*columns), length))
    marks = parts[0]
    for p in parts[1:]:
        marks = marks.unionByName(p)
    return marks.distinct().groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("first", "end"))).alias("spans"))


def _string_by_string(regions: DataFrame, length: int) -> DataFrame:
    """Marks of the regions of crowded anchors: every string of ``length`` bytes is hashed and counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                view = memoryview(row[5])
                n = len(view) - length + 1
                w = np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[a: a + length]) for a in range(n)]), np.int64).reshape(-1, 2)
                at = row[3] + np.arange(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, row[1])), pa.array(np.full(n, row[2])), pa.array(at), pa.array(np.full(n, row[4])), pa.array(w[:, 0].copy()), pa.array(w[:, 1].copy())],
                                                 ["k1", "k2", "first", "uses", "w1", "w2"])

    strings = stage(regions.mapInArrow(run, "k1 long, k2 long, first long, uses long, w1 long, w2 long"), "strings")
    again = strings.groupBy(F.col("w1").alias("_w1"), F.col("w2").alias("_w2")).agg(F.sum("uses").alias("n")).filter("n > 1")
    return (strings.filter("uses = 1").join(again, (F.col("w1") == F.col("_w1")) & (F.col("w2") == F.col("_w2")))
            .select("k1", "k2", "first", (F.col("first") + length).alias("end")))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256; with ``keep_text`` also kept, the bytes that stay.

    Every byte goes that lies in a string of ``length`` bytes occurring anywhere else, judged on the input. Null and
    empty texts have no bytes; texts shorter than ``length`` lose none. Texts are told apart by a 128-bit hash, so ids may be null
    or repeat; equal rows get equal results. An empty table gives no rows. Texts without repeats are not shuffled
    as long as the filter holds their number.
    """
    small_batches(docs)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("k1"), F.xxhash64(F.lit("again"), body).alias("k2"), body.alias("text"))
    spans = stage(repeated_stretches(rows.filter(F.octet_length("text") >= length).select("k1", "k2", "text"), length, gram), "stretches")
    rows = _maybe_in(rows, spans.select("k1", "k2"), ["k1", "k2"])
    zero = F.lit(0).cast("long")
    calm = rows.filter("not _maybe").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
                                            F.sha2("text", 256).alias("kept_sha256"), *([F.col("text").cast("binary").alias("kept")] if keep_text else []))
    found = rows.filter("_maybe").join(spans.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "spans"), (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        for b in batches:
            out = []
            data, bounds = flat(b.column(1))
            for i, spans_of in enumerate(b.column(2).to_pylist()):
                own = data[bounds[i]: bounds[i + 1]]
                cover = np.zeros(len(own) + 1, np.int64)
                for s in spans_of or ():
                    cover[s["first"]] += 1
                    cover[s["end"]] -= 1
                gone = np.cumsum(cover)[:-1] > 0
                kept = own[~gone].tobytes()
                starts = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((len(own), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            cols = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            width = 5 if keep_text else 4
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in list(zip(cols, kinds))[:width]]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: width + 1])

    kind = docs.schema[doc_id].dataType.simpleString()
    return calm.unionByName(found.select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_text else "")))
