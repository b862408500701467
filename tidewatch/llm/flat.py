"""Texts of an Arrow batch as one run of bytes, for work that numpy does on all texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

PIECE_BYTES = 1 << 20
BATCH_BYTES = "8m"

# The bytes that separate words, and odd bases of the rolling hashes.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
BASE = 0x9E3779B97F4A7C15
MIX = 0xD6E8FEB86659FD93


def small_batches(df: DataFrame) -> None:
    """Arrow batches of this session hold about 8 MB: what a task and its Python worker keep of whole texts at a time.
    A longer text is a batch by itself. The setting is read when a plan runs, so it stays."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 bounds between them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]: bounds[-1]], bounds - bounds[0]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of whole texts of about ``limit`` bytes; a longer text is a run by itself."""
    data, bounds = flat(column)
    n, i = len(bounds) - 1, 0
    while i < n:
        j = int(np.searchsorted(bounds, bounds[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, data[bounds[i]: bounds[j]], bounds[i: j + 1] - bounds[i]
        i = j


def sums(values: np.ndarray, bounds: np.ndarray, dtype=None) -> np.ndarray:
    """Sum of ``values`` between neighbouring bounds, along axis 0; empty runs give 0."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), dtype or values.dtype)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, bounds[:-1][full], axis=0, dtype=out.dtype)
    return out


def words(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes with ``inside[byte]``, cut at text bounds, and per text the bounds in that list."""
    mask = np.zeros(len(data) + 1, bool)
    mask[:-1] = inside[data]
    edge = mask.copy()
    edge[1:] &= ~mask[:-1]
    first = bounds[:-1][bounds[:-1] < len(data)]
    edge[first] = mask[first]
    starts = np.flatnonzero(edge)
    stop = ~mask
    stop[bounds] = True
    at = np.flatnonzero(stop)
    ends = at[np.searchsorted(at, starts, side="right")]
    return starts, ends, np.searchsorted(starts, bounds)


class Cache(dict):
    """Stays where it was filled: a function that travels with a job takes an empty one along."""

    def __reduce__(self):
        return Cache, ()


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = Cache()


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i up to n at least."""
    if base not in _powers or len(_powers[base][0]) <= n:
        size = max(2 * PIECE_BYTES, n + 1)
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.full(size, np.uint64(b), np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[base] = (out[0], out[1])
    return _powers[base]


def prefix(data: np.ndarray, base: int = BASE) -> np.ndarray:
    """Running sums of (byte + 1) * base ** position: n + 1 values."""
    up, _ = powers(base, len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """The same hashes with all bits mixed."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(MIX)
    h ^= h >> np.uint64(29)
    h *= np.uint64(BASE)
    return h ^ (h >> np.uint64(32))


def span_hash(run: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of the bytes in [start, end) from the running sums; equal bytes and lengths give equal hashes anywhere."""
    _, down = powers(base, len(run))
    return mixed((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64))
