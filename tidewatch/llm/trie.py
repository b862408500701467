"""Trigrams with quantised probabilities in one run of bytes that is read where it lies.

Levels: the words; per word b the words c that follow it; per word b the words a that precede it (its
contexts a b); per context the c that follow it, each as its rank among all successors of b, which is a
far smaller number than c. Every level is one sequence that rises within each parent's range; ranges are
laid end to end, each starting above the last value of the one before, so the whole level is monotone and
kept in Elias-Fano form, as are the pointers to the ranges. A lookup is a search for the successor of a
value within one bucket of high bits. Probabilities and the weights that contexts leave to shorter ones are 16-bit
codes of their logarithms.
"""

from __future__ import annotations

import mmap
import struct

import numpy as np

STEP = 24 / 65535  # of log10 between neighbouring codes
NONE = 65535


def quantised(log10p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10p / STEP), 0, NONE - 1).astype(np.uint16)


def value_of(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) * -STEP


_ONES, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_IN_BYTE = np.array([[([i for i in range(8) if byte >> i & 1] + [8] * 8)[r] for byte in range(256)] for r in range(8)], np.uint8).ravel()


def _select(words: np.ndarray, before: np.ndarray, i: np.ndarray, ones: bool) -> np.ndarray:
    """Position of the i-th one (or zero); ``before``: how many there are before each word."""
    w = np.searchsorted(before, i, side="right") - 1
    x = words[w] if ones else ~words[w]
    left = (i - before[w]).astype(np.uint64)
    # ones up to and with each byte of a word, side by side in its bytes
    n = x - ((x >> np.uint64(1)) & np.uint64(0x5555555555555555))
    n = (n & np.uint64(0x3333333333333333)) + ((n >> np.uint64(2)) & np.uint64(0x3333333333333333))
    n = ((n + (n >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _ONES
    skip = np.bitwise_count(((left * _ONES | _TOPS) - n) & _TOPS).astype(np.uint64) << np.uint64(3)
    left -= ((n << np.uint64(8)) >> skip) & np.uint64(255)
    return (w.astype(np.int64) << 6) + (skip + _IN_BYTE[((x >> skip) & np.uint64(255)) | (left << np.uint64(8))]).astype(np.int64)


class Monotone:
    """A sequence that never falls, in Elias-Fano form: low bits packed, high bits in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high).astype(np.int64))))
        self.ones, self.zeros = ones[:-1], (np.arange(len(high), dtype=np.int64) << 6) - ones[:-1]
        self.buckets = int((len(high) << 6) - ones[-1]) if len(high) else 0

    @classmethod
    def of(cls, values: np.ndarray) -> Monotone:
        values = values.astype(np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, np.zeros(2, np.uint64), np.zeros(1, np.uint64))
        low_bits = max(0, ((int(values[-1]) + 1) // n).bit_length() - 1)
        top = (values >> np.uint64(low_bits)).astype(np.int64)
        bits = np.zeros(((n + int(top[-1]) + 1 >> 6) + 1) << 6, np.uint8)
        bits[top + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        packed = []
        for i in range(0, n, 1 << 15):
            v = values[i: i + (1 << 15)]
            packed.append(np.packbits((v[:, None] >> np.arange(low_bits, dtype=np.uint64)[None, :] & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"))
        low = np.concatenate(packed) if low_bits else np.zeros(0, np.uint8)
        return cls(n, low_bits, np.concatenate((low, np.zeros(16 + -len(low) % 8, np.uint8))).view(np.uint64), high)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        w, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        v = self.low[w] >> off
        v |= np.where(off > 0, self.low[w + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
        return v & np.uint64((1 << self.low_bits) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        top = (_select(self.high, self.ones, i, True) - i).astype(np.uint64)
        return (top << np.uint64(self.low_bits)) | self._low(i)

    def successor(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of the first element that is not below each value (of its bucket), and whether it equals it."""
        value = value.astype(np.uint64)
        top = np.minimum(value >> np.uint64(self.low_bits), np.uint64(max(self.buckets, 1))).astype(np.int64)
        inside = top < self.buckets
        t = np.where(inside, top, 0)
        hi = np.where(inside, _select(self.high, self.zeros, t, False) - t, self.n)
        lo = np.where(inside & (t > 0), _select(self.high, self.zeros, np.maximum(t - 1, 0), False) - (t - 1), np.where(inside, 0, self.n))
        end, want = hi, value & np.uint64((1 << self.low_bits) - 1)
        lo, hi = np.minimum(lo, self.n), np.minimum(hi, self.n)
        end = hi.copy()
        work = np.flatnonzero(lo < hi)
        while len(work):
            mid = lo[work] + hi[work] >> 1
            below = self._low(mid) < want[work]
            lo[work[below]], hi[work[~below]] = mid[below] + 1, mid[~below]
            work = work[lo[work] < hi[work]]
        found = lo < end
        found[found] = self._low(lo[found]) == want[found]
        return lo, found


def _chained(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Values that rise within each range [starts[j], starts[j + 1]) as one rising sequence over all ranges."""
    full = np.flatnonzero(starts[1:] > starts[:-1])
    spans = values[starts[full + 1] - 1].astype(np.uint64) + np.uint64(1)
    base = np.concatenate((np.zeros(1, np.uint64), np.cumsum(spans)[:-1].astype(np.uint64))) if len(full) else np.zeros(0, np.uint64)
    return values.astype(np.uint64) + np.repeat(base, starts[full + 1] - starts[full])


LEVELS = ("words", "followers_at", "followers", "contexts_at", "contexts", "trigrams_at", "trigrams")


class Trie:
    """Reads the bytes of ``build`` in place, from a file (``open``) or a memory map of a task (``mapped``)."""

    def __init__(self, data) -> None:
        data = np.frombuffer(data, np.uint8) if not isinstance(data, np.ndarray) else data
        self.levels, at = {}, 0
        for name in LEVELS:
            n, low_bits, lows, highs = (int(x) for x in data[at: at + 32].view(np.int64))
            at += 32
            low = data[at: at + 8 * lows].view(np.uint64)
            at += 8 * lows
            self.levels[name] = Monotone(n, low_bits, low, data[at: at + 8 * highs].view(np.uint64))
            at += 8 * highs
        n_contexts, n_trigrams = (int(x) for x in data[at: at + 16].view(np.int64))
        self.backoff = data[at + 16: at + 16 + 2 * n_contexts].view(np.uint16)
        at += 16 + 2 * n_contexts
        self.prob = data[at: at + 2 * n_trigrams].view(np.uint16)

    @classmethod
    def open(cls, path: str) -> Trie:
        return cls(np.memmap(path, np.uint8, "r"))

    @classmethod
    def mapped(cls, data: bytes) -> Trie:
        m = mmap.mmap(-1, max(1, len(data)))
        m[: len(data)] = data
        return cls(m)

    @staticmethod
    def build(words: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, backoff: np.ndarray, prob: np.ndarray) -> bytes:
        """Trigrams sorted by (b, a, c) without repeats, as indexes into the sorted ``words``, with the codes of their
        probabilities; ``backoff`` has a code for each different (b, a), in order."""
        n = len(words)
        new = np.ones(len(a), bool)
        new[1:] = (b[1:] != b[:-1]) | (a[1:] != a[:-1])
        first = np.flatnonzero(new)
        pairs, of = np.unique(b.astype(np.int64) * max(n, 1) + c, return_inverse=True)
        pair_b, pair_c = pairs // max(n, 1), pairs % max(n, 1)
        followers_at = np.searchsorted(pair_b, np.arange(n + 1))
        rank = of - followers_at[b]
        contexts_at = np.searchsorted(b[first], np.arange(n + 1))
        trigrams_at = np.append(first, len(a))
        levels = {"words": words, "followers_at": followers_at, "followers": _chained(pair_c, followers_at), "contexts_at": contexts_at,
                  "contexts": _chained(a[first], contexts_at), "trigrams_at": trigrams_at, "trigrams": _chained(rank, trigrams_at)}
        out = []
        for name in LEVELS:
            m = Monotone.of(levels[name])
            out += [struct.pack("<4q", m.n, m.low_bits, len(m.low), len(m.high)), m.low.tobytes(), m.high.tobytes()]
        return b"".join([*out, struct.pack("<2q", len(first), len(a)), backoff.astype(np.uint16).tobytes(), prob.astype(np.uint16).tobytes()])

    def _within(self, level: str, parent: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position of ``value`` among the children of ``parent`` in a level, the first child's position, and whether it is there.
        Neighbours with one parent share the search for its range."""
        at, seq = self.levels[f"{level}_at"], self.levels[level]
        first = np.flatnonzero(np.diff(parent, prepend=-1))
        many = np.diff(np.append(first, len(parent)))
        start, end = (at[parent[first] + i].astype(np.int64) for i in (0, 1))
        if not seq.n:
            return np.repeat(start, many), np.repeat(start, many), np.zeros(len(parent), bool)
        base = np.where(start > 0, seq[np.maximum(start - 1, 0)] + np.uint64(1), np.uint64(0))
        start, end = np.repeat(start, many), np.repeat(end, many)
        pos, found = seq.successor(np.repeat(base, many) + value.astype(np.uint64))
        return pos, start, found & (pos >= start) & (pos < end)

    def lookup(self, words: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the trigrams' own probabilities (``NONE`` where there is none) and of their contexts' weights (0: all, where
        there is no such context). a, b and c are indexes into ``words``, sorted by (b, a, c)."""
        own, share = np.full(len(a), NONE, np.uint16), np.zeros(len(a), np.uint16)
        index, known = self.levels["words"].successor(words)
        live = np.flatnonzero(known[a] & known[b])
        if not len(live):
            return own, share
        new = np.ones(len(live), bool)
        new[1:] = (np.diff(b[live]) != 0) | (np.diff(a[live]) != 0)
        pair, of = live[new], np.cumsum(new) - 1
        ctx, _, has = self._within("contexts", index[b[pair]], index[a[pair]])
        live, ctx = live[has[of]], ctx[of[has[of]]]
        share[live] = self.backoff[ctx]
        with_c = known[c[live]]
        live, ctx = live[with_c], ctx[with_c]
        if not len(live):
            return own, share
        n = len(words)
        pair, of = np.unique(b[live].astype(np.int64) * n + c[live], return_inverse=True)
        pos, start, has = self._within("followers", index[pair // n], index[pair % n])
        live, ctx, rank = live[has[of]], ctx[has[of]], (pos - start)[of[has[of]]]
        at, _, has = self._within("trigrams", ctx, rank)
        own[live[has]] = self.prob[at[has]]
        return own, share
