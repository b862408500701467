"""Density clustering in many columns (K2) over a tree of balls.

The points are cut into cells, each along its widest columns at their means. Cells of at most ``LEAF * PARTNERS`` points are *blocks*: one row
each, with their points' numbers as bytes. Inside a block the cutting goes on down to leaves of at most ``LEAF`` points. Every cell has a ball:
the mean of its points and the largest distance from it.

* A cell of weight >= min_samples whose ball has a radius of at most eps / 2 is *tight*: all its points are core
  and of one cluster, and no two of them are ever compared.
* Points count their neighbours in their own leaf, then in their own block. Only those that are not core by then ask the blocks
  within reach, and stop asking once they are core.
* Inside a block the core points are linked to pieces of clusters; leaves that are of one piece by then aren't looked at. Between blocks a few
  points of each are compared with those of the next one, and what is not of its group's most frequent cluster then asks the blocks within reach.
* What is not core and has neighbours asks for the pieces they are in.

Asking points and blocks meet as a product of two tables, partition by partition: nothing is copied to disk for it, and a task holds one partition
of blocks and one batch of pairs. Distances are products of matrices; pairs that rounding could decide are told by differences. The driver holds a
center for each cell above the blocks. Points far from each other are never compared; where eps is about the usual distance, those that stay
unsure are compared with all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.plans.chunks import match
from tidewatch.plans.staging import drop, stage, stage_at

LEAF = 512  # different points of a leaf
AXES = 4  # columns along which a cell is cut
ASKS, PARTNERS = 2048, 16  # points that ask at once, leaves' worth of points in a block
SLACK = 1e-9

COUNTED = ("big long, block long, head long, rank long, center array<double>, radius double, x binary, ids binary, ball binary, cuts binary, spots binary, sure binary, "
           "w binary, q long, q_id binary, q_had binary, q_own binary, q_x binary")
CORE = ("big long, block long, rank long, center array<double>, radius double, x binary, ids binary, node binary, cuts binary, spots binary, "
        "rest binary, e_id binary, e_node binary, q long, q_center array<double>, q_radius double, q_id binary, q_x binary")


def _far(a: str | Column, b: str | Column) -> Column:
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, x: s + x))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def _numbers(value: pa.Scalar, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def _vectors(value: pa.Scalar, d: int) -> np.ndarray:
    """The points of a block, as 4-byte numbers where these are exact: the first byte says which."""
    raw = value.as_buffer()
    return np.frombuffer(raw, np.float32 if raw[0] == 4 else np.float64, offset=8).reshape(-1, d)


def _bytes(x: np.ndarray) -> bytes:
    small = x.astype(np.float32)
    kind, x = (4, small) if (small.astype(np.float64) == x).all() else (8, np.asarray(x, np.float64))
    return bytes([kind] * 8) + x.tobytes()


class _Sides:
    """Which of the points ``b`` are within eps of which of ``a``."""

    def __init__(self, a: np.ndarray, b: np.ndarray, eps: float):
        self.a, self.b, self.limit = a, b, eps * eps
        d = a.shape[1]
        with np.errstate(all="ignore"):
            mid = a.mean(axis=0, dtype=np.float64)
            p = a - mid
            q = p if b is a else b - mid
            pp, qq = (p * p).sum(axis=1), (q * q).sum(axis=1)
            reach = (np.sqrt(pp.max(initial=0)) + np.sqrt(qq.max(initial=0))) ** 2
            for kind in (np.float32, np.float64):
                self.err = 2 * (d + 8) * float(np.finfo(kind).eps) * float(reach)
                if self.err <= 0.01 * self.limit:
                    break
            self.left = np.column_stack((p, pp, np.ones(len(p)))).astype(kind)
            self.right = np.column_stack((-2 * q, np.ones(len(q)), qq)).astype(kind)

    def near(self, i, j) -> np.ndarray:
        """For rows ``i`` of a and ``j`` of b, slices or numbers."""
        with np.errstate(all="ignore"):
            far = self.left[i] @ self.right[j].T
            near = far <= self.limit - self.err
            maybe = ~(far > self.limit + self.err)
            if np.count_nonzero(maybe) > np.count_nonzero(near):
                p, q = np.nonzero(maybe & ~near)
                a, b = self.a[i], self.b[j]
                for k in range(0, len(p), 1 << 14):
                    r, s = p[k:k + (1 << 14)], q[k:k + (1 << 14)]
                    near[r, s] = ((a[r].astype(np.float64) - b[s]) ** 2).sum(axis=1) <= self.limit
        return near


def _codes(x: np.ndarray, ids: np.ndarray, axes: np.ndarray, cut: np.ndarray, bits: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    """The child that each point goes to; points that no mean parts (``mixed``) are dealt by their ids."""
    over = np.take_along_axis(x, axes, axis=1) > cut
    code = (over * (1 << np.arange(axes.shape[1]))).sum(axis=1) & ((1 << bits) - 1)
    return np.where(mixed, (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) & ((1 << bits) - 1), code)


class _Tree:
    """Cells down to blocks, of groups that are larger than one. Its first nodes are the groups' roots."""

    def __init__(self, groups: list[int], d: int):
        self.groups, self.d = np.array(sorted(groups), np.int64), d
        self.axes, self.cut = np.zeros((0, AXES), np.int64), np.zeros((0, AXES))
        self.bits, self.mixed, self.first, self.up = (np.zeros(0, np.int64) for _ in range(4))
        self.n, self.w, self.low, self.radius = (np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.float64))
        self.add(np.full(len(groups), -1))

    def add(self, up: np.ndarray) -> None:
        m = len(up)
        self.axes, self.cut = np.vstack((self.axes, np.zeros((m, AXES), np.int64))), np.vstack((self.cut, np.zeros((m, AXES))))
        for name, value in (("bits", 0), ("mixed", 0), ("first", -1), ("n", 0), ("w", 0), ("low", 0), ("radius", 0.0)):
            old = getattr(self, name)
            setattr(self, name, np.concatenate((old, np.full(m, value, old.dtype))))
        self.up = np.concatenate((self.up, up))

    def place(self, big: np.ndarray, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.groups, big)
        while len(i := np.flatnonzero(self.first[at] >= 0)):
            c = at[i]
            at[i] = self.first[c] + _codes(x[i], ids[i], self.axes[c], self.cut[c], self.bits[c], self.mixed[c] > 0)
        return at

    def heads(self, eps: float, least: int) -> np.ndarray:
        """The smallest point of the topmost tight cell that each node is in, or -1."""
        out = np.full(len(self.n), -1, np.int64)
        tight = (self.first >= 0) & (self.radius * 2 * (1 + SLACK) <= eps) & (self.w >= least)
        for i in range(len(out)):
            above = out[self.up[i]] if self.up[i] >= 0 else -1
            out[i] = above if above >= 0 else self.low[i] if tight[i] else -1
        return out

    def ranks(self) -> np.ndarray:
        """The nodes' order in depth."""
        out, k, todo = np.zeros(len(self.n), np.int64), 0, list(range(len(self.groups)))[::-1]
        while todo:
            i = todo.pop()
            out[i], k = k, k + 1
            if self.first[i] >= 0:
                todo += range(int(self.first[i] + (1 << self.bits[i])) - 1, int(self.first[i]) - 1, -1)
        return out


def _bits(n: int, most: int, d: int) -> int:
    return min(AXES, d, max(1, ceil(log2(n / most))))


def grow(points: DataFrame, groups: list[int], d: int) -> _Tree:
    """The tree over points (big, id, w, v) of the ``groups``, by one pass over the points for each level."""
    tree, block = _Tree(groups, d), LEAF * PARTNERS
    opened, center = np.arange(len(groups)), {-1: np.zeros(d)}
    while True:
        start, mids = int(opened[0]), {int(u): center[int(u)] for u in set(tree.up[opened])}

        def look(batches: Iterator[pa.RecordBatch], tree=tree, start=start, mids=mids) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list] = {}
            with np.errstate(all="ignore"):
                for batch in batches:
                    x, ids, w = _matrix(batch["v"]), batch["id"].to_numpy(), batch["w"].to_numpy()
                    at = tree.place(batch["big"].to_numpy(), x, ids) if len(x) else np.zeros(0, np.int64)
                    order = np.argsort(at, kind="stable")
                    edges = np.flatnonzero(np.diff(at[order], prepend=-1, append=-1))
                    for i, j in zip(edges[:-1], edges[1:]):
                        node, rows = int(at[order[i]]), order[i:j]
                        if node < start:
                            continue
                        y = x[rows] - mids[int(tree.up[node])]
                        yy = y * y
                        had = sums.setdefault(node, [0, 0, np.iinfo(np.int64).max, 0.0, np.zeros(y.shape[1]), np.zeros(y.shape[1])])
                        sums[node] = [had[0] + len(rows), had[1] + int(w[rows].sum()), min(had[2], int(ids[rows].min())),
                                      float(np.maximum(had[3], np.sqrt(yy.sum(axis=1).max()))), had[4] + y.sum(axis=0), had[5] + yy.sum(axis=0)]
            names = ("node", "n", "w", "low", "far", "s", "q")
            rows = [dict(zip(names, (k, *v[:4], v[4].tolist(), v[5].tolist()))) for k, v in sums.items()]
            yield pa.RecordBatch.from_pylist(rows, _STATS)

        def total(table: pa.Table) -> pa.Table:
            with np.errstate(all="ignore"):
                return pa.Table.from_pylist([{
                    "node": table["node"][0].as_py(), "n": sum(table["n"].to_pylist()), "w": sum(table["w"].to_pylist()), "low": min(table["low"].to_pylist()),
                    "far": float(np.max(table["far"].to_numpy())), "s": _matrix(table["s"]).sum(axis=0).tolist(), "q": _matrix(table["q"]).sum(axis=0).tolist()}], _STATS)

        kind = "node long, n long, w long, low long, far double, s array<double>, q array<double>"
        rows = points.mapInArrow(look, kind).groupBy("node").applyInArrow(total, kind).collect()
        last, cut, more = tree, [], []
        for r in sorted(rows, key=lambda r: r["node"]):
            i, u = r["node"], int(last.up[r["node"]])
            tree.n[i], tree.w[i], tree.low[i] = r["n"], r["w"], r["low"]
            if u >= 0:
                tree.radius[u] = np.maximum(tree.radius[u], r["far"])
            if r["n"] > block:
                with np.errstate(all="ignore"):
                    mean, spread = np.array(r["s"]) / r["n"], np.array(r["q"]) / r["n"]
                    wide = np.argsort(np.nan_to_num(mean * mean - spread), kind="stable")[:AXES]
                    center[i] = mids[u] + mean
                tree.bits[i], tree.mixed[i] = _bits(r["n"], block, d), u >= 0 and r["n"] == tree.n[u]
                tree.axes[i, :len(wide)], tree.cut[i, :len(wide)] = wide, center[i][wide]
                cut.append(i)
        if not cut:
            return tree
        for i in cut:
            tree.first[i] = len(tree.n) + len(more)
            more += [i] * (1 << int(tree.bits[i]))
        opened = len(tree.n) + np.arange(len(more))
        center = {i: center[i] for i in cut}
        tree.add(np.array(more))


_STATS = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("w", pa.int64()), ("low", pa.int64()), ("far", pa.float64()),
                    ("s", pa.list_(pa.float64())), ("q", pa.list_(pa.float64()))])


def _leaves(x: np.ndarray, ids: np.ndarray, w: np.ndarray, head: int, eps: float, least: int, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of a block's points by leaves, where these start and end, and in that order the smallest point of the tight cell that a point is in, or -1."""
    todo, order, ends, balls = [(np.arange(len(x)), head)], [], [0], []
    while todo:
        rows, ball = todo.pop()
        y = x[rows]
        with np.errstate(all="ignore"):
            mid = y.mean(axis=0, dtype=np.float64)
            away = (y - mid) ** 2
            if ball < 0 and np.sqrt(away.sum(axis=1).max()) * 2 * (1 + SLACK) <= eps and w[rows].sum() >= least:
                ball = int(ids[rows].min())
            if len(rows) > leaf:
                k = _bits(len(rows), leaf, x.shape[1])
                axes = np.argsort(-np.nan_to_num(away.sum(axis=0)), kind="stable")[:k]
                code = ((y[:, axes] > mid[axes]) * (1 << np.arange(k))).sum(axis=1)
                if (code == code[0]).all():
                    code = np.arange(len(rows)) // leaf
                todo += [(rows[code == c], ball) for c in np.unique(code)[::-1]]
                continue
        order.append(rows)
        ends.append(ends[-1] + len(rows))
        balls.append(np.full(len(rows), ball, np.int64))
    return np.concatenate(order), np.array(ends, np.int64), np.concatenate(balls)


def _spots(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A center and a radius for each leaf."""
    out = np.zeros((len(cuts) - 1, x.shape[1] + 1))
    with np.errstate(all="ignore"):
        for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
            out[k, :-1] = x[i:j].mean(axis=0, dtype=np.float64)
            out[k, -1] = np.sqrt(((x[i:j] - out[k, :-1]) ** 2).sum(axis=1).max())
    return out


def _reach(x: np.ndarray, spot: np.ndarray, eps: float) -> np.ndarray:
    """Which points can have neighbours in the leaf."""
    with np.errstate(all="ignore"):
        return ~(np.sqrt(((x - spot[:-1]) ** 2).sum(axis=1)) > (spot[-1] + eps) * (1 + SLACK))


def _ball(x: np.ndarray) -> tuple[list[float], float]:
    with np.errstate(all="ignore"):
        mid = x.mean(axis=0, dtype=np.float64)
        return mid.tolist(), float(np.sqrt(((x - mid) ** 2).sum(axis=1).max()))


def _weigh(near: np.ndarray, w: np.ndarray | None) -> np.ndarray:
    return near @ w if w is not None else np.count_nonzero(near, axis=1)


def _schema(kinds: str) -> pa.Schema:
    of = {"long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    return pa.schema([(c.split()[0], of[c.split()[1]]) for c in kinds.split(", ")])


def _counter(d: int, eps: float, least: int, tree: _Tree | None):
    """A block's row: its points by leaves, those that its own points show to be core, and those that have to ask."""
    heads, ranks = (tree.heads(eps, least), tree.ranks()) if tree else (None, None)
    up, groups, leaf, asks = (tree.up, tree.groups, LEAF, ASKS) if tree else (None, None, LEAF, ASKS)

    def root(node: int) -> int:
        while up[node] >= 0:
            node = up[node]
        return int(groups[node])

    def run(table: pa.Table) -> pa.Table:
        x, ids, w = _matrix(table["v"]).astype(np.float64) + 0.0, table["id"].to_numpy().astype(np.int64), table["w"].to_numpy().astype(np.int64)
        node = table["node"][0].as_py()
        head = int(heads[node]) if node >= 0 else -1
        order, cuts, ball = _leaves(x, ids, w, head, eps, least, leaf)
        x, ids, w = x[order], ids[order], w[order]
        spots, had, sure = _spots(x, cuts), np.zeros(len(x), np.int64), ball >= 0
        if not sure.all():
            sides, weigh = _Sides(x, x, eps), None if (w == 1).all() else w.astype(np.float64)
            part = lambda i, j: None if weigh is None else weigh[i:j]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if not sure[i:j].all():
                    had[i:j] = _weigh(sides.near(slice(i, j), slice(i, j)), part(i, j))
            sure |= had >= least
            for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
                ask = np.flatnonzero(~sure)
                ask = ask[(ask < i) | (ask >= j)]
                ask = ask[_reach(x[ask], spots[k], eps)]
                for a in range(0, len(ask), asks):
                    had[ask[a:a + asks]] += _weigh(sides.near(ask[a:a + asks], slice(i, j)), part(i, j)).astype(np.int64)
                sure |= had >= least
        q, (mid, radius) = np.flatnonzero(~sure), _ball(x)
        row = {"big": root(node) if node >= 0 else None, "block": int(ids.min()), "head": head, "rank": int(ranks[node]) if node >= 0 else 0, "center": mid, "radius": radius,
               "x": _bytes(x), "ids": ids.tobytes(), "ball": ball.tobytes(), "cuts": cuts.tobytes(), "spots": spots.tobytes(), "sure": sure.tobytes(),
               "w": w.tobytes(), "q": len(q), "q_id": ids[q].tobytes(), "q_had": had[q].tobytes(), "q_own": w[q].tobytes(), "q_x": _bytes(x[q])}
        return pa.Table.from_pylist([row], _schema(COUNTED))

    return run


def _product(asks: DataFrame, blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs of asking rows (a_big, a_block, a_center, a_radius, ..) and other blocks of their group within reach."""
    near = ~(_far("a_center", "center") > (F.col("a_radius") + F.col("radius") + F.lit(eps)) * (1 + SLACK))
    return asks.join(blocks.hint("shuffle_replicate_nl"), (F.col("a_big") - F.col("big") == 0) & (F.col("a_block") != F.col("block")) & near)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch[c][i] for c in batch.schema.names}


def _ask(d: int, eps: float, least: int):
    """Neighbours that asking points have in other blocks, until they have enough."""
    asks = ASKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("block", pa.int64()), ("id", pa.int64()), ("had", pa.int64()), ("own", pa.int64()), ("val", pa.int64())])
        now, found = None, None

        def told() -> pa.RecordBatch:
            hit = np.flatnonzero(found)
            return pa.record_batch([pa.array(v, pa.int64()) for v in (np.full(len(hit), now), ids[hit], had[hit], own[hit], found[hit])], schema=kind)

        for r in _rows(batches):
            if r["a_block"].as_py() != now:
                if now is not None:
                    yield told()
                now, ids, had, own = r["a_block"].as_py(), _numbers(r["a_id"]), _numbers(r["a_had"]), _numbers(r["a_own"])
                mine, found = _vectors(r["a_x"], d), np.zeros(len(ids), np.int64)
            x, w, cuts, spots = _vectors(r["x"], d), _numbers(r["w"]), _numbers(r["cuts"]), _numbers(r["spots"], np.float64).reshape(-1, d + 1)
            live = np.flatnonzero(had + found < least)
            if not len(live):
                continue
            sides, weigh = _Sides(mine[live], x, eps), None if (w == 1).all() else w.astype(np.float64)
            for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
                ask = np.flatnonzero(had[live] + found[live] < least)
                ask = ask[_reach(sides.a[ask], spots[k], eps)]
                for a in range(0, len(ask), asks):
                    some = ask[a:a + asks]
                    found[live[some]] += _weigh(sides.near(some, slice(i, j)), None if weigh is None else weigh[i:j]).astype(np.int64)
        if now is not None:
            yield told()

    return run


def _joined(touch: np.ndarray) -> np.ndarray:
    """For each point the first that it reaches over ``touch``."""
    out, left = np.arange(len(touch)), np.ones(len(touch), bool)
    for i in range(len(touch)):
        if left[i]:
            left[i] = False
            front = np.array([i])
            while len(front):
                front = np.flatnonzero(touch[front].any(axis=0) & left)
                left[front], out[front] = False, i
    return out


def _merge(sides: _Sides, i: np.ndarray, j: np.ndarray, mine: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Of the pieces of points ``i`` and ``j`` (given for all points) those that touch: their names, and the first that each reaches."""
    if mine[i].min() == mine[i].max():
        j = j[theirs[j] != mine[i[0]]]
    if len(j) and theirs[j].min() == theirs[j].max():
        i = i[mine[i] != theirs[j[0]]]
    if not len(i) or not len(j):
        return None
    near = sides.near(i, j)
    p, q = np.nonzero(near & (mine[i][:, None] != theirs[j][None, :]))
    if not len(p):
        return None
    names = np.unique(np.concatenate((mine[i[p]], theirs[j[q]])) if len(p) < 2048 else np.concatenate((mine[i], theirs[j])))
    a, b = np.searchsorted(names, mine[i])[p], np.searchsorted(names, theirs[j])[q]
    touch = np.zeros((len(names), len(names)), bool)
    touch[a, b] = touch[b, a] = True
    return names, names[_joined(touch)]


def _link(sides: _Sides, cuts_a: np.ndarray, spots_a: np.ndarray, cuts_b: np.ndarray, spots_b: np.ndarray, mine: np.ndarray, theirs: np.ndarray | None,
          eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Pieces 0.. of two blocks' points (or of one block's, ``theirs`` being None) after leaves within reach are linked, the closest first."""
    both = theirs is None
    theirs = mine if both else theirs
    with np.errstate(all="ignore"):
        away = np.sqrt(((spots_a[:, None, :-1] - spots_b[None, :, :-1]) ** 2).sum(axis=2)) - spots_a[:, None, -1] - spots_b[None, :, -1]
        a, b = np.nonzero(~(away > eps * (1 + SLACK) + SLACK * (spots_a[:, None, -1] + spots_b[None, :, -1])))
    if both:
        a, b = a[a < b], b[a < b]
    for k in np.argsort(away[a, b], kind="stable"):
        i, j = np.arange(cuts_a[a[k]], cuts_a[a[k] + 1]), np.arange(cuts_b[b[k]], cuts_b[b[k] + 1])
        got = _merge(sides, i, j, mine, theirs)
        if got is not None:
            to = np.arange(max(mine.max(), theirs.max()) + 1)
            to[got[0]] = got[1]
            mine = to[mine]
            theirs = mine if both else to[theirs]
            if mine.min() == mine.max() == theirs.min() == theirs.max():
                break
    return mine, theirs


def _piecer(d: int, eps: float, labels: bool):
    """A block's core points with their pieces, named by a core point; the pieces next to its other points, and those points that ask further."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            x, ids, ball, cuts = _vectors(r["x"], d), _numbers(r["ids"]), _numbers(r["ball"]), _numbers(r["cuts"])
            late, seen = (np.array(r[c].as_py() or [], np.int64) for c in ("late", "seen"))
            core = _numbers(r["sure"], bool) | np.isin(ids, late)
            at, rest = np.flatnonzero(core), np.flatnonzero(~core)
            inside = np.concatenate(([0], np.cumsum(core)))[cuts]
            cuts = np.unique(inside)
            y, name = x[at], ids[at]
            if len(at):
                tops, piece = np.unique(np.where(ball[at] >= 0, ball[at], name), return_inverse=True)
                spots = _spots(y, cuts)
                if labels and piece.max() > 0:
                    sides = _Sides(y, y, eps)
                    for i, j in zip(cuts[:-1], cuts[1:]):
                        rows = np.arange(i, j)
                        got = _merge(sides, rows, rows, piece, piece)
                        if got is not None:
                            to = np.arange(len(tops))
                            to[got[0]] = got[1]
                            piece = to[piece]
                    if piece.min() != piece.max():
                        piece, _ = _link(sides, cuts, spots, cuts, spots, piece, None, eps)
                node = tops[piece]
            else:
                cuts, spots, node = np.zeros(1, np.int64), np.zeros((0, d + 1)), np.zeros(0, np.int64)
            known, own = _numbers(r["q_id"]), _numbers(r["q_had"]) > _numbers(r["q_own"])
            rim = rest[np.isin(ids[rest], known[own]) | np.isin(ids[rest], seen)]
            e_id, e_node = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            if len(rim) and len(at):
                sides = _Sides(x[rim], y, eps)
                for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
                    ask = np.flatnonzero(_reach(sides.a, spots[k], eps))
                    p, q = np.nonzero(sides.near(ask, slice(i, j)))
                    e_id.append(ids[rim[ask[p]]])
                    e_node.append(node[i + q])
            ask = rim[np.isin(ids[rim], seen)]
            mid, radius = _ball(y) if len(at) else ([0.0] * d, 0.0)
            q_mid, q_radius = _ball(x[ask]) if len(ask) else ([0.0] * d, 0.0)
            yield pa.RecordBatch.from_pylist([{
                "big": r["big"].as_py(), "block": r["block"].as_py(), "rank": r["rank"].as_py(), "center": mid, "radius": radius, "x": _bytes(y), "ids": name.tobytes(),
                "node": node.tobytes(), "cuts": cuts.tobytes(), "spots": spots.tobytes(), "rest": ids[rest].tobytes(), "e_id": np.concatenate(e_id).tobytes(),
                "e_node": np.concatenate(e_node).tobytes(), "q": len(ask), "q_center": q_mid, "q_radius": q_radius, "q_id": ids[ask].tobytes(), "q_x": _bytes(x[ask])}], _schema(CORE))

    return run


def _flat(names: list[list[str]]):
    """Rows (id, node) of the columns of numbers; without a node where one column is named."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("id", pa.int64()), ("node", pa.int64())])
        for r in _rows(batches):
            for pair in names:
                i = _numbers(r[pair[0]])
                yield pa.record_batch([pa.array(i), pa.array(_numbers(r[pair[1]])) if len(pair) > 1 else pa.nulls(len(i), pa.int64())], schema=kind)

    return run


def _firsts(d: int):
    """Of each piece in a block its smallest core point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("big", pa.int64()), ("block", pa.int64()), ("node", pa.int64()), ("first", pa.list_(pa.float64()))])
        for r in _rows(batches):
            x, node = _vectors(r["x"], d), _numbers(r["node"])
            rows = []
            for n in np.unique(node) if len(node) else ():
                at = np.flatnonzero(node == n)
                for c in range(d):
                    if len(at) == 1:
                        break
                    at = at[x[at, c] == x[at, c].min()]
                rows.append({"big": r["big"].as_py(), "block": r["block"].as_py(), "node": int(n), "first": x[at[0]].astype(np.float64).tolist()})
            yield pa.RecordBatch.from_pylist(rows, kind)

    return run


def _linked(x, own, cuts_a, spots_a, y, theirs, cuts_b, spots_b, eps: float) -> pa.RecordBatch:
    """Links (a, b) between named pieces of two sets of points in leaves."""
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    names, side = np.unique(np.concatenate((own, theirs)), return_inverse=True)
    if len(names) < 2 or not len(own) or not len(theirs):
        return pa.record_batch([pa.array([], pa.int64())] * 2, schema=kind)
    mine, other = _link(_Sides(x, y, eps), cuts_a, spots_a, cuts_b, spots_b, side[:len(own)], side[len(own):], eps)
    got = np.unique(np.column_stack((side, np.concatenate((mine, other)))), axis=0)
    got = got[got[:, 0] != got[:, 1]]
    return pa.record_batch([pa.array(names[got[:, 0]]), pa.array(names[got[:, 1]])], schema=kind)


def _some(d: int):
    """Some core points of a block, at most ``LEAF``."""
    most = LEAF

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _schema("big long, rank long, x binary, node binary")
        for r in _rows(batches):
            x, node = _vectors(r["x"], d), _numbers(r["node"])
            step = max(1, -(-len(x) // most))
            yield pa.RecordBatch.from_pylist([{"big": r["big"].as_py(), "rank": r["rank"].as_py(), "x": _bytes(x[::step]), "node": node[::step].tobytes()}], kind)

    return run


def _beside(d: int, eps: float):
    """Links between some points of a block and some of the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            x, y = _vectors(r["x"], d), _vectors(r["next_x"], d)
            if len(x) and len(y):
                one, two = np.array([0, len(x)]), np.array([0, len(y)])
                yield _linked(x, _numbers(r["node"]), one, _spots(x, one), y, _numbers(r["next_node"]), two, _spots(y, two), eps)

    return run


def _labelled(r: dict) -> np.ndarray:
    """The clusters, as far as linked, of a block's core points."""
    names, labels = (np.array(r[c].as_py(), np.int64) for c in ("names", "labels"))
    order = np.argsort(names)
    return labels[order][np.searchsorted(names[order], _numbers(r["node"]))]


def _part(keep: np.ndarray, cuts: np.ndarray, spots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of the points that are kept."""
    inside = np.concatenate(([0], np.cumsum(keep)))[cuts]
    return np.unique(inside), spots[np.diff(inside) > 0]


def _apart(d: int):
    """The core points of a block that aren't of their group's most frequent cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _schema("a_big long, a_block long, a_rank long, a_center array<double>, a_radius double, a_x binary, a_label binary, a_cuts binary, a_spots binary")
        for r in _rows(batches):
            label, x, spots = _labelled(r), _vectors(r["x"], d), _numbers(r["spots"], np.float64).reshape(-1, d + 1)
            keep = label != r["major"].as_py()
            if keep.any():
                cuts, spots = _part(keep, _numbers(r["cuts"]), spots)
                mid, radius = _ball(x[keep])
                yield pa.RecordBatch.from_pylist([{
                    "a_big": r["big"].as_py(), "a_block": r["block"].as_py(), "a_rank": r["rank"].as_py(), "a_center": mid, "a_radius": radius,
                    "a_x": _bytes(x[keep]), "a_label": label[keep].tobytes(), "a_cuts": cuts.tobytes(), "a_spots": spots.tobytes()}], kind)

    return run


def _across(d: int, eps: float):
    """Links between what is apart in a block and another block; two blocks' points that are apart both meet once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            label, y, cuts, spots = _labelled(r), _vectors(r["x"], d), _numbers(r["cuts"]), _numbers(r["spots"], np.float64).reshape(-1, d + 1)
            if r["rank"].as_py() < r["a_rank"].as_py():
                keep = label == r["major"].as_py()
                cuts, spots = _part(keep, cuts, spots)
                y, label = y[keep], label[keep]
            yield _linked(_vectors(r["a_x"], d), _numbers(r["a_label"]), _numbers(r["a_cuts"]), _numbers(r["a_spots"], np.float64).reshape(-1, d + 1), y, label, cuts, spots, eps)

    return run


def _near(d: int, eps: float):
    """The pieces (id, node) of other blocks next to asking points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("id", pa.int64()), ("node", pa.int64())])
        for r in _rows(batches):
            mine, ids, y, node = _vectors(r["a_x"], d), _numbers(r["a_id"]), _vectors(r["x"], d), _numbers(r["node"])
            if not len(y):
                continue
            sides, cuts, spots = _Sides(mine, y, eps), _numbers(r["cuts"]), _numbers(r["spots"], np.float64).reshape(-1, d + 1)
            for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
                ask = np.flatnonzero(_reach(mine, spots[k], eps))
                p, q = np.nonzero(sides.near(ask, slice(i, j)))
                if len(p):
                    got = np.unique(np.column_stack((ids[ask[p]], node[i + q])), axis=0)
                    yield pa.record_batch([pa.array(got[:, 0]), pa.array(got[:, 1])], schema=kind)

    return run


def _clusters(core: DataFrame, pieces: DataFrame, d: int, eps: float, components) -> DataFrame:
    """(node, label): what the pieces are linked to, within blocks and between them."""
    large = core.filter("big is not null")
    some = stage(large.select("big", "rank", "x", "node").mapInArrow(_some(d), "big long, rank long, x binary, node binary"), "some")
    order = Window.partitionBy("big").orderBy("rank")
    turn = stage(some.select("big", "rank").withColumn("next", F.lead("rank").over(order)).filter("next is not null"), "turns")
    pairs = (some.join(turn, ["big", "rank"]).select("big", "x", "node", F.col("next").alias("rank"))
             .join(some.select("big", "rank", F.col("x").alias("next_x"), F.col("node").alias("next_node")), ["big", "rank"]))
    links = stage(pairs.select("x", "node", "next_x", "next_node").mapInArrow(_beside(d, eps), "a long, b long").distinct(), "links")
    every = pieces.select("node").distinct()
    roots = every.withColumn("label", F.col("node")) if links.isEmpty() else components(every, links)
    told = stage(pieces.filter("big is not null").select("big", "block", "node").join(roots, "node"), "told")
    major = told.groupBy("big", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("big").agg(F.max_by("label", "n").alias("major"))
    maps = told.groupBy("big", "block").agg(F.collect_list(F.struct("node", "label")).alias("of")).join(major, "big")
    maps = stage(maps.select("block", "major", F.col("of.node").alias("names"), F.col("of.label").alias("labels")), "maps")
    other = F.exists("labels", lambda x: x != F.col("major"))
    cells = ["big", "block", "rank", "center", "radius", "x", "node", "cuts", "spots", "names", "labels", "major"]
    apart = large.join(maps.filter(other), "block").select(cells).mapInArrow(
        _apart(d), "a_big long, a_block long, a_rank long, a_center array<double>, a_radius double, a_x binary, a_label binary, a_cuts binary, a_spots binary")
    apart = stage(apart, "apart")
    far = apart.sparkSession.createDataFrame([], "a long, b long")
    if not apart.isEmpty():
        far = _product(apart, large.join(maps, "block").select(cells), eps).drop("center", "a_center", "radius", "a_radius").mapInArrow(_across(d, eps), "a long, b long").distinct()
    far = stage(far, "links")
    return roots if far.isEmpty() else components(every, links.unionByName(far))


def by_cover(points: DataFrame, keys: list[str], d: int, eps: float, min_samples: int, labels: bool, components) -> DataFrame:
    """Verdicts (id, is_core, is_noise, cluster) of different points (keys, id, w, v)."""
    spark, block = points.sparkSession, LEAF * PARTNERS
    if keys:
        large = stage(points.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block).select(*keys, F.monotonically_increasing_id().alias("big")), "large")
        groups = [r.big for r in large.select("big").collect()]
        points = match(points, large, keys, "left") if groups else points.withColumn("big", F.lit(None).cast("long"))
    else:
        groups = [0] if points.count() > block else []
        points = points.withColumn("big", F.lit(0 if groups else None).cast("long"))
    counted = None
    if groups:
        inner = points.filter("big is not null").select("big", "id", "w", "v")
        tree = grow(inner, groups, d)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch["v"])
                at = tree.place(batch["big"].to_numpy(), x, batch["id"].to_numpy()) if len(x) else np.zeros(0, np.int64)
                yield pa.record_batch([pa.array(at, pa.int64()), batch["id"], batch["w"], batch["v"]], ["node", "id", "w", "v"])

        placed = inner.mapInArrow(assign, f"node long, id long, w long, v {dict(points.dtypes)['v']}")
        counted = placed.groupBy("node").applyInArrow(_counter(d, eps, min_samples, tree), COUNTED)
    if keys or not groups:
        small = points.filter("big is null").select(*keys, F.lit(-1).cast("long").alias("node"), "id", "w", "v").groupBy(*keys, "node")
        small = small.applyInArrow(_counter(d, eps, min_samples, None), COUNTED)
        counted = small if counted is None else counted.unionByName(small)
    counted, counted_at = stage_at(counted, "counted")

    asks = stage(counted.filter("big is not null and q > 0").select(*[F.col(c).alias(f"a_{c.removeprefix('q_')}") for c in (
        "big", "block", "center", "radius", "q_id", "q_had", "q_own", "q_x")]), "asks")
    kind = "block long, id long, had long, own long, val long"
    answers = spark.createDataFrame([], kind)
    if groups and not asks.isEmpty():
        met = _product(asks, counted.select("big", "block", "center", "radius", "x", "w", "cuts", "spots"), eps)
        answers = met.select("a_block", "a_id", "a_had", "a_own", "a_x", "x", "w", "cuts", "spots").mapInArrow(_ask(d, eps, min_samples), kind)
    answers = stage(answers.groupBy("block", "id").agg(F.first("had").alias("had"), F.sum("val").alias("val")), "answers")
    enough = F.col("had") + F.col("val") >= min_samples
    lists = answers.groupBy("block").agg(F.collect_list(F.when(enough, F.col("id"))).alias("late"), F.collect_list(F.when(~enough, F.col("id"))).alias("seen"))
    core = counted.join(lists, "block", "left").select("big", "block", "rank", "x", "ids", "ball", "cuts", "sure", "q_id", "q_had", "q_own", "late", "seen")
    core = stage(core.mapInArrow(_piecer(d, eps, labels), CORE), "core")
    drop(spark, counted_at)

    asks = stage(core.filter("big is not null and q > 0").select("big", "block", "q_center", "q_radius", "q_id", "q_x").toDF(
        "a_big", "a_block", "a_center", "a_radius", "a_id", "a_x"), "asks")
    near = core.select("e_id", "e_node").mapInArrow(_flat([["e_id", "e_node"]]), "id long, node long")
    if groups and not asks.isEmpty():
        met = _product(asks, core.select("big", "block", "center", "radius", "x", "node", "cuts", "spots"), eps)
        near = near.unionByName(met.select("a_id", "a_x", "x", "node", "cuts", "spots").mapInArrow(_near(d, eps), "id long, node long"))
    near = stage(near.distinct(), "answers")
    flat = core.select("ids", "node", "rest").mapInArrow(_flat([["ids", "node"], ["rest"]]), "id long, node long")
    if labels:
        pieces = stage(core.select("big", "block", "x", "node").mapInArrow(_firsts(d), "big long, block long, node long, first array<double>"), "pieces")
        roots = _clusters(core, pieces, d, eps, components) if groups else pieces.select("node", F.col("node").alias("label")).distinct()
        of = F.coalesce(F.col("big"), -1 - F.col("block"))
        order = pieces.join(roots, "node").groupBy(of.alias("of"), "label").agg(F.min("first").alias("first"))
        number = F.row_number().over(Window.partitionBy("of").orderBy("first")) - 1
        names = stage(roots.join(order.select("label", number.alias("cluster")), "label").select("node", "cluster"), "clusters")
    else:
        names = flat.filter("node is not null").select("node").distinct().withColumn("cluster", F.lit(0))
    parts = stage(flat.join(names, "node", "left").select("id", "cluster"), "parts")
    border = near.join(names, "node").groupBy("id").agg(F.min("cluster").alias("near"))
    out = parts.join(border, "id", "left")
    return out.select("id", F.col("cluster").isNotNull().alias("is_core"), (F.col("cluster").isNull() & F.col("near").isNull()).alias("is_noise"),
                      F.coalesce("cluster", "near", F.lit(-1)).alias("cluster"))
