"""Benchmark items found in training texts: word n-grams as seeds, then local alignment.

Seeds of an item are all its n-grams, however common: of an edited copy that occurs often, the common
ones may be all that is left. Around each seed hit the item is aligned with the text by Smith-Waterman
over words, so that edited and paraphrased copies score by what is left of the item. Where too few of
the item's words occur around a hit to reach the threshold in any order, the alignment is spared.
Items are broadcast in blocks of a bounded size; each block is one pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewatch.llm.flat import MIX, flat, mixed, pieces, prefix, small_batches, span_hash, words
from tidewatch.plans.staging import stage

SEED_WORDS = 4
BLOCK_BYTES = 16 << 20  # of item texts broadcast at once
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5  # of the score of an unchanged copy

_inside = np.zeros(256, bool)
_inside[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Block:
    """Items of one block: their words as hashes, and per n the sorted seed hashes with the (item, position) of each."""
    ids: list
    tokens: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # hashes, first posting, items, positions


def _tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, own = words(data, bounds, _inside)
    return span_hash(prefix(data), starts, ends), own


def _grams(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n neighbouring words, over text bounds too."""
    if len(tokens) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(tokens) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(MIX) + tokens[k: len(tokens) - n + 1 + k]
    return mixed(out)


def make_block(ids: list, texts: list[str]) -> Block:
    """``texts`` are lower-cased. Items of fewer than ``SEED_WORDS`` words have one seed, all of them; items without words match nothing."""
    hashes, own = _tokens(*flat(pa.array(texts, pa.string())))
    tokens = [hashes[own[i]: own[i + 1]] for i in range(len(ids))]
    found: dict[int, list[tuple[np.ndarray, int]]] = {}
    for i, t in enumerate(tokens):
        if len(t):
            n = min(SEED_WORDS, len(t))
            found.setdefault(n, []).append((_grams(t, n), i))
    seeds = {}
    for n, rows in found.items():
        h = np.concatenate([g for g, _ in rows])
        item = np.concatenate([np.full(len(g), i) for g, i in rows])
        at = np.concatenate([np.arange(len(g)) for g, _ in rows])
        order = np.argsort(h, kind="stable")
        unique, first = np.unique(h[order], return_index=True)
        seeds[n] = (unique, np.append(first, len(h)), item[order], at[order])
    return Block(ids, tokens, seeds)


def _hits(tokens: np.ndarray, own: np.ndarray, n: int, seeds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position in the piece, seed) of every n-gram that is a seed."""
    g = _grams(tokens, n)
    at = np.flatnonzero(table[(g >> np.uint64(44)).astype(np.int64)])
    k = np.minimum(np.searchsorted(seeds, g[at]), len(seeds) - 1)
    good = seeds[k] == g[at]
    at, k = at[good], k[good]
    text = np.searchsorted(own, at, side="right") - 1
    inside = at + n <= own[text + 1]
    return text[inside], at[inside], k[inside]


def _table(seeds: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << 20, bool)
    out[(seeds >> np.uint64(44)).astype(np.int64)] = True
    return out


def best_alignment(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Score of the best local alignment of item a with text part b, and where it ends in b (exclusive)."""
    steps = -GAP * np.arange(len(b) + 1)
    row, top, end = np.zeros(len(b) + 1, np.int64), 0, 0
    for x in a:
        nxt = np.maximum(row + GAP, 0)
        nxt[1:] = np.maximum(nxt[1:], row[:-1] + np.where(b == x, MATCH, MISMATCH))
        row = np.maximum.accumulate(nxt + steps) - steps  # gaps in the item: a running best that falls by one a word
        j = int(row.argmax())
        if row[j] > top:
            top, end = int(row[j]), j
    return top, end


def _matches(column: pa.Array, block: Block, tables: dict[int, np.ndarray], threshold: float) -> list[tuple[int, int, float, int, int]]:
    """(row, item, score, first word, end word) of the best match of each item in each text, from the threshold on."""
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for i, _, data, bounds in pieces(column):
        tokens, own = _tokens(data, bounds)
        spots = []
        for n, (unique, first, item, at) in block.seeds.items():
            text, pos, seed = _hits(tokens, own, n, unique, tables[n])
            if len(seed):
                size = first[seed + 1] - first[seed]
                posting = np.repeat(first[seed] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
                rows = np.column_stack([np.repeat(text, size), item[posting], np.repeat(pos, size) - at[posting]])
                spots.append(rows)
        if not spots:
            continue
        spots = np.unique(np.concatenate(spots), axis=0)
        sizes = np.array([len(t) for t in block.tokens])
        reach = sizes[spots[:, 1]] + 2 * (8 + sizes[spots[:, 1]] // 4)
        new = np.ones(len(spots), bool)
        new[1:] = (spots[1:, :2] != spots[:-1, :2]).any(axis=1) | (spots[1:, 2] - spots[:-1, 2] > reach[1:])
        heads = np.flatnonzero(new)
        for s, e in zip(heads, np.append(heads[1:], len(spots))):
            text, item, low = spots[s]
            m = sizes[item]
            slack = 8 + m // 4
            a = max(own[text], low - slack)
            b = min(own[text + 1], spots[e - 1, 2] + m + slack)
            if np.isin(block.tokens[item], tokens[a:b]).sum() / m < threshold:  # no alignment scores more
                continue
            top, end = best_alignment(block.tokens[item], tokens[a:b])
            score = top / (MATCH * m)
            key = (i + int(text), int(item))
            if score >= threshold and score > best.get(key, (0.0,))[0]:
                back = best_alignment(block.tokens[item][::-1], tokens[a: a + end][::-1])[1]
                best[key] = (float(score), int(a + end - back - own[text]), int(a + end - own[text]))
    return [(*k, *v) for k, v in sorted(best.items())]


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Block]:
    """The items in blocks of about ``BLOCK_BYTES`` of text by a hash of the item."""
    slim = stage(items.select(F.col(item_id).alias("id"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text")), "items")
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + size // BLOCK_BYTES
    for k in range(n):
        rows = slim.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()
        rows.sort(key=lambda r: (str(r["id"]), r["text"]))
        yield make_block([r["id"] for r in rows], [r["text"] for r in rows])


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
            threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word) of every item whose alignment with a text reaches the threshold.

    score is 1 for an unchanged copy. Null and empty texts and items match nothing; repeated rows give repeated
    results; without items or texts there are no rows. Nothing is shuffled.
    """
    small_batches(docs)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.lower(F.col(text)).alias("text"))
    schema = f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, item_id {items.schema[item_id].dataType.simpleString()}, score double, first_word int, end_word int"
    kind = to_arrow_type(items.schema[item_id].dataType)
    out = None
    for block in _blocks(items, item_id, item_text):
        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            tables = {n: _table(s[0]) for n, s in block.seeds.items()}
            for b in batches:
                found = _matches(b.column(1), block, tables, threshold)
                cols = list(zip(*found)) or [[]] * 5
                ids = b.column(0).take(pa.array(cols[0], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([block.ids[k] for k in cols[1]], kind), pa.array(cols[2], pa.float64()),
                                                  pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int32())], ["doc_id", "item_id", "score", "first_word", "end_word"])

        part = slim.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows in which an item is found; columns as they were, and nothing is shuffled."""
    small_batches(docs)
    out = docs
    for block in _blocks(items, item_id, item_text):
        if not block.seeds:
            continue

        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            tables = {n: _table(s[0]) for n, s in block.seeds.items()}
            for b in batches:
                clean = np.ones(b.num_rows, bool)
                clean[[m[0] for m in _matches(b.column(0), block, tables, threshold)]] = False
                yield pa.RecordBatch.from_arrays(b.columns[1:], names=b.schema.names[1:]).filter(pa.array(clean))

        out = out.select(F.lower(F.col(f"`{text}`")).alias("_lower"), *[F.col(f"`{c}`") for c in docs.columns]).mapInArrow(run, docs.schema)
    return out
