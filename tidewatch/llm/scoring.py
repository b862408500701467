"""Language-model scores of texts: trigrams with absolute discounting, looked up in Elias-Fano tries.

Texts are read once, into blocks of some million tokens with a vocabulary of their own. What a block needs
to know of the whole corpus it asks for in three rounds, each distinct word, word pair and trigram of the block once,
with its count in the block's training texts: a round deals the questions into shards by a hash, a shard adds the
counts of all blocks up and answers each of them. A pair is dealt by its first word, a trigram by its first two, so
that a shard has all that follows a context; questions under a very frequent first word or pair are dealt by all of their words.
A shard of trigrams builds a trie of its training counts and looks every question up in it.

A pair with a word that occurs once in all texts occurs there and nowhere else, and so does a trigram with such a pair. Nobody
else can ask for it, so it isn't asked for; for the count of a context's followers those of a block go as one number, under
the name ``ONCE``.

    P1(c)       (n(c) + 1) / (N + V + 1)
    P2(c | b)   (max(n(b c) - D, 0) + D * followers(b) * P1(c)) / n(b), and P1(c) where b was never seen
    P3(c | a b) likewise over P2 with n(a b c), n(a b) and the followers of a b; where a b occurs ``HEAVY`` times or
                more, (n(a b c) + MASS * P2) / (n(a b) + MASS), which needs no count of followers

The trie holds the first summand of a trigram and the weight of P2 under its context.

The first token of a text has P2 after a begin mark. Nothing is pruned: what is gathered grows with the corpus.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewatch.llm.flat import SPACES, mixed, pieces, prefix, small_batches, span_hash, words
from tidewatch.llm.labels import held_out
from tidewatch.llm.trie import NONE, Trie, quantised, value_of
from tidewatch.plans.staging import drop, stage_at

DISCOUNT = 0.8
BLOCK_TOKENS = 400_000  # a block ends with the text that reaches them
SHARD_TOKENS, LEAST_SHARDS = 1 << 20, 64
HOT = 65_536  # at most so many words are frequent: pairs that start with one of them are dealt by both words
HEAVY, MASS = 1 << 20, 1000.0
END, WORD = np.uint64(0), np.uint64((1 << 63) - 1)  # hash of the end mark; bits of a word's hash
# Names in pairs and trigrams: a word's number, then a bit that tells frequent words.
BEGIN, ONCE, OFTEN, FIRST = np.uint64(1), np.uint64(3), np.uint64(1), np.uint64(2)
MESSAGE = "kind string, shard int, block long, body binary"

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_inside = np.ones(256, bool)
_inside[list(SPACES)] = False


# -- arrays as bytes -------------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays byte by byte (all first bytes, all second ones, ...), compressed."""
    squeeze = zstandard.ZstdCompressor(level=2)
    return pickle.dumps([(a.dtype.str, len(a), squeeze.compress(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T).tobytes()) if len(a) else b"")
                         for a in arrays])


def unpack(body: bytes) -> list[np.ndarray]:
    loose, out = zstandard.ZstdDecompressor(), []
    for kind, n, data in pickle.loads(body):
        a = np.zeros(0, kind) if not n else np.ascontiguousarray(np.frombuffer(loose.decompress(data), np.uint8).reshape(-1, n).T).view(kind).ravel()
        out.append(a)
    return out


def _messages(rows: list[tuple]) -> pa.Table:
    kind, shard, block, body = zip(*rows) if rows else ((), (), (), ())
    return pa.table([pa.array(kind, pa.string()), pa.array(shard, pa.int32()), pa.array(block, pa.int64()), pa.array(body, pa.binary())], ["kind", "shard", "block", "body"])


# -- blocks ------------------------------------------------------------------------

def _tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per piece of whole texts its first and end row, hashes of the words of each text with an end mark behind, and tokens per text."""
    for i, j, data, bounds in pieces(column):
        data = _lower[data]
        starts, ends, own = words(data, bounds, _inside)
        h = np.maximum(span_hash(prefix(data), starts, ends) & WORD, np.uint64(1))
        yield i, j, np.insert(h, own[1:], END), np.diff(own) + 1


def make_blocks(docs: DataFrame, doc_id: str, text: str, folds: int, held: int) -> DataFrame:
    """(block, ids, held, tokens, words, body): whole texts of ``BLOCK_TOKENS`` or more, as indexes into the block's vocabulary,
    frequent words first."""
    small_batches(docs)
    slim = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), held_out(doc_id, folds, held).alias("held"))
    id_type = slim.schema["id"].dataType
    names = ["part", "ids", "held", "tokens", "words", "body"]

    def close(ids: list, flags: list, hashes: list, counts: list) -> pa.RecordBatch:
        h, n = np.concatenate(hashes), np.concatenate(counts)
        vocabulary, code, often = np.unique(h, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        flat_ids, flat_held = pa.concat_arrays(ids), np.concatenate(flags)
        one = np.array([0, len(flat_ids)], np.int32)
        return pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.ListArray.from_arrays(one, flat_ids), pa.ListArray.from_arrays(one, pa.array(flat_held)),
                                           pa.array([len(h)], pa.int64()), pa.array([len(vocabulary)], pa.int64()),
                                           pa.array([pack(vocabulary[order], place[code], n.astype(np.int64))], pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, flags, hashes, counts, total = [], [], [], [], 0
        for b in batches:
            held = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for i, j, h, n in _tokens(b.column(1)):
                ids.append(b.column(0)[i:j])
                flags.append(held[i:j])
                hashes.append(h)
                counts.append(n)
                total += len(h)
                if total >= BLOCK_TOKENS:
                    yield close(ids, flags, hashes, counts)
                    ids, flags, hashes, counts, total = [], [], [], [], 0
        if ids:
            yield close(ids, flags, hashes, counts)

    to_arrow_type(id_type)  # an id that Arrow can't hold fails here, not in a task
    found = slim.mapInArrow(run, f"part int, ids array<{id_type.simpleString()}>, held array<boolean>, tokens long, words long, body binary")
    return found.select(F.monotonically_increasing_id().alias("block"), "ids", "held", "tokens", "words", "body")


class Block:
    """One row of the blocks."""

    def __init__(self, row: dict):
        self.number, self.held = row["block"], np.array(row["held"], bool)
        self.vocabulary, code, self.counts = unpack(row["body"])
        self.code = code.astype(np.int32)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
        self.trains = np.repeat(~self.held, self.counts)

    def before(self, k: int) -> np.ndarray:
        """Index of the word k places before each token; -1 for the begin of its text."""
        out = np.full(len(self.code), -1, np.int32)
        out[k:] = self.code[: max(0, len(self.code) - k)]
        for i in range(k):
            at = self.starts + i
            out[at[at < self.ends]] = -1
        return out


def distinct(columns: list[np.ndarray], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Different rows of columns of numbers from -1 below ``size``, in order, and for each row which of them it is."""
    width = int(size + 1).bit_length()
    if width * len(columns) <= 63:
        key = np.zeros(len(columns[0]), np.int64)
        for c in columns:
            key <<= width
            key |= c.astype(np.int64) + 1
        found, inverse = np.unique(key, return_inverse=True)
        return [((found >> (width * (len(columns) - 1 - i))) & ((1 << width) - 1)) - 1 for i in range(len(columns))], inverse.astype(np.int32)
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return [c[order][new].astype(np.int64) for c in columns], inverse


def _shard(keys: list[np.ndarray], shards: int) -> np.ndarray:
    h = np.zeros(len(keys[0]), np.uint64)
    for k in keys:
        h = mixed(h ^ k)
    return (h % np.uint64(shards)).astype(np.int64)


def _dealt(kind: str, block: int, shard: np.ndarray, columns: list[np.ndarray]) -> tuple[list[tuple], np.ndarray]:
    """A message per shard with its part of the columns, and the order in which the parts were taken."""
    order = np.argsort(shard, kind="stable")
    at = np.flatnonzero(np.diff(shard[order], prepend=-1))
    ends = np.append(at[1:], len(order))
    return [(kind, int(shard[order[i]]), block, pack(*[c[order[i:j]] for c in columns])) for i, j in zip(at.tolist(), ends.tolist())], order


def _answers(table: pa.Table, kind: str, order: np.ndarray) -> list[np.ndarray]:
    """The columns that the shards gave back to a block, in the order of its questions."""
    rows = sorted((r["shard"], r["body"]) for r in table.to_pylist() if r["kind"] == kind)
    parts = [unpack(body) for _, body in rows]
    if not parts:
        return []
    out = []
    for column in zip(*parts):
        joined = np.concatenate(column)
        back = np.empty(len(order), joined.dtype)
        back[order] = joined
        out.append(back)
    return out


# -- first round: words ----------------------------------------------------------

def _word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return _shard([hashes], shards)


def _counts(n_kinds: int, which: np.ndarray, trains: np.ndarray) -> list[np.ndarray]:
    """How often each kind occurs in training texts and in all texts."""
    return [np.bincount(which[trains], minlength=n_kinds).astype(np.uint32), np.bincount(which, minlength=n_kinds).astype(np.uint32)]


def _added(kinds: int, inverse: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    out = []
    for c in columns:
        n = np.zeros(kinds, np.int64)
        np.add.at(n, inverse, c.astype(np.int64))
        out.append(n)
    return out


def _ask_words(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            block = Block(row)
            rows, _ = _dealt("words", block.number, _word_shard(block.vocabulary, shards), [block.vocabulary, *_counts(len(block.vocabulary), block.code, block.trains)])
            yield from _messages(rows).to_batches()


def _count_words(table: pa.Table, shards: int) -> pa.Table:
    """Per word its count, whether it occurs once in all texts and its number, small for frequent words; and the shard's highest counts."""
    rows = table.to_pylist()
    asked = [unpack(r["body"]) for r in rows]
    found, inverse = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
    n, every = _added(len(found), inverse, *(np.concatenate([a[i] for a in asked]) for i in (1, 2)))
    number = np.empty(len(found), np.uint64)
    number[np.argsort(-every, kind="stable")] = np.arange(len(found), dtype=np.uint64) * np.uint64(shards) + np.uint64(rows[0]["shard"])
    out, at = [], 0
    for r, a in zip(rows, asked):
        which = inverse[at: at + len(a[0])]
        out.append(("words", r["shard"], r["block"], pack(n[which], every[which] == 1, number[which])))
        at += len(a[0])
    out.append(("top", rows[0]["shard"], -1, pack(np.sort(n)[::-1][: HOT + 1].copy(), np.array([n.sum(), (n > 0).sum()], np.int64))))
    return _messages(out)


def _hot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for body in b.column(0).to_pylist():
            n, total = unpack(body)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(n, -1)), pa.array(np.append(np.zeros_like(n), total[0])),
                                              pa.array(np.append(np.zeros_like(n), total[1]))], ["n", "tokens", "kinds"])


class Words:
    """What a block knows after the first round."""

    def __init__(self, block: Block, answers: pa.Table, shards: int, level: int):
        order = np.argsort(_word_shard(block.vocabulary, shards), kind="stable")
        self.n, self.alone, number = _answers(answers, "words", order)
        names = (number + FIRST) << np.uint64(1) | (self.n > level).astype(np.uint64)
        self.names = np.append(names, [ONCE, BEGIN])  # so that index -1 is the begin mark
        self.alone = np.append(self.alone, [False, False])


# -- second round: pairs -----------------------------------------------------------

class Pairs:
    """Different pairs (b, c) of a block, the pair of each token, and the questions about them."""

    def __init__(self, block: Block, known: Words, shards: int):
        size = len(block.vocabulary)
        (self.b, self.c), self.of = distinct([block.before(1), block.code], size)
        self.trained, self.every = _counts(len(self.b), self.of, block.trains)
        self.sure = known.alone[self.b] | known.alone[self.c]  # the pair is the one occurrence of a word
        asks = np.flatnonzero(~known.alone[self.b])
        (qb, qc), ask = distinct([self.b[asks], np.where(known.alone[self.c[asks]], size, self.c[asks])], size + 1)
        self.ask = np.full(len(self.b), -1, np.int64)
        self.ask[asks] = ask
        names = [known.names[qb], known.names[qc]]
        shard = np.where(names[0] & OFTEN > 0, _shard(names, shards), _shard(names[:1], shards))
        counts = _added(len(qb), ask, self.trained[asks], self.every[asks])
        self.columns, self.shard = [*names, *(n.astype(np.uint32) for n in counts)], shard


def _ask_pairs(left: pa.Table, right: pa.Table, shards: int, level: int) -> pa.Table:
    out = []
    for row in left.to_pylist():
        block = Block(row)
        pairs = Pairs(block, Words(block, right, shards, level), shards)
        out += _dealt("pairs", block.number, pairs.shard, pairs.columns)[0]
    return _messages(out)


def _count_pairs(table: pa.Table) -> pa.Table:
    """Per pair its count and whether it occurs once, and the followers of its first word where the shard has all of them."""
    rows = table.to_pylist()
    asked = [unpack(r["body"]) for r in rows]
    b, c, m, e = (np.concatenate([a[i] for a in asked]) for i in range(4))
    ids, at = np.unique(np.concatenate((b, c)), return_inverse=True)
    (pb, pc), inverse = distinct([at[: len(b)], at[len(b):]], len(ids))
    n, every = _added(len(pb), inverse, m, e)
    followers = np.zeros(len(ids), np.int64)
    np.add.at(followers, pb, np.where(ids[pc] == ONCE, n, n > 0))
    mine = np.where(ids & OFTEN > 0, 0, followers)
    out, i = [], 0
    for r, a in zip(rows, asked):
        which = inverse[i: i + len(a[0])]
        out.append(("pairs", r["shard"], r["block"], pack(n[which], every[which] == 1, mine[pb[which]])))
        i += len(a[0])
    often = np.flatnonzero((ids & OFTEN > 0) & (followers > 0))
    out.append(("followers", rows[0]["shard"], -1, pack(ids[often], followers[often])))
    return _messages(out)


def _follower_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for body in b.column(0).to_pylist():
            name, n = unpack(body)
            yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(n)], ["name", "n"])


# -- third round: trigrams -----------------------------------------------------------

@dataclass
class Corpus:
    """Totals, and the followers of at most ``HOT`` names."""
    shards: int
    level: int  # words of a higher count are frequent
    train_docs: int = 0
    train_tokens: int = 0
    kinds: int = 0
    followers: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.uint64), np.zeros(0, np.int64))


class Trigrams:
    """What a block knows after two rounds, and its questions about trigrams."""

    def __init__(self, block: Block, answers: pa.Table, corpus: Corpus):
        self.words = known = Words(block, answers, corpus.shards, corpus.level)
        self.pairs = pairs = Pairs(block, known, corpus.shards)
        n, alone, follows = _answers(answers, "pairs", np.argsort(pairs.shard, kind="stable")) or (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        asked = pairs.ask >= 0
        self.n_pair = np.where(pairs.sure | ~asked, pairs.trained, n[pairs.ask] if len(n) else 0).astype(np.int64)
        self.once = pairs.sure | (asked & (alone[pairs.ask] if len(n) else False))
        b_name = known.names[pairs.b]
        followers = np.where(asked, follows[pairs.ask] if len(n) else 0, pairs.trained).astype(np.int64)
        often = np.flatnonzero(asked & (b_name & OFTEN > 0))
        name, count = corpus.followers
        if len(name):
            at = np.minimum(np.searchsorted(name, b_name[often]), len(name) - 1)
            followers[often] = np.where(name[at] == b_name[often], count[at], 0)
        n_word = np.append(known.n, [0, corpus.train_docs])  # the begin mark occurs once a text
        self.p1 = (known.n + 1.0) / (corpus.train_tokens + corpus.kinds + 1.0)
        context = n_word[pairs.b].astype(np.float64)
        self.p2 = np.where(context > 0, (np.maximum(self.n_pair - DISCOUNT, 0) + DISCOUNT * followers * self.p1[pairs.c]) / np.maximum(context, 1), self.p1[pairs.c])
        # tokens behind a first one, the pair (a, b) before each, and those whose context also occurs elsewhere
        later = np.ones(len(block.code), bool)
        later[block.starts] = False
        self.later = np.flatnonzero(later)
        self.context = pairs.of[self.later - 1]
        self.open = np.flatnonzero(~self.once[self.context] & (self.n_pair[self.context] > 0))
        at = self.later[self.open]
        size = len(block.vocabulary)
        c = np.where(self.once[pairs.of[at]], size, block.code[at])
        (b, a, c), self.ask = distinct([block.before(1)[at], block.before(2)[at], c], size + 1)
        names = [known.names[b], known.names[a], known.names[c]]
        total = np.zeros(len(b), np.int64)
        total[self.ask] = self.n_pair[self.context[self.open]]
        heavy = total >= HEAVY
        self.shard = np.where(heavy, _shard(names, corpus.shards), _shard(names[:2], corpus.shards))
        n = np.bincount(self.ask[block.trains[at]], minlength=len(b))
        self.columns = [*names, n.astype(np.uint32), np.where(heavy, total, 0)]


def _ask_trigrams(left: pa.Table, right: pa.Table, corpus: Corpus) -> pa.Table:
    out = []
    for row in left.to_pylist():
        block = Block(row)
        asks = Trigrams(block, right, corpus)
        out += _dealt("trigrams", block.number, asks.shard, asks.columns)[0]
    return _messages(out)


def _score_trigrams(table: pa.Table) -> pa.Table:
    """The trie of a shard's training trigrams, and from it the codes of each trigram asked for."""
    rows = table.to_pylist()
    asked = [unpack(r["body"]) for r in rows]
    b, a, c, m, total = (np.concatenate([x[i] for x in asked]) for i in range(5))
    sizes = [len(x[0]) for x in asked]
    rows = [(r["shard"], r["block"]) for r in rows]
    del asked
    ids, at = np.unique(np.concatenate((b, a, c)), return_inverse=True)
    k = len(b)
    del a, b, c
    (qb, qa, qc), inverse = distinct([at[:k], at[k: 2 * k], at[2 * k:]], len(ids))
    del at
    (n,) = _added(len(qb), inverse, m)
    given = np.empty(len(qb), np.int64)
    given[inverse] = total
    tb, ta, tc, tn, heavy = (x[n > 0] for x in (qb, qa, qc, n, given))
    new = np.ones(len(tb), bool)
    new[1:] = (tb[1:] != tb[:-1]) | (ta[1:] != ta[:-1])
    first = np.flatnonzero(new)
    if len(first):
        single = ids[tc] == ONCE  # stands for as many followers as it counts
        size, occurs = (np.add.reduceat(x, first).astype(np.float64) for x in (np.where(single, tn, 1), tn))
        of = np.cumsum(new) - 1
        many = heavy[first] > 0
        occurs = np.where(many, heavy[first], occurs)
        share = np.where(many, MASS / (occurs + MASS), DISCOUNT * size / occurs)
        each = np.where(single, 1, tn)
        own = np.where(many[of], each / (occurs[of] + MASS), (each - DISCOUNT) / occurs[of])
        prob, backoff = quantised(np.log10(own)), quantised(np.log10(share))
    else:
        prob = backoff = np.zeros(0, np.uint16)
    seen = np.unique(np.concatenate((tb, ta, tc)))
    dense = np.searchsorted(seen, np.concatenate((ta, tb, tc))).reshape(3, -1)
    trie = Trie.mapped(Trie.build(ids[seen], *dense, backoff, prob))
    own, share = trie.lookup(ids, qa, qb, qc)
    out, i = [], 0
    for (shard, block), k in zip(rows, sizes):
        which = inverse[i: i + k]
        out.append(("codes", shard, block, pack(own[which], share[which])))
        i += k
    return _messages(out)


def _final(block: Block, ids: pa.Array, answers: pa.Table, corpus: Corpus) -> pa.Table:
    known = Trigrams(block, answers, corpus)
    log1 = np.log10(known.p1)
    base = np.add.reduceat(log1[block.code], block.starts)
    n_known = np.add.reduceat((known.words.n > 0).astype(np.int64)[block.code], block.starts)
    # a context that occurs once has one follower, here, in a text that is learned from; one that doesn't occur leaves all to P2
    seen = known.n_pair[known.context] > 0
    own, share = np.where(seen, 1 - DISCOUNT, 0.0), np.where(seen, DISCOUNT, 1.0)
    if len(known.open):
        code, weight = _answers(answers, "codes", np.argsort(known.shard, kind="stable"))
        code, weight, at = code[known.ask], weight[known.ask], known.later[known.open]
        absent = (code == NONE) | (known.once[known.pairs.of[at]] & ~block.trains[at])
        own[known.open] = np.where(absent, 0.0, 10.0 ** value_of(code))
        share[known.open] = 10.0 ** value_of(weight)
    per = known.p2[known.pairs.of]
    per[known.later] = own + share * per[known.later]
    per = np.log10(per)
    score = np.add.reduceat(per, block.starts)
    return pa.table([ids, pa.array(block.held), pa.array(block.counts), pa.array(n_known), pa.array(np.full(len(base), corpus.train_tokens, np.int64)), pa.array(base), pa.array(score)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


# -- all rounds ----------------------------------------------------------------------

def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's probability).

    Learned from all texts whose id's crc32 modulo ``folds`` isn't ``held``; rows without an id are learned from. A null or
    empty text is its end mark. Equal texts have equal scores, repeated rows each count, other columns aren't read, and an
    empty table gives no rows. Scores are within some 3e-4 a token of the formulas, by the 16-bit codes. Words are told apart by
    63 bits of a hash.
    """
    spark = docs.sparkSession
    # what a finished round has shuffled isn't read again: rounds are cut by written tables
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        return _rounds(docs, doc_id, text, folds, held)
    finally:
        spark.conf.set(setting, was)


def _rounds(docs: DataFrame, doc_id: str, text: str, folds: int, held: int) -> DataFrame:
    spark = docs.sparkSession
    blocks, blocks_path = stage_at(make_blocks(docs, doc_id, text, folds, held), "blocks")
    size = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0))).first()
    shards, train_docs = max(LEAST_SHARDS, -(-size[0] // SHARD_TOKENS)), size[1]

    asked = blocks.mapInArrow(lambda batches: _ask_words(batches, shards), MESSAGE)
    by_word, word_path = stage_at(asked.groupBy("shard").applyInArrow(lambda t: _count_words(t, shards), MESSAGE), "words")
    top = by_word.filter("kind = 'top'").select("body").mapInArrow(_hot_rows, "n long, tokens long, kinds long")
    total = top.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    highest = [r[0] for r in top.orderBy(F.desc("n")).limit(HOT + 1).select("n").collect()]
    corpus = Corpus(shards, max(highest[-1], 0) if len(highest) > HOT else 0, train_docs, *total)
    slim = blocks.select("block", "held", "body").groupBy("block")
    asked = slim.cogroup(by_word.filter("kind = 'words'").groupBy("block")).applyInArrow(lambda x, y: _ask_pairs(x, y, shards, corpus.level), MESSAGE)
    by_pair, pair_path = stage_at(asked.groupBy("shard").applyInArrow(_count_pairs, MESSAGE), "pairs")
    follows = by_pair.filter("kind = 'followers'").select("body").mapInArrow(_follower_rows, "name long, n long").groupBy("name").agg(F.sum("n"))
    named_counts = np.array([tuple(r) for r in follows.collect()], np.int64).reshape(-1, 2)  # at most HOT names and the begin mark
    named_counts = named_counts[np.argsort(named_counts[:, 0])]
    corpus.followers = (named_counts[:, 0].view(np.uint64).copy(), named_counts[:, 1].copy())

    answers = by_word.filter("kind = 'words'").unionByName(by_pair.filter("kind = 'pairs'"))
    asked, ask_path = stage_at(slim.cogroup(answers.groupBy("block")).applyInArrow(lambda x, y: _ask_trigrams(x, y, corpus), MESSAGE), "asks")
    by_trigram, trigram_path = stage_at(asked.groupBy("shard").applyInArrow(_score_trigrams, MESSAGE), "trigrams")
    drop(spark, ask_path)

    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    result = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def final(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [_final(Block({"block": left["block"][i].as_py(), "held": left["held"][i].as_py(), "body": left["body"][i].as_py()}), left["ids"][i].values, right, corpus)
                 for i in range(left.num_rows)]
        return pa.concat_tables(parts)

    done, _ = stage_at(blocks.select("block", "ids", "held", "body").groupBy("block").cogroup(answers.unionByName(by_trigram).groupBy("block")).applyInArrow(final, result), "scores")
    drop(spark, word_path, pair_path, trigram_path, blocks_path)
    return done
