"""Trigram scores against the formulas in plain Python, and the trie against dictionaries."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import scoring
from tidewatch.llm.queries import QUERIES
from tidewatch.llm.trie import NONE, STEP, Monotone, Trie, quantised, value_of


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def brute(rows, heavy=1 << 20):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) by the formulas."""
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    cut = [tokens(t) for _, t in rows]
    train = [w for w, h in zip(cut, held) if not h]
    one = Counter(x for w in train for x in w)
    two = Counter(p for w in train for p in zip(["<", *w], w))
    three = Counter(p for w in train for p in zip(["<", *w], w, w[1:]))
    begins = len(train)
    n, v = sum(one.values()), len(one)
    after = Counter(b for b, _ in two)
    after2 = Counter((a, b) for a, b, _ in three)
    disc = scoring.DISCOUNT

    def p1(c):
        return (one[c] + 1) / (n + v + 1)

    def p2(b, c):
        total = begins if b == "<" else one[b]
        return (max(two[b, c] - disc, 0) + disc * after[b] * p1(c)) / total if total else p1(c)

    def p3(a, b, c):
        total = two[a, b]
        if not total:
            return p2(b, c)
        if total >= heavy:
            return (three[a, b, c] + scoring.MASS * p2(b, c)) / (total + scoring.MASS)
        return (max(three[a, b, c] - disc, 0) + disc * after2[a, b] * p2(b, c)) / total

    out = []
    for (d, _), w, h in zip(rows, cut, held):
        s = math.log10(p2("<", w[0])) + sum(math.log10(p3(a, b, c)) for a, b, c in zip(["<", *w], w, w[1:]))
        out.append((d, h, len(w), sum(one[x] > 0 for x in w), n, sum(math.log10(p1(x)) for x in w), s))
    return out


def same(got, want):
    got = sorted((tuple(r) for r in got), key=lambda r: (str(r[0]), r[2:]))
    want = sorted(want, key=lambda r: (str(r[0]), r[2:]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and abs(g[6] - w[6]) <= 1.6 * STEP * w[2] + 1e-9


def some_rows():
    rnd = random.Random(4)
    word = lambda: f"W{int(rnd.paretovariate(0.6)) % 400}"
    rows = [(None, "no id here"), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (5, "two words"), (6, "é ü É x"), (7, "a b " * 900), (8, "A B " * 900)]
    rows += [(100 + i, " ".join(word() for _ in range(rnd.randrange(40)))) for i in range(150)]
    rows += [(400 + i, "the very same passage of a text that very many share " + word()) for i in range(80)]
    return rows


@pytest.mark.parametrize("hot,heavy,block", [(65_536, 1 << 20, 1 << 21), (6, 40, 300), (0, 10, 50)])
def test_scores_against_the_formulas(docs_of, monkeypatch, hot, heavy, block):
    """Names, dealing and blocks of any size give the same counts."""
    monkeypatch.setattr(scoring, "HOT", hot)
    monkeypatch.setattr(scoring, "HEAVY", heavy)
    monkeypatch.setattr(scoring, "BLOCK_TOKENS", block)
    monkeypatch.setattr(scoring, "LEAST_SHARDS", 5)
    rows = some_rows()
    same(scoring.score(docs_of(rows).repartition(3)).collect(), brute(rows, heavy))


def test_scores_of_little(docs_of):
    assert scoring.score(docs_of([])).count() == 0
    alone = [(i, "x y") for i in range(30) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    same(scoring.score(docs_of(alone)).collect(), brute(alone))  # nothing to learn from
    same(scoring.score(docs_of([(1, None)])).collect(), brute([(1, None)]))


def test_query_against_the_formulas(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op13_lm_scores"](spark, sf).collect()
    same(got, brute(rows))
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("top", [0, 5, 1000, 2**40, 2**63])
def test_monotone_sequences(top):
    rnd = random.Random(top)
    for n in (0, 1, 2, 63, 64, 65, 3000):
        values = np.array(sorted(rnd.randint(0, top) for _ in range(n)), np.uint64)
        m = Monotone.of(values)
        assert (m[np.arange(n)] == values).all()
        asks = np.array([*values[:200].tolist(), *[rnd.randint(0, top) for _ in range(200)], 0, top], np.uint64)
        _, found = m.successor(asks)
        assert found.tolist() == [x in set(values.tolist()) for x in asks.tolist()]


def test_trie_against_a_dictionary(tmp_path):
    rnd = random.Random(9)
    words = np.array(sorted(rnd.sample(range(1 << 50), 60)), np.uint64)
    grams = sorted({tuple(int(rnd.paretovariate(0.5)) % 50 for _ in range(3)) for _ in range(2000)})  # (b, a, c)
    b, a, c = (np.array(x) for x in zip(*grams))
    contexts = sorted({g[:2] for g in grams})
    prob, back = quantised(-np.random.default_rng(1).random(len(grams)) * 5), quantised(-np.random.default_rng(2).random(len(contexts)))
    path = tmp_path / "grams"
    path.write_bytes(Trie.build(words, a, b, c, back, prob))
    p, k = dict(zip(grams, prob.tolist())), dict(zip(contexts, back.tolist()))
    asked = sorted({*grams, *[tuple(rnd.randrange(70) for _ in range(3)) for _ in range(3000)]})
    more = np.array(sorted([*words.tolist(), *rnd.sample(range(1 << 50, 1 << 51), 10)]), np.uint64)
    qb, qa, qc = (np.array(x) for x in zip(*asked))
    for trie in (Trie.open(path), Trie.mapped(path.read_bytes())):
        own, share = trie.lookup(more, qa, qb, qc)
        assert own.tolist() == [p.get(g, NONE) for g in asked] and share.tolist() == [k.get(g[:2], 0) for g in asked]
    assert abs(value_of(quantised(np.array([-1.5])))[0] + 1.5) <= STEP / 2
