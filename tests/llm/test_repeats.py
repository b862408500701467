"""Repeated substrings against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from tidewatch.llm import repeats


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, long_shared = text(12), text(60)
    rows = [(None, "x" * 30), (None, None), (1, ""), (2, "ab" * 100), (3, "short"), (4, shared), (4, shared), (5, "q" * 400)]
    for i in range(40):
        parts = [text(rnd.randrange(3, 30)) for _ in range(3)]
        if i % 2:
            parts.insert(rnd.randrange(4), shared)
        if i % 5 == 0:
            parts.insert(rnd.randrange(4), long_shared[rnd.randrange(60):])
        if i % 7 == 0:
            parts.append(parts[0])
        rows.append((10 + i, " ".join(parts)))
    base = text(50).split(" ")
    for i in range(30):
        w = list(base)
        w[rnd.randrange(50)] = word()
        rows.append((100 + i, " ".join(w)))
    return rows


@pytest.mark.parametrize(("crowd", "piece"), [(4096, 1 << 19), (3, 64), (4096, 64)])
def test_against_brute_force(docs_of, monkeypatch, crowd, piece):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    monkeypatch.setattr(repeats, "INDEX_BYTES", piece)
    rows = corpus()
    got = repeats.dedup(docs_of(rows), length=32, gram=8)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 32)


def test_long_texts_in_parts(docs_of, monkeypatch):
    monkeypatch.setattr(repeats, "LONG", 50)
    monkeypatch.setattr(repeats, "pieces", lambda c: __import__("tidewatch.llm.flat", fromlist=["pieces"]).pieces(c, 1))
    rows = corpus()
    got = repeats.dedup(docs_of(rows), length=32, gram=8)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 32)


def test_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted((tuple(r) for r in repeats.dedup(docs).collect()), key=str) == brute([(r.doc_id, r.text) for r in docs.collect()], 400)


def test_kept_bytes_and_no_rows(docs_of):
    assert repeats.dedup(docs_of([])).count() == 0
    rows = [(1, "a" * 10 + "X" * 20), (2, "b" * 9), (3, None)]
    got = {r.doc_id: bytes(r.kept) for r in repeats.dedup(docs_of(rows), length=16, gram=4, keep_text=True).collect()}
    assert got == {1: b"a" * 10, 2: b"b" * 9, 3: b""}


def test_long_matches_of_parts():
    rnd = random.Random(2)
    for _ in range(30):
        parts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(1, 40))) for _ in range(rnd.randrange(1, 6))]
        part, a, e = repeats.long_matches(parts, 6)
        seen = Counter(p[i:i + 6] for p in parts for i in range(len(p) - 5))
        want = set()
        for k, p in enumerate(parts):
            for i in range(len(p) - 5):
                if seen[p[i:i + 6]] > 1:
                    want |= {(k, j) for j in range(i, i + 6)}
        assert {(k, j) for k, s, t in zip(part, a, e) for j in range(s, t)} == want
