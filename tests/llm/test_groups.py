"""Exact and near duplicates against brute force."""

import hashlib
import random
import re

import pytest
import xxhash

from tidewatch.llm import exact, simhash
from tidewatch.llm.components import components

TEXTS = [(1, "a b c"), (2, "a b c"), (3, None), (4, ""), (5, "x"), (5, "x"), (None, "a b c"), (None, "alone"), (7, "y " * 30000), (8, "y " * 30000), (9, "A b c")]


def brute_exact(rows):
    out = []
    for d, t in rows:
        same = [e for e, u in rows if (u or "") == (t or "")]
        keep = max((e for e in same if e is not None), default=None)
        out.append((d, keep, len(same), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_groups(docs_of):
    got = sorted((tuple(r) for r in exact.exact_groups(docs_of(TEXTS)).collect()), key=str)
    assert got == brute_exact(TEXTS)
    assert exact.exact_groups(docs_of([])).count() == 0


def test_exact_groups_with_a_full_filter(docs_of, monkeypatch):
    monkeypatch.setattr(exact, "size_for", lambda n: 1 << 16)
    rows = [(i, f"t{i % 900}") for i in range(1000)] + [(5000 + i, f"u{i}") for i in range(30000)]
    got = sorted(exact.exact_groups(docs_of(rows)).filter("group_size > 1 or not kept").select("doc_id", "keep_id").collect())
    assert [tuple(r) for r in got] == sorted([(i, i + 900) for i in range(100)] + [(i + 900, i + 900) for i in range(100)])


def test_exact_dedup_keeps_one_row_of_each_text(docs_of):
    docs = docs_of(TEXTS)
    kept = exact.exact_dedup(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted((r.doc_id, r.text) for r in rows if r.doc_id) == [(2, "a b c"), (4, ""), (5, "x"), (8, "y " * 30000), (9, "A b c")]
    assert [r.text for r in rows if r.doc_id is None] == ["alone"]


def fingerprint(text, n=3):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    s = [" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))]
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_near(rows, t=2):
    fp = [fingerprint(x) for _, x in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= t:
                a, b = comp[i], comp[j]
                comp = [b if c == a else c for c in comp]
    low = {c: min((rows[i][0] for i in range(len(rows)) if comp[i] == c and rows[i][0] is not None), default=None) for c in comp}
    return sorted(((rows[i][0], f"{fp[i]:016x}", low[comp[i]]) for i in range(len(rows))), key=str)


def near_rows():
    rnd = random.Random(5)
    rows = [(None, "no id here"), (50, None), (51, ""), (52, " \t\n"), (53, "ONE"), (54, "one"), (55, "two words"), (56, "é ü x y z"), (57, "É ü x"), (57, "É ü x")]
    base = [f"w{rnd.randrange(500)}" for _ in range(400)]
    for i in range(60):
        w = list(base)
        for _ in range(rnd.randrange(3)):
            w[rnd.randrange(len(w))] = "zz"
        rows.append((100 + i, " ".join(w)))
    return rows


@pytest.mark.parametrize("crowd", [512, 3])
def test_near_groups(docs_of, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rows = near_rows()
    got = sorted((tuple(r) for r in simhash.near_groups(docs_of(rows)).collect()), key=str)
    assert got == brute_near(rows)


def test_near_groups_on_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in simhash.near_groups(docs).collect()), key=str) == brute_near(rows)


def test_near_groups_of_nothing(docs_of):
    assert simhash.near_groups(docs_of([])).count() == 0
    assert simhash.near_dedup(docs_of([])).count() == 0


def test_near_dedup_keeps_the_smallest_id(docs_of):
    rows = near_rows()
    docs = docs_of(rows)
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in brute_near(rows) if c is not None}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(want)


def test_links_on_random_bits(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 8)
    rnd = random.Random(1)
    fps = set()
    for _ in range(40):
        x = rnd.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            for _ in range(rnd.randrange(1, 4)):
                x ^= 1 << rnd.randrange(64)
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    root = {r.node: r.root for r in components(simhash.link(df)).collect()}
    comp = {x: x for x in fps}
    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 2 and comp[x] != comp[y]:
                a, b = comp[x], comp[y]
                comp = {k: b if v == a else v for k, v in comp.items()}
    groups = lambda f: sorted(sorted(k for k in fps if f(k) == v) for v in {f(k) for k in fps})
    assert groups(lambda x: root.get(simhash._signed(x), simhash._signed(x))) == groups(comp.get)


@pytest.mark.parametrize("t", [1, 3])
def test_links_at_other_distances(spark, monkeypatch, t):
    monkeypatch.setattr(simhash, "CROWD", 4)
    rnd = random.Random(t)
    fps = {0, 2**64 - 1}
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(9):
            fps.add(x)
            for _ in range(rnd.randrange(1, t + 2)):
                x ^= 1 << rnd.randrange(64)
    fps |= {x ^ (1 << 5) ^ (1 << 9) for x in list(fps)[:20]} | set(range(16))
    fps = sorted(fps)
    root = {r.node: r.root for r in components(simhash.link(spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long"), t)).collect()}
    want = brute_components(fps, t)
    for i, x in enumerate(fps):
        for y in fps[:i]:
            same = root.get(simhash._signed(x), simhash._signed(x)) == root.get(simhash._signed(y), simhash._signed(y))
            assert same == (want[x] == want[y])


def brute_components(fps, t):
    comp = {x: x for x in fps}
    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= t and comp[x] != comp[y]:
                a, b = comp[x], comp[y]
                comp = {k: b if v == a else v for k, v in comp.items()}
    return comp


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 120)] + [(500, 400), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(121)} | {500: 400, 400: 400}


def test_columns_of_any_kind_pass_through(spark):
    from tidewatch.llm import decontaminate
    rows = [(1, "a b c d e", {"x": 1}, [1.5]), (1, "a b c d e", {"x": 2}, None), (2, "a b c d e", None, []), (3, "q r s t", {}, [2.0]), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _h map<string,int>, id array<double>")
    assert sorted(r.doc_id or 0 for r in exact.exact_dedup(docs).collect()) == [0, 2, 3]
    kept = simhash.near_dedup(docs).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 3] and [r["_h"] for r in kept if r.doc_id == 1] == [{"x": 2}]
    items = spark.createDataFrame([("k", "a b c d e")], "item_id string, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, items).collect()} == {(1, "k"), (2, "k")}
    assert sorted(r.doc_id or 0 for r in decontaminate.keep_clean(docs, items).collect()) == [0, 3]
