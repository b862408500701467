"""Learned operators: held-out accuracy, and their parts against brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import labels as lab
from tidewatch.llm import language, quality, toxic
from tidewatch.llm.flat import flat, pieces, words
from tidewatch.llm.queries import QUERIES

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "!!! 123"), (None, "the cat"), (5, "word " * 40000), (6, "ÀÉ ß 漢字"), (6, "ÀÉ ß 漢字")]


def held(doc_id, folds, r):
    return zlib.crc32(str(doc_id).encode()) % folds == r


@pytest.fixture(scope="module")
def truth(spark, ):
    d = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    return d, labels, {r.doc_id: r for r in spark.read.parquet(f"{d}/documents.parquet").collect()}


def test_flat_keeps_slices_and_nulls():
    a = pa.array(["x", None, "é y", ""]).slice(1)
    data, bounds = flat(a)
    assert data.tobytes() == "é y".encode() and bounds.tolist() == [0, 0, 4, 4]
    inside = np.ones(256, bool)
    inside[32] = False
    starts, ends, own = words(data, bounds, inside)
    assert (starts.tolist(), ends.tolist(), own.tolist()) == ([0, 3], [2, 4], [0, 0, 2, 2])
    assert [(i, j) for i, j, *_ in pieces(pa.array(["aaaa", "b", "c" * 9, "d"]), 5)] == [(0, 2), (2, 3), (3, 4)]
    data, bounds = flat(pa.array(["ab", "cd"]))
    assert words(data, bounds, np.ones(256, bool))[0].tolist() == [0, 2]  # texts that touch


def brute_segments(score):
    """Maximal segments by their definition: the best segment first, then the same left and right of it."""
    if not len(score):
        return []
    run = np.concatenate(([0], np.cumsum(score)))
    pairs = [(run[j] - run[i], -(j - i), i, j) for i in range(len(score)) for j in range(i + 1, len(score) + 1)]
    top, _, i, j = max(pairs)
    if top <= 0:
        return []
    return [*brute_segments(score[:i]), (i, j, top), *[(a + j, b + j, s) for a, b, s in brute_segments(score[j:])]]


def test_segments_are_all_maximal_ones():
    rnd = random.Random(4)
    for _ in range(200):
        score = np.array([rnd.choice([-3.0, -2.0, -1.0, 1.0, 2.5, 4.0]) + rnd.random() / 100 for _ in range(rnd.randrange(1, 30))])
        got = toxic.text_segments(score)
        want = brute_segments(score)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_toxic_words_are_found(spark, docs_of):
    rnd = random.Random(8)
    rows, marks = [], []
    for i in range(1500):
        w = [f"{rnd.choice('bcdfg')}{rnd.choice('aeiou')}{rnd.randrange(60)}" for _ in range(rnd.randrange(5, 120))]
        bad = i % 8 == 0
        for _ in range(3 * bad):
            w.insert(rnd.randrange(len(w)), rnd.choice(["vile", "nasty", f"zork{rnd.randrange(500)}"]))
        rows.append((i, " ".join(w)))
        marks.append((i, int(bad)))
    labels = spark.createDataFrame(marks + [(3, None), (9999, 1)], "doc_id long, toxic int")
    docs = docs_of(rows + [(-1, None), (-2, ""), (None, "vile")])
    model = toxic.learn(docs, labels)
    got = {r.doc_id: r for r in toxic.score(docs, model).collect()}
    assert len(got) == len(rows) + 3 and all(0 <= r.score <= 1 for r in got.values())
    out = [(got[i].predicted, y) for i, y in marks if held(i, 5, 0)]
    assert sum(p == y for p, y in out) / len(out) > 0.97
    assert got[-1].predicted == got[-2].predicted == 0
    clean = toxic.keep_clean(docs, model)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, r in got.items() if not r.predicted}
    spots = toxic.passages(docs, model).collect()
    texts = dict(rows)
    tell = [r for r in spots if r.doc_id is not None]
    assert tell and np.mean([any(w in ("vile", "nasty") or w.startswith("zork") for w in texts[r.doc_id].split()[r.first:r.end]) for r in tell]) > 0.9


def test_labels_of_the_held_out_fold_are_not_seen(spark, docs_of):
    rows = [(i, f"{'bad' if i % 2 else 'good'} w{i % 7}") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    train = lab.training_rows(docs_of(rows), labels, "toxic", 5, 0)
    assert not [r for r in train.collect() if held(r.doc_id, 5, 0)]
    assert lab.training_rows(docs_of(rows), labels, "toxic", 5, 0, most=20).count() <= 40


@pytest.mark.parametrize(("name", "label", "least"), [("op2_toxicity", "toxic", 0.85), ("op3_quality", "quality", 0.97)])
def test_queries_against_held_out_labels(spark, truth, name, label, least):
    d, labels, docs = truth
    rows = QUERIES[name](spark, d).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1 for r in rows)
    out = [(r.predicted, labels[r.doc_id][label]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in out) / len(out) >= least


def test_toxic_documents_of_the_held_out_fold_are_found(spark):
    """Where there are enough toxic texts to learn from: a constant answer finds none of them, or accuses all."""
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    out = [(r.predicted, labels[r.doc_id]) for r in QUERIES["op2_toxicity"](spark, d).filter("held_out").select("doc_id", "predicted").collect() if r.doc_id in labels]
    hits, toxic, called = sum(p and y for p, y in out), sum(y for _, y in out), sum(p for p, _ in out)
    assert toxic > 50 and hits / toxic >= 0.65 and hits / called >= 0.9


def test_language_query(spark, truth):
    d, _, docs = truth
    rows = language_rows = QUERIES["op7_language_id"](spark, d).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    out = [(r.lang_pred, docs[r.doc_id].lang) for r in language_rows if r.held_out]
    assert all(r.held_out == held(r.doc_id, 3, 1) for r in rows)
    assert sum(p == y for p, y in out) / len(out) >= 0.98


def test_language_against_brute_force(spark, docs_of):
    rows = [(i, t) for i, t in enumerate(["ab ba", "abba", "xyz", "zyx x", "é à", ""] * 4)]
    docs = docs_of(rows).selectExpr("doc_id", "text", "if(text rlike 'a|b', 'one', if(text rlike 'x', 'two', null)) lang")
    model = language.learn(docs)
    assert model.langs == ["one", "two"]
    for text in ("ab", "zx", "qq é"):
        want = model.log_prior.copy()
        for n in (1, 2, 3):
            for i in range(len(text) - n + 1):
                (b, _), = [x for k, x in enumerate(language._grams(*flat(pa.array([text[i:i + n]])), model.buckets)) if k == n - 1]
                want = want + model.log_p[b[0]]
        got = language.predict(docs_of([(1, text)]), model).first()
        p = np.exp(want - want.max())
        assert got.lang_pred == model.langs[int(want.argmax())] and abs(got.score - p.max() / p.sum()) < 1e-5


def test_odd_texts(spark, docs_of):
    docs = docs_of(ODD)
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    for got in (toxic.score(docs, toxic.learn(docs, none)), quality.score(docs, quality.learn(docs, none))):
        rows = got.collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    model = language.learn(docs_of([*ODD, *[(i, "some words") for i in range(20, 30)]]))
    rows = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    assert rows == {1: "und", 2: "und", 3: "und", 4: "und", None: "en", 5: "en", 6: "en"}
    empty = docs_of([])
    assert language.predict(docs, language.learn(empty)).filter("lang_pred != 'und'").count() == 0
    assert toxic.score(empty, toxic.learn(empty, none)).count() == quality.score(empty, quality.learn(empty, none)).count() == 0


def test_statistics_of_single_texts_and_batches_agree():
    texts = [t or "" for _, t in ODD] + ["a a b\nc. d!", "A!! B!!", "x"]
    together = quality.statistics(*flat(pa.array(texts)))
    alone = np.concatenate([quality.statistics(*flat(pa.array([t]))) for t in texts])
    assert np.allclose(together, alone)
    row = dict(zip(quality.NAMES, quality.statistics(*flat(pa.array(["a a b a a"])))[0]))
    assert row["distinct_words"] == 2 / 5 and row["repeated_words"] == 2 / 5 and row["repeated_pairs"] == 1 - 3 / 4


def test_trees_against_a_walk_of_single_rows():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(3000, 4))
    y = ((x[:, 0] * x[:, 1] > 0) & (x[:, 2] < 1)).astype(float)
    model = quality.grow(x, y)
    p = quality.probability(model, x)
    assert ((p >= 0.5) == y).mean() > 0.97
    for i in range(20):
        z = model.base
        for node in model.roots:
            while model.statistic[node] >= 0:
                node = (model.left if x[i, model.statistic[node]] <= model.threshold[node] else model.right)[node]
            z += model.value[node]
        assert abs(1 / (1 + np.exp(-z)) - p[i]) < 1e-9
