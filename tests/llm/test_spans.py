"""Sentence spans against SQL, and benchmark leaks against brute-force alignment."""

import random
import re

import numpy as np
from oracle import compare, connect

from tidewatch.llm import decontaminate, sentences
from tidewatch.llm.queries import QUERIES, SQL


def test_sentence_query_matches_sql(spark, sf):
    assert compare(spark, connect(sf), QUERIES["op8_substring_dedup"], SQL["op8_substring_dedup"], sf)[0] == "ok"


def brute(rows, least=10, alone=20):
    cut = [re.findall(sentences.SENTENCE, t or "") for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    first, gone = {}, {}
    runs = []
    for i in order:
        plain = [re.sub(r"\s+", " ", s.strip(" ").lower()) for s in cut[i]]
        for a in range(len(plain)):
            ends = [e for e in range(a + 2, len(plain) + 1) if len(" ".join(plain[a:e]).split()) >= least][:1]
            if len(plain[a].split()) >= (alone if len(plain) > 1 else least):
                ends.append(a + 1)
            runs += [((e - a, " ".join(plain[a:e])), (rows[i][0] is None, rows[i][0] or 0, a), i) for e in ends]
    for run, where, _ in runs:
        first[run] = min(first.get(run, where), where)
    for run, where, i in runs:
        if where > first[run]:
            gone.setdefault(rows[i], set()).update(range(where[2], where[2] + run[0]))
    out = []
    for (d, t), s in zip(rows, cut):
        g = {x for x in gone.get((d, t), ()) if x < len(s)}
        out.append((d, len(s), len(g), sum(x - 1 not in g for x in g), "".join(x for k, x in enumerate(s) if k not in g)))
    return sorted(out, key=str)


def test_sentences_against_brute_force(docs_of):
    rnd = random.Random(6)
    sentence = lambda: " ".join(f"w{rnd.randrange(900)}" for _ in range(rnd.randrange(1, 12))) + rnd.choice([". ", "! ", "?! ", "\n", ".\n\n"])
    pool = [sentence() for _ in range(30)]
    rows = [(None, "x. y"), (1, None), (2, ""), (3, "..."), (4, " \n a"), (5, "one " * 30 + ". " + "two " * 30), (6, "ONE " * 30 + ".   " + "two " * 29 + "two"),
            (7, "same words here for ever and ever and ever again. " * 5), (8, "a b c d e f g h i j"), (9, "a b c d e f g h i j")]
    for i in range(60):
        k = rnd.randrange(25)
        rows.append((10 + i, "".join([sentence() for _ in range(rnd.randrange(4))] + pool[k:k + rnd.randrange(5)] + [sentence() for _ in range(rnd.randrange(4))])))
    rows.append((None, rows[-1][1]))
    got = sorted((tuple(r) for r in sentences.dedup(docs_of(rows)).collect()), key=str)
    assert got == brute(rows)
    assert sentences.dedup(docs_of([])).count() == 0


def test_lists_of_words_and_long_sentences_alone(docs_of):
    lines = "".join(f"item{k}\n" for k in range(60))
    long = " ".join(f"w{k}" for k in range(60)) + ". "
    rows = [(1, "One head.\n" + lines + "a tail"), (2, lines), (3, "other. " + long + "mine."), (4, "another. " + long + "yours."),
            (5, "item3\nitem4\nitem5\nitem6\n"), (6, "  \n" + lines), (7, " ".join(f"w{k}" for k in range(12))), (8, " ".join(f"W{k}" for k in range(12)))]
    got = sorted(tuple(r) for r in sentences.dedup(docs_of(rows)).collect())
    assert got == brute(rows)
    assert [(r[0], r[2]) for r in got] == [(1, 0), (2, 60), (3, 0), (4, 1), (5, 0), (6, 60), (7, 0), (8, 1)]
    assert got[3][4] == "another. yours."


def test_texts_of_one_id_lose_only_their_own_repeats(docs_of):
    passage = "this passage of six words more. occurs in two of the texts. "
    for key in (None, 7):
        rows = [(1, passage), (key, "first unique. second unique. " + passage), (key, "a one. b two. c three. d four. e five."), (key, None), (key, "")]
        got = sorted((r.n_removed, r.text) for r in sentences.dedup(docs_of(rows)).collect())
        assert got == sorted([(0, passage), (2, "first unique. second unique. "), (0, rows[2][1]), (0, ""), (0, "")])
        # at the same position, too, one stays
        got = sorted(r.n_removed for r in sentences.dedup(docs_of([(key, passage + "x."), (key, passage + "y."), (key, passage + "z.")])).collect())
        assert got == [0, 2, 2]


def brute_score(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def test_alignment_against_brute_force():
    rnd = random.Random(3)
    for _ in range(60):
        a, b = (np.array([rnd.randrange(4) for _ in range(rnd.randrange(1, 15))], np.uint64) for _ in range(2))
        assert decontaminate.best_alignment(a, b)[0] == brute_score(a, b)


def tokens(text):
    return [w for w in re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())]


def leak_rows():
    rnd = random.Random(12)
    text = lambda n: [f"v{rnd.randrange(300)}" for _ in range(n)]
    items = [(i, " ".join(text(rnd.randrange(12, 40)))) for i in range(15)] + [(90, "tiny item"), (91, ""), (92, None), (93, "Ünï Cödé fünf sechs")]
    docs = [(None, None), (-1, ""), (-2, "a tiny, ITEM here"), (-3, "ünï cödé, fünf! sechs")]
    for i in range(120):
        body = text(rnd.randrange(80))
        if i % 3 == 0:
            copy = items[rnd.randrange(15)][1].split()
            for _ in range(rnd.randrange(8)):
                k = rnd.randrange(len(copy))
                copy[k:k + 1] = rnd.choice([[], ["edit"], [copy[k], "more"]])
            k = rnd.randrange(len(body) + 1)
            body[k:k] = copy
        docs.append((i, " ".join(body)))
    docs.append((200, items[3][1] + " and " + items[4][1] + " " + items[3][1]))
    docs.append((200, docs[-1][1]))
    return docs, items


def test_leaks_against_alignment_of_all_with_all(spark, docs_of):
    docs, items = leak_rows()
    got = {}
    for r in decontaminate.matches(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect():
        got[(r.doc_id, r.item_id)] = r
    want = {}
    for d, t in docs:
        for i, x in items:
            a, b = tokens(x), tokens(t)
            if a and b:
                s = brute_score(a, b) / (2 * len(a))
                grams = {tuple(b[k:k + 4]) for k in range(len(b))}
                if s >= 0.5 and (len(a) < 4 or any(tuple(a[k:k + 4]) in grams for k in range(len(a) - 3))):
                    want[(d, i)] = s
    assert set(got) == set(want)
    assert all(abs(got[k].score - want[k]) < 1e-9 for k in want)
    r = got[(200, 3)]
    assert (r.first_word, r.end_word) in ((0, len(items[3][1].split())), (len(tokens(docs[-1][1])) - len(items[3][1].split()), len(tokens(docs[-1][1]))))


def test_blocks_of_items_give_the_same(spark, docs_of, monkeypatch):
    docs, items = leak_rows()
    table, bench = docs_of(docs), spark.createDataFrame(items, "item_id long, text string")
    once = sorted(decontaminate.matches(table, bench).collect(), key=str)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 600)
    assert sorted(decontaminate.matches(table, bench).collect(), key=str) == once
    kept = decontaminate.keep_clean(table, bench)
    assert kept.columns == table.columns
    leaky = {r.doc_id for r in once}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in leaky)


def test_no_items_and_no_texts(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(docs_of([(1, "a b c d e")]), none).count() == 0
    assert decontaminate.keep_clean(docs_of([(1, "a")]), none).count() == 1
    assert decontaminate.matches(docs_of([]), spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")).count() == 0


def test_an_edited_passage_is_found_however_often_it_occurs(spark, docs_of):
    item = [f"q{k}" for k in range(15)]
    edited = [*item[:3], "x", *item[4:7], "y", *item[8:]]  # four of its 4-grams are left
    other = ["z" if k % 4 == 3 and k < 11 else w for k, w in enumerate(reversed(item))][::-1]
    assert brute_score(item, edited) / 30 == 0.8
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for copies in (1, 5, 1000):
        # one whole copy, too, which must not make the seeds of the others look common
        docs = docs_of([(i, " ".join(["a b", *edited, "c"])) for i in range(copies)] + [(5000, " ".join(item)), (6000, " ".join(other)), (7000, "c d")])
        want = {i for i in range(copies)} | {5000} | ({6000} if brute_score(item, other) >= 15 else set())
        assert {r.doc_id for r in decontaminate.matches(docs, bench).collect()} == want
        assert {r.doc_id for r in decontaminate.keep_clean(docs, bench).collect()} == {i for i in [6000, 7000] if i not in want}
