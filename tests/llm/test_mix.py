"""Source mixing against its SQL and the rules of the targets."""

from oracle import compare, connect

from tidewatch.llm import mix
from tidewatch.llm.queries import QUERIES, SQL


def filled(weights, sizes, budget=1.5, epochs=2.0):
    """Targets by the rounds that the rule describes."""
    held, total = {}, budget * sum(sizes)
    while True:
        free = [i for i in range(len(sizes)) if i not in held]
        if not free:
            break
        level = (total - sum(held.values())) / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * level > epochs * sizes[i]]
        if not over:
            return [held.get(i, weights[i] * level) for i in range(len(sizes))]
        held |= {i: epochs * sizes[i] for i in over}
    return [held[i] for i in range(len(sizes))]


def test_query_matches_sql(spark, sf):
    assert compare(spark, connect(sf), QUERIES["op1_mix_sources"], SQL["op1_mix_sources"], sf)[0] == "ok"


def test_targets_and_takings(docs_of):
    rows, n = [], 0
    for s, docs in (("a", 30), ("b", 200), (None, 50), ("\U0001f600", 90), ("ß", 4)):
        for i in range(docs):
            rows.append((n, " ".join(["w"] * (1 + (i * 7) % 23)), s))
            n += 1
    rows += [(None, "x y", "a"), (9999, None, "a"), (10000, "", "b"), (3, "x", "a"), (10001, "z " * 2000, "b")]
    docs = docs_of(rows)
    got = mix.mix(docs, mix.cycled_weights(docs)).collect()
    assert len(got) == len(rows)
    names = sorted({r[2] for r in rows if r[2] is not None}) + [None]
    sizes = [sum(len((t or "").split()) for _, t, s in rows if s == name) for name in names]
    want = filled([(3, 1, 2)[i % 3] for i in range(5)], sizes)
    taken = {}
    for r in got:
        taken.setdefault((r.source_size, round(r.target, 6)), []).append(r)
        assert r.taken <= 2 * r.size and r.taken == r.size * r.copies
    for size, target in zip(sizes, want):
        mine = taken[(size, round(target, 6))]
        assert abs(sum(r.taken for r in mine) - target) <= max(r.size for r in mine) / 2 + 1e-6
    again = mix.mix(docs.repartition(3), mix.cycled_weights(docs)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_no_rows_and_no_words(docs_of):
    empty = docs_of([])
    assert mix.mix(empty, mix.cycled_weights(empty)).count() == 0
    none = docs_of([(1, None), (2, "")])
    assert [(r.size, r.target, r.taken) for r in mix.mix(none, mix.cycled_weights(none)).collect()] == [(0, 0.0, 0)] * 2


def test_sources_without_weight_are_not_taken(spark, docs_of):
    docs = docs_of([(1, "a b", "s"), (2, "c d", "t")])
    got = mix.mix(docs, spark.createDataFrame([("s", 2)], "source string, weight int")).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == [(1, 4), (2, 0)]
