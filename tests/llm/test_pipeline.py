"""The pipeline, stage by stage, against brute force."""

from oracle import compare, connect, normal
from test_groups import brute_near

import corpus_pipeline
from tidewatch.llm import decontaminate, toxic
from tidewatch.llm.queries import OP1, QUERIES
from tidewatch.plans.staging import stage, stage_at


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels, bench = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    fns = dict(corpus_pipeline.STAGES)
    assert list(fns) == ["toxicity", "exact dedup", "near dedup", "decontamination", "mixing"]
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)

    bad = {r.doc_id for r in toxic.score(docs, toxic.learn(docs, labels)).collect() if r.predicted}
    one = stage(fns["toxicity"](spark, docs, sf), "t")
    assert one.columns == docs.columns and rows(one) == [r for r in rows(docs) if r[0] not in bad]

    two = stage(fns["exact dedup"](spark, one, sf), "t")
    last = {}
    for r in rows(one):
        last[r[1]] = max(last.get(r[1], r), r)
    assert two.columns == docs.columns and rows(two) == sorted(last.values(), key=str)

    three = stage(fns["near dedup"](spark, two, sf), "t")
    stays = {c for _, _, c in brute_near([(r[0], r[1]) for r in rows(two)])}
    assert three.columns == docs.columns and rows(three) == [r for r in rows(two) if r[0] in stays]

    four = stage(fns["decontamination"](spark, three, sf), "t")
    leaks = {r.doc_id for r in decontaminate.matches(three, bench).collect()}
    assert four.columns == docs.columns and rows(four) == [r for r in rows(three) if r[0] not in leaks]

    four, path = stage_at(four, "t")
    con = connect(sf)
    con.execute(f"CREATE VIEW kept AS SELECT * FROM read_parquet('{path}/*.parquet')")
    five = fns["mixing"](spark, four, sf)
    res = con.execute(OP1.format(docs="kept"))
    want = normal([d[0] for d in res.description], res.fetchall())
    assert normal(five.columns, five.collect()) == want
    ran = corpus_pipeline.run(spark, sf)
    assert normal(ran.columns, ran.collect()) == want


def test_the_registered_query_is_the_pipeline():
    assert QUERIES["pipeline"] is corpus_pipeline.run and compare and corpus_pipeline.ORACLE_SQL is None
