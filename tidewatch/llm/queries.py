"""The corpus operators as queries over the whole tables, with SQL where it can say the same."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import centroids, codes, decontaminate, exact, language, mix, quality, repeats, scoring, sentences, simhash, toxic, warc
from tidewatch.llm import labels as lab

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))  # corpus_pipeline lies beside the package

import corpus_pipeline  # noqa: E402

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Reading a key as SQL: 15 hex digits of the digest, by value of each digit.
_KEY = "('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT"

OP1 = f"""
WITH sized AS (SELECT doc_id, source, {_KEY} AS key,
                      coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM {{docs}}),
totals AS (SELECT source, sum(size)::BIGINT AS source_size, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
           FROM sized GROUP BY source),
limits AS (SELECT *, source_size * 2.0::DOUBLE AS lim, source_size * 2.0::DOUBLE / weight AS ratio,
                  sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM totals),
levels AS (SELECT *, (budget - coalesce(sum(lim) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                     / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM limits),
chosen AS (SELECT (SELECT lev FROM levels WHERE lev <= ratio ORDER BY ratio, lev LIMIT 1) AS level),
targets AS (SELECT source, source_size, CASE WHEN level IS NULL OR weight * level > lim THEN lim ELSE weight * level END AS target FROM levels, chosen),
plan AS (SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END)::BIGINT AS whole FROM targets),
rests AS (SELECT *, target - whole * source_size AS rest FROM plan),
sums AS (SELECT source, key, sum(size) AS size FROM sized GROUP BY ALL),
runs AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key) - size / 2.0::DOUBLE AS middle FROM sums),
cuts AS (SELECT r.source, max(key) FILTER (middle <= rest) AS cut FROM runs r JOIN rests p ON r.source IS NOT DISTINCT FROM p.source GROUP BY 1)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM (
  SELECT s.doc_id, s.size, p.source_size, p.target,
         (p.whole + CASE WHEN p.rest > 0 AND s.key <= c.cut THEN 1 ELSE 0 END)::INT AS copies
  FROM sized s JOIN rests p ON s.source IS NOT DISTINCT FROM p.source JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source)"""


@query("op1_mix_sources", OP1.format(docs="documents"))
def op1(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return mix.mix(docs, mix.cycled_weights(docs))


OP6 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.text) AS text_sha256
FROM d JOIN g USING (text)"""


@query("op6_exact_dedup", OP6)
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf, "documents"))


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf, "documents"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxic.learn(docs, table(spark, sf, "labels"))
    return toxic.score(docs, model).withColumn("held_out", lab.held_out("doc_id", 5, 0))


@query("op9_decontaminate")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


@query("op3_quality")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality.learn(docs, table(spark, sf, "labels"))
    return quality.score(docs, model).withColumn("held_out", lab.held_out("doc_id", 5, 0))


@query("op7_language_id")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return language.predict(docs, language.learn(docs)).withColumn("held_out", lab.held_out("doc_id", 3, 1))


OP8 = r"""
WITH split AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^.!?\n]+[.!?\n]*\s*|[.!?\n]+\s*') AS s FROM documents),
plain AS (SELECT doc_id, list_transform(s, lambda x: regexp_replace(lower(trim(x, ' ')), '\s+', ' ', 'g')) AS p FROM split WHERE len(s) > 0),
counted AS (SELECT doc_id, p, list_transform(p, lambda x: len(regexp_extract_all(x, '\S+'))) AS w FROM plain),
starts AS (SELECT doc_id, p, w, unnest(range(len(p))) AS pos FROM counted),
lengths AS (SELECT doc_id, p, pos, list_filter(range(2, 12), lambda n: pos + n <= len(p) AND list_sum(w[pos + 1 : pos + n]) >= 10)[1] AS n FROM starts
            UNION ALL SELECT doc_id, p, pos, 1 FROM starts WHERE w[pos + 1] >= 20 OR (len(p) = 1 AND w[1] >= 10)),
spans AS (SELECT doc_id, pos, n, array_to_string(p[pos + 1 : pos + n], ' ') AS run FROM lengths WHERE n IS NOT NULL),
firsts AS (SELECT *, row_number() OVER (PARTITION BY run, n ORDER BY doc_id, pos) AS k FROM spans),
covered AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS pos FROM firsts WHERE k > 1),
gone AS (SELECT doc_id, list_sort(list(pos)) AS gone FROM covered GROUP BY 1)
SELECT d.doc_id, len(s)::BIGINT AS n_sentences, coalesce(len(list_filter(gone, lambda i: i < len(s))), 0)::BIGINT AS n_removed,
       coalesce(len(list_filter(gone, lambda i: i < len(s) AND NOT list_contains(gone, i - 1))), 0)::BIGINT AS n_spans,
       CASE WHEN gone IS NULL THEN text
            ELSE array_to_string(list_transform(list_filter(range(len(s)), lambda i: NOT list_contains(gone, i)), lambda i: s[i + 1]), '') END AS text
FROM split d LEFT JOIN gone g ON d.doc_id = g.doc_id"""


@query("op8_substring_dedup", OP8)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return sentences.dedup(table(spark, sf, "documents"))


@query("op5_warc_round_trip")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf, "pages"))


@query("op10_suffix_repeats")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.dedup(table(spark, sf, "documents"))


_OP11_ROUND = """
s{i} AS (SELECT vec_id, copy, cluster, distance FROM (SELECT v.vec_id, v.copy, c.cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance,
               row_number() OVER (PARTITION BY v.vec_id, v.copy ORDER BY distance, c.cluster) AS place
        FROM flat v JOIN c{i} c USING (d) GROUP BY 1, 2, 3) WHERE place = 1),"""
_OP11_MOVE = """
m{j} AS (SELECT cluster, d, sum(x)::HUGEINT AS t, count(*)::HUGEINT AS n FROM s{i} JOIN flat USING (vec_id, copy) GROUP BY 1, 2),
c{j} AS (SELECT c.cluster, c.d, CASE WHEN n IS NULL THEN c.x ELSE ((t - ((t % n) + n) % n) // n)::BIGINT END AS x FROM c{i} c LEFT JOIN m{j} USING (cluster, d)),"""

OP11 = """
WITH kept AS (SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY embedding) AS copy, [floor(64 * y::DOUBLE)::BIGINT FOR y IN embedding] AS v FROM embeddings
              WHERE len(embedding) = 64 AND len([y FOR y IN embedding IF y IS NOT NULL AND isfinite(y)]) = 64),
flat AS MATERIALIZED (SELECT vec_id, copy, unnest(v) AS x, unnest(range(64)) AS d FROM kept),
c0 AS (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS d FROM (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS cluster FROM kept) WHERE cluster < 16),
""" + "".join(_OP11_ROUND.format(i=i) + _OP11_MOVE.format(i=i, j=i + 1) for i in range(3)) + _OP11_ROUND.format(i=3) + """
named AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c3 GROUP BY 1)
SELECT vec_id, cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM s3 JOIN named USING (cluster)"""


@query("op11_centroid_clusters", OP11)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return centroids.cluster(table(spark, sf, "embeddings"))


_OP12_ROUND = """
s{i} AS (SELECT vec_id, copy, p, e, distance FROM (SELECT v.vec_id, v.copy, v.p, b.e, sum((v.x - b.x) * (v.x - b.x))::BIGINT AS distance,
               row_number() OVER (PARTITION BY v.vec_id, v.copy, v.p ORDER BY distance, b.e) AS place
        FROM flat v JOIN b{i} b USING (p, d) GROUP BY 1, 2, 3, 4) WHERE place = 1),"""
_OP12_MOVE = """
m{j} AS (SELECT p, e, d, sum(x)::HUGEINT AS t, count(*)::HUGEINT AS n FROM s{i} JOIN flat USING (vec_id, copy, p) GROUP BY 1, 2, 3),
b{j} AS (SELECT b.p, b.e, b.d, CASE WHEN n IS NULL THEN b.x ELSE ((t - ((t % n) + n) % n) // n)::BIGINT END AS x FROM b{i} b LEFT JOIN m{j} USING (p, e, d)),"""

OP12 = """
WITH kept AS (SELECT vec_id, label, row_number() OVER (PARTITION BY vec_id ORDER BY embedding) AS copy, [floor(4096 * y::DOUBLE)::BIGINT FOR y IN embedding] AS v FROM embeddings
              WHERE len(embedding) = 64 AND len([y FOR y IN embedding IF y IS NOT NULL AND isfinite(y)]) = 64),
flat AS MATERIALIZED (SELECT vec_id, copy, x, i // 8 AS p, i % 8 AS d FROM (SELECT vec_id, copy, unnest(v) AS x, unnest(range(64)) AS i FROM kept)),
b0 AS (SELECT e, x, i // 8 AS p, i % 8 AS d FROM (SELECT e, unnest(v) AS x, unnest(range(64)) AS i
       FROM (SELECT v, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM kept) WHERE e < 16)),
""" + "".join(_OP12_ROUND.format(i=i) + _OP12_MOVE.format(i=i, j=i + 1) for i in range(6)) + _OP12_ROUND.format(i=6) + """
coded AS (SELECT vec_id, copy, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(distance)::BIGINT AS error FROM s6 GROUP BY 1, 2),
books AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, d)) AS codebooks_sha256 FROM b6)
SELECT vec_id, code, error, label, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id, copy), books"""


@query("op12_vector_codes", OP12)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return codes.encode(table(spark, sf, "embeddings"))


@query("op13_lm_scores")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score(table(spark, sf, "documents"))
