"""Sources, typing, profiling and cleaning (S, D, P, C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import CHAIN, HOURLY, KEY, LINE, grid_sql, hourly, near_sql, query, r6, rounded, table
from tidewatch.operators import clean, profile
from tidewatch.operators.fill import fill_gaps
from tidewatch.plans.chunks import with_position
from tidewatch.plans.staging import staging_path
from tidewatch.sources import readers, roles, writers


# -- sources and sinks

ORDERS_SQL = """SELECT o_orderstatus, count(*)::BIGINT AS n, round(sum(o_totalprice), 2) AS total,
       min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders GROUP BY 1"""


def _orders_summary(df):
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"))


@query("S1_csv_scan", ORDERS_SQL)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    path = staging_path(spark, "orders") + ".csv"
    writers.write_csv(orders, path)
    return _orders_summary(readers.read_table(spark, path, orders.schema))


@query("S1_csv_scan_inferred", """SELECT count(*)::BIGINT AS n, round(avg(o_totalprice), 6) AS mean_price,
    sum(o_custkey)::BIGINT AS custkeys FROM orders""")
def _(spark, sf):
    path = staging_path(spark, "orders") + ".csv"
    writers.write_csv(table(spark, sf, "orders"), path)
    return readers.read_csv(spark, path).agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("o_totalprice")).alias("mean_price"),
        F.sum("o_custkey").cast("bigint").alias("custkeys"))


EVENTS_SQL = """SELECT event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total,
       min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1"""


def _events_summary(df):
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"),
                                        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("S2_json_scan", EVENTS_SQL)
def _(spark, sf):
    events = table(spark, sf, "events")
    path = staging_path(spark, "events") + ".jsonl"
    writers.write_json(events, path)
    return _events_summary(readers.read_table(spark, path, events.schema))


# One array in one file, with text in its strings that looks like the array's own signs, read back by many tasks.
@query("S2_json_array", """SELECT event_id, event_type, round(value, 6) AS value, 'n' || event_id || ' }],{[ " \\ "}' AS note, [event_id, event_id + 1] AS list FROM events""")
def _(spark, sf):
    path = staging_path(spark, "array") + ".json"
    rows = table(spark, sf, "events").select("event_id", "event_type", "value", F.format_string('n%d }],{[ " \\ "}', "event_id").alias("note"),
                                             F.array("event_id", F.col("event_id") + 1).alias("list"))
    writers.write_json_array(rows, path)
    return rounded(readers.read_table(spark, path, rows.schema), "value")


@query("S3_format_dispatch", EVENTS_SQL)
def _(spark, sf):
    return _events_summary(readers.read_table(spark, f"{sf}/events.parquet"))


@query("S4_csv_sink_cleaned", HOURLY + " SELECT event_type, ts, round(value, 6) AS value FROM g")
def _(spark, sf):
    cleaned = hourly(spark, sf).select("event_type", "ts", r6("value").alias("value"))
    path = staging_path(spark, "cleaned") + ".csv"
    writers.write_csv(cleaned, path)
    return readers.read_csv(spark, path, cleaned.schema)


@query("S5_csv_sink_anomalies", """WITH m AS (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sd FROM events GROUP BY 1)
SELECT e.event_type, e.event_id, e.ts, e.value FROM events e JOIN m USING (event_type) WHERE abs(value - mu) > 3 * sd""")
def _(spark, sf):
    from tidewatch.operators.detect import global_sigma

    events = table(spark, sf, "events")
    found = global_sigma(events, KEY, "value", 3.0, "flag").filter("flag").select("event_id", "ts", "value", "event_type")
    path = staging_path(spark, "anomalies") + ".csv"
    writers.write_csv(found, path, partition_by=["event_type"])
    return readers.read_csv(spark, path, found.schema)


@query("S6_json_sink_report", """SELECT event_type, count(*)::BIGINT AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY 1""")
def _(spark, sf):
    report = table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("value")).alias("mean_value"))
    path = staging_path(spark, "report") + ".json"
    writers.write_json(report, path)
    back = readers.read_json(spark, path, report.schema, lines=True)
    return writers.as_json(back).select(F.from_json("report", report.schema).alias("r")).select("r.*")


@query("S7_head", "SELECT event_id, ts, event_type, value FROM events ORDER BY ts, event_id LIMIT 10")
def _(spark, sf):
    return readers.head(table(spark, sf, "events").select("event_id", "ts", "event_type", "value"), ["ts", "event_id"], 10)


# -- roles and types

@query("D1_timestamp_role", "SELECT event_id, ts AS parsed, 'ts' AS role FROM events")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "props", F.col("ts").cast("string").alias("ts"))
    timed, role = roles.ensure_timestamp(events)
    return timed.select("event_id", F.col(role).cast("timestamp_ntz").alias("parsed"), F.lit(role).alias("role"))


@query("D2_timestamp_role_by_substring", "SELECT o_orderkey, o_orderdate AS parsed, 'o_orderdate' AS role FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("string").alias("o_orderdate"))
    timed, role = roles.ensure_timestamp(orders, mode="substring")
    return timed.select("o_orderkey", F.col(role).cast("timestamp_ntz").alias("parsed"), F.lit(role).alias("role"))


@query("D3_synthetic_times", """SELECT p_partkey, p_retailprice,
    TIMESTAMP '2024-01-01' + (row_number() OVER (ORDER BY p_partkey) - 1) * INTERVAL 1 MINUTE AS "timestamp" FROM part""")
def _(spark, sf):
    return roles.synthetic_times(table(spark, sf, "part").select("p_partkey", "p_retailprice"), ["p_partkey"])


@query("D4_metric_split", """SELECT l_orderkey, l_linenumber, 'metric_1' AS metric, 'l_quantity' AS source_column, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'metric_2', 'l_extendedprice', l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'metric_3', 'l_discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'metric_4', 'l_tax', l_tax FROM lineitem""")
def _(spark, sf):
    return roles.to_long(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                         ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("D4_metric_by_name", """SELECT event_id, 'heart_rate' AS metric, 'resting_bpm' AS source_column, value FROM events
UNION ALL SELECT event_id, 'steps', 'step_count', value * 10 FROM events
UNION ALL SELECT event_id, 'metric_1', 'user_id', user_id::DOUBLE FROM events""")
def _(spark, sf):
    wide = table(spark, sf, "events").select(
        "event_id", F.col("value").alias("resting_bpm"), (F.col("value") * 10).alias("step_count"), "user_id")
    return roles.to_long(wide, ["event_id"])


@query("D5_parse_times", """SELECT event_id, ts FROM events WHERE event_id % 7 <> 0""")
def _(spark, sf):
    dirty = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 7 == 0, "not a time").otherwise(F.col("ts").cast("string")).alias("ts"))
    return roles.parse_times(dirty, "ts").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("D6_coerce_numeric", """SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k,
    try_cast(event_type AS DOUBLE) AS junk FROM events""")
def _(spark, sf):
    raw = table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("junk"))
    return roles.coerce_numeric(raw, ["k", "junk"])


@query("D7_numeric_columns", """SELECT * FROM (VALUES ('l_orderkey'), ('l_partkey'), ('l_suppkey'), ('l_linenumber'), ('l_quantity'),
    ('l_extendedprice'), ('l_discount'), ('l_tax')) AS t("column") WHERE (SELECT count(*) FROM lineitem) > 0""")
def _(spark, sf):
    items = table(spark, sf, "lineitem")
    return profile.numeric_ranges(items.select(*roles.numeric_columns(items))).select("column")


@query("D8_rename_project", "SELECT event_type AS metric, ts AS timestamp, value FROM events")
def _(spark, sf):
    return table(spark, sf, "events").withColumnRenamed("ts", "timestamp").select(
        F.col("event_type").alias("metric"), "timestamp", "value")


# -- profiling

LABELLED = "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def _labelled(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return docs.join(table(spark, sf, "labels"), on="doc_id", how="left")


@query("P1_null_counts", f"""WITH t AS (SELECT d.doc_id, text, lang, source, n_chars, quality, toxic FROM {LABELLED}),
c AS (SELECT count(*) AS n, count(doc_id) AS a, count(text) AS x, count(lang) AS b, count(source) AS y, count(n_chars) AS c, count(quality) AS d, count(toxic) AS e FROM t)
SELECT u."column", (n - u.k)::BIGINT AS missing_count, round((n - u.k) / n::DOUBLE * 100, 2) AS missing_pct FROM c,
 LATERAL (VALUES ('doc_id', a), ('text', x), ('lang', b), ('source', y), ('n_chars', c), ('quality', d), ('toxic', e)) AS u("column", k)""")
def _(spark, sf):
    return profile.null_counts(_labelled(spark, sf)).select("column", "missing_count", "missing_pct")


@query("P2_missing_total", f"""WITH c AS (SELECT count(*) AS n, count(*) - count(quality) AS q, count(*) - count(toxic) AS t FROM {LABELLED})
SELECT (q + t)::BIGINT AS missing_cells, round(round(q / n::DOUBLE * 100, 2) + round(t / n::DOUBLE * 100, 2), 2) AS missing_pct_sum FROM c""")
def _(spark, sf):
    return profile.missing_total(_labelled(spark, sf))


@query("P3_column_types", """SELECT * FROM (VALUES ('doc_id', 'bigint'), ('text', 'string'), ('lang', 'string'), ('source', 'string'), ('n_chars', 'bigint'), ('quality', 'int'),
    ('toxic', 'int')) AS t("column", dtype) WHERE (SELECT count(*) FROM documents) > 0""")
def _(spark, sf):
    return profile.null_counts(_labelled(spark, sf)).select("column", "dtype")


@query("P4_duplicate_rows", """SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem)))::BIGINT
    AS duplicates FROM lineitem""")
def _(spark, sf):
    return profile.duplicate_rows(table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag"))


NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("P5_numeric_ranges", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value FROM lineitem" for c in NUMERIC))
def _(spark, sf):
    return profile.numeric_ranges(table(spark, sf, "lineitem"), NUMERIC)


@query("P6_shape", "SELECT count(*)::BIGINT AS n_rows, 11::BIGINT AS n_columns FROM lineitem")
def _(spark, sf):
    return profile.shape(table(spark, sf, "lineitem"))


@query("P7_describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c})::BIGINT AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min,
    round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
    max({c})::DOUBLE AS max FROM lineitem""" for c in NUMERIC))
def _(spark, sf):
    return rounded(profile.describe(table(spark, sf, "lineitem"), NUMERIC), "mean", "std", "q25", "q50", "q75")


@query("P8_schema_info", f"""WITH c AS (SELECT count(d.doc_id) AS a, count(text) AS x, count(lang) AS b, count(source) AS y, count(n_chars) AS c, count(quality) AS d, count(toxic) AS e FROM {LABELLED})
SELECT u."column", u.dtype, u.k::BIGINT AS present_count FROM c,
 LATERAL (VALUES ('doc_id', 'bigint', a), ('text', 'string', x), ('lang', 'string', b), ('source', 'string', y), ('n_chars', 'bigint', c), ('quality', 'int', d), ('toxic', 'int', e)) AS u("column", dtype, k)""")
def _(spark, sf):
    return profile.null_counts(_labelled(spark, sf)).select("column", "dtype", "present_count")


@query("P9_validate", """SELECT event_id, 'heart_rate' AS "column", value AS value, 'heart_rate outside plausible range (30-220)' AS issue
    FROM events WHERE value < 30 OR value > 220
    UNION ALL SELECT event_id, 'steps', value - 5, 'negative steps' FROM events WHERE value - 5 < 0""")
def _(spark, sf):
    wide = table(spark, sf, "events").select("event_id", F.col("value").alias("heart_rate"), (F.col("value") - 5).alias("steps"))
    return profile.validate(wide, ["event_id"])


@query("P10_preparation_report", """WITH long AS (SELECT 'metric_1' AS metric FROM lineitem UNION ALL SELECT 'metric_2' FROM lineitem)
SELECT metric, count(*)::BIGINT AS points, (SELECT count(*) FROM lineitem)::BIGINT AS raw_rows, 2::BIGINT AS metrics,
       8::BIGINT AS numeric_columns FROM long GROUP BY ROLLUP (metric)""")
def _(spark, sf):
    items = table(spark, sf, "lineitem")
    return profile.preparation_report(items, roles.to_long(items, ["l_orderkey"], ["l_quantity", "l_tax"]))


# -- cleaning

@query("C1_drop_sparse_rows", f"""SELECT d.doc_id, text, lang, source, n_chars, quality, toxic FROM {LABELLED}
    WHERE (d.doc_id IS NOT NULL)::INT + (text IS NOT NULL)::INT + (lang IS NOT NULL)::INT + (source IS NOT NULL)::INT + (n_chars IS NOT NULL)::INT + (quality IS NOT NULL)::INT
      + (toxic IS NOT NULL)::INT >= 6""")
def _(spark, sf):
    return clean.drop_sparse_rows(_labelled(spark, sf), 10)


@query("C2_deduplicate", "SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem")
def _(spark, sf):
    return clean.drop_duplicate_rows(table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag"))


@query("C3_null_outliers", """WITH m AS (SELECT event_type, avg(value) AS mu, stddev_pop(value) AS sd, count(value) AS n FROM events GROUP BY 1)
SELECT event_id, event_type, CASE WHEN n >= 3 AND abs((value - mu) / (sd + 1e-9::DOUBLE)) > 4 THEN NULL ELSE value END AS value
FROM events JOIN m USING (event_type)""")
def _(spark, sf):
    return clean.null_outliers(table(spark, sf, "events"), ["value"], 4.0, KEY).select("event_id", "event_type", "value")


@query("C3_null_outliers_whole_table", """WITH m AS (SELECT avg(value) AS mu, stddev_pop(value) AS sd FROM events)
SELECT event_id, CASE WHEN abs((value - mu) / (sd + 1e-9::DOUBLE)) > 4 THEN NULL ELSE value END AS value FROM events, m""")
def _(spark, sf):
    return clean.null_outliers(table(spark, sf, "events"), ["value"], 4.0).select("event_id", "value")


@query("C4_median_fill", f"""SELECT d.doc_id, coalesce(quality::DOUBLE, (SELECT median(quality) FROM labels)) AS quality,
    coalesce(toxic::DOUBLE, (SELECT median(toxic) FROM labels)) AS toxic FROM {LABELLED}""")
def _(spark, sf):
    return clean.fill_median(_labelled(spark, sf), ["quality", "toxic"]).select("doc_id", "quality", "toxic")


@query("C4_median_fill_by_series", f"""WITH {grid_sql()}, m AS (SELECT event_type, median(value) AS med FROM cells GROUP BY 1)
SELECT event_type, ts, round(coalesce(value, med), 6) AS value FROM cells JOIN m USING (event_type)""")
def _(spark, sf):
    return rounded(clean.fill_median(hourly(spark, sf, "none"), ["value"], KEY).select("event_type", "ts", "value"), "value")


def _fill(name, method, expr):
    @query(name, f"WITH {grid_sql()}, {near_sql()} SELECT event_type, ts, round({expr}, 6) AS value FROM near")
    def _(spark, sf):
        return rounded(fill_gaps(hourly(spark, sf, "none"), KEY, "pos", ["value"], method).select("event_type", "ts", "value"), "value")


_fill("C5_interpolate", "interpolate", f"coalesce(value, {LINE}, pv)")
_fill("C6_interpolate_both", "interpolate_both", CHAIN)
_fill("C7_forward_fill", "ffill", "coalesce(value, pv)")
_fill("C8_backward_fill", "bfill", "coalesce(value, nv)")
_fill("C9_zero_fill", "zero", "coalesce(value, 0)")
_fill("C10_fill_chain", "chain", CHAIN)

# Raw rows with NULLs at both ends and inside: values above 60 are taken out.
RAW_GAPS = f"""WITH cells AS (SELECT event_type, event_id, ts, CASE WHEN value <= 60 THEN value END AS value,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS pos FROM events), {near_sql()}"""


@query("C6_interpolate_raw_rows", RAW_GAPS + f" SELECT event_id, pos, round({CHAIN}, 6) AS value FROM near")
def _(spark, sf):
    gaps = table(spark, sf, "events").select("event_type", "event_id", "ts", F.when(F.col("value") <= 60, F.col("value")).alias("value"))
    placed = with_position(gaps, KEY, ["ts", "event_id"])
    return rounded(fill_gaps(placed, KEY, "pos", ["value"], "interpolate_both").select("event_id", "pos", "value"), "value")


@query("C11_fill_expression", f"WITH {grid_sql()} SELECT event_type, ts, round(coalesce(value, pos + 1.0), 6) AS value FROM cells")
def _(spark, sf):
    return rounded(clean.fill_expr(hourly(spark, sf, "none"), {"value": F.col("pos") + 1.0}).select("event_type", "ts", "value"), "value")


@query("C12_standardize", """WITH m AS (SELECT event_type, avg(value) AS mu, stddev_pop(value) AS sd FROM events GROUP BY 1)
SELECT event_id, round((value - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) AS value_scaled FROM events JOIN m USING (event_type)""")
def _(spark, sf):
    return rounded(clean.standardize(table(spark, sf, "events"), ["value"], KEY).select("event_id", "value_scaled"), "value_scaled")


@query("C13_sort_by_time", "SELECT event_id, ts FROM events ORDER BY ts, event_id")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts").orderBy("ts", "event_id")
