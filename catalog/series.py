"""Grids, statistics, rolling windows and window features (R, A, W, F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import CHAIN, HOURLY, KEY, grid_sql, hourly, near_sql, query, r6, rounded, table
from tidewatch.operators import features, grid, rolling, stats
from tidewatch.operators.fill import fill_gaps
from tidewatch.plans.workflows import parse_single_file

# -- grids

_TRUNC = {
    "1min": ("date_trunc('minute', ts)", "INTERVAL 1 MINUTE"),
    "5min": ("time_bucket(INTERVAL 5 MINUTE, ts)", "INTERVAL 5 MINUTE"),
    "15min": ("time_bucket(INTERVAL 15 MINUTE, ts)", "INTERVAL 15 MINUTE"),
    "30min": ("time_bucket(INTERVAL 30 MINUTE, ts)", "INTERVAL 30 MINUTE"),
    "1h": ("date_trunc('hour', ts)", "INTERVAL 1 HOUR"),
    "1D": ("date_trunc('day', ts)::TIMESTAMP", "INTERVAL 1 DAY"),
    "1W": ("(date_trunc('week', ts) + INTERVAL 6 DAY)::TIMESTAMP", "INTERVAL 7 DAY"),
}


def _resample_mean(freq):
    trunc, step = _TRUNC[freq]

    @query(f"R1_resample_mean_{freq}" if freq != "1W" else "R2_resample_weekly_events",
           f"WITH {grid_sql(trunc, step)} SELECT event_type, ts, pos, round(value, 6) AS value FROM cells")
    def _(spark, sf):
        return rounded(grid.resample_mean(table(spark, sf, "events"), KEY, "ts", "value", freq), "value")


for _f in _TRUNC:
    _resample_mean(_f)


@query("R1_resample_mean_by_user", f"WITH {grid_sql(key='user_id')} SELECT user_id, ts, pos, round(value, 6) AS value FROM cells")
def _(spark, sf):
    return rounded(grid.resample_mean(table(spark, sf, "events"), ["user_id"], "ts", "value", "1h"), "value")


@query("R2_resample_weekly", f"""WITH w AS (SELECT o_orderstatus, o_orderdate AS ts, o_totalprice AS value FROM orders),
{grid_sql(*_TRUNC['1W'], key='o_orderstatus', source='w')} SELECT o_orderstatus, ts, pos, round(value, 6) AS value FROM cells""")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderstatus", F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("value"))
    return rounded(grid.resample_mean(rows, ["o_orderstatus"], "ts", "value", "1W"), "value")


@query("R3_resample_mixed", f"""WITH e AS (SELECT user_id % 10 AS grp, * FROM events),
obs AS (SELECT grp, date_trunc('hour', ts) AS ts, avg(value) AS value, arg_min(event_type, (ts, event_id)) AS event_type FROM e GROUP BY 1, 2),
span AS (SELECT grp, min(ts) AS lo, max(ts) AS hi FROM obs GROUP BY 1),
spine AS (SELECT grp, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM span),
cells AS (SELECT s.grp, s.ts, o.value, o.event_type, row_number() OVER (PARTITION BY s.grp ORDER BY s.ts) - 1 AS pos
          FROM spine s LEFT JOIN obs o ON s.grp = o.grp AND s.ts = o.ts), {near_sql(key='grp')}
SELECT grp, ts, round({CHAIN}, 6) AS value, event_type FROM near""")
def _(spark, sf):
    rows = table(spark, sf, "events").withColumn("grp", F.col("user_id") % 10)
    return rounded(grid.resample_mixed(rows, ["grp"], "ts", "1h", ["value"], ["event_type"], "interpolate", tie="event_id").drop("pos"), "value")


@query("R3_resample_mixed_ffill", f"""WITH e AS (SELECT user_id % 10 AS grp, * FROM events),
obs AS (SELECT grp, date_trunc('hour', ts) AS ts, avg(value) AS value, arg_min(event_type, (ts, event_id)) AS event_type FROM e GROUP BY 1, 2),
span AS (SELECT grp, min(ts) AS lo, max(ts) AS hi FROM obs GROUP BY 1),
spine AS (SELECT grp, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM span),
cells AS (SELECT s.grp, s.ts, o.value, o.event_type FROM spine s LEFT JOIN obs o ON s.grp = o.grp AND s.ts = o.ts)
SELECT grp, ts, round(last_value(value IGNORE NULLS) OVER w, 6) AS value, last_value(event_type IGNORE NULLS) OVER w AS event_type
FROM cells WINDOW w AS (PARTITION BY grp ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def _(spark, sf):
    rows = table(spark, sf, "events").withColumn("grp", F.col("user_id") % 10)
    return rounded(grid.resample_mixed(rows, ["grp"], "ts", "1h", ["value"], ["event_type"], "ffill", tie="event_id").drop("pos"), "value")


@query("R4_resample_sum_5min", f"WITH {grid_sql(*_TRUNC['5min'], agg='sum(value)')} SELECT event_type, ts, round(coalesce(value, 0), 6) AS value FROM cells")
def _(spark, sf):
    return rounded(grid.resample_sum(table(spark, sf, "events"), KEY, "ts", "value").drop("pos"), "value")


@query("R5_daily_sum", """SELECT o_orderpriority, date_trunc('day', o_orderdate)::TIMESTAMP AS o_orderdate, round(sum(o_totalprice), 2) AS o_totalprice
    FROM orders GROUP BY 1, 2""")
def _(spark, sf):
    out = grid.daily_sum(table(spark, sf, "orders"), ["o_orderpriority"], "o_orderdate", "o_totalprice")
    return out.withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("R6_daily_anomaly_count", f"""WITH f AS (SELECT event_type, ts, (value > 150)::INT AS value FROM events),
{grid_sql(*_TRUNC['1D'], agg='sum(value)', source='f')} SELECT event_type, ts, coalesce(value, 0)::BIGINT AS anomalies FROM cells""")
def _(spark, sf):
    rows = table(spark, sf, "events").withColumn("hot", F.col("value") > 150)
    return grid.daily_count(rows, KEY, "ts", "hot").drop("pos")


MINUTES = f"""m AS (SELECT event_type, date_trunc('minute', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2),
{grid_sql('ts', 'INTERVAL 1 MINUTE', source='m')}"""


def minutes(spark, sf, fill="none"):
    """events on the minute grid, without aggregation after the one that makes timestamps unique."""
    like = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    rows = table(spark, sf, "events").groupBy("event_type", like.alias("ts")).agg(F.avg("value").alias("value"))
    return grid.conform(rows, KEY, "ts", ["value"], "1min", fill)


@query("R7_conform_to_minutes", f"WITH {MINUTES} SELECT event_type, ts, pos, round(value, 6) AS value FROM cells")
def _(spark, sf):
    return rounded(minutes(spark, sf), "value")


@query("R8_parse_single_file", f"""WITH hr AS (SELECT 'heart_rate' AS metric, ts AS "timestamp", value FROM events WHERE event_type = 'click'),
s AS (SELECT 'steps' AS metric, ts, value FROM events WHERE event_type = 'view'),
{grid_sql(*_TRUNC['5min'], agg='sum(value)', key='metric', source='s')}
SELECT metric, "timestamp", round(value, 6) AS value FROM hr
UNION ALL SELECT metric, ts, round(coalesce(value, 0), 6) FROM cells
UNION ALL SELECT 'sleep', date_trunc('day', ts)::TIMESTAMP, round(sum(value), 6) FROM events WHERE event_type = 'purchase' GROUP BY 2""")
def _(spark, sf):
    of = lambda t: F.when(F.col("event_type") == t, F.col("value"))
    wide = table(spark, sf, "events").select(
        F.col("ts").alias("timestamp"), of("click").alias("heart_rate"), of("view").alias("step_count"), of("purchase").alias("duration_minutes"))
    return rounded(parse_single_file(wide), "value")


@query("R9_future_steps", """WITH l AS (SELECT event_type, max(ts) AS last FROM events GROUP BY 1)
SELECT DISTINCT event_type, ts, false AS is_future FROM events
UNION ALL SELECT event_type, last + k * INTERVAL 1 MINUTE, true FROM l, (SELECT unnest(generate_series(1, 1440)) AS k)""")
def _(spark, sf):
    return grid.future_steps(table(spark, sf, "events"), KEY, "ts", 24)


# -- statistics

@query("A1_basic_features", HOURLY + """, n AS (SELECT *, max(pos) OVER (PARTITION BY event_type) AS last FROM g)
SELECT event_type, count(*)::BIGINT AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
 round(max(value), 6) AS max, round(median(value), 6) AS median, round(var_samp(value), 6) AS variance, round(skewness(value), 6) AS skewness,
 round(kurtosis(value), 6) AS kurtosis, round(avg(value) FILTER (pos > last - 24), 6) AS rolling_mean_24,
 round(stddev_samp(value) FILTER (pos > last - 24), 6) AS rolling_std_24, round(regr_slope(value, pos), 6) AS trend_slope FROM n GROUP BY 1""")
def _(spark, sf):
    out = stats.basic_features(hourly(spark, sf), KEY, "value")
    return rounded(out, *[c for c in out.columns if c not in ("event_type", "count")])


def _vectors(spark, sf, n=4):
    return table(spark, sf, "embeddings").select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(n)])


@query("A2_group_stats", "SELECT label, count(*)::BIGINT AS n, " + ", ".join(
    f"round(avg(embedding[{i + 1}]::DOUBLE), 6) AS e{i}_mean, round(stddev_samp(embedding[{i + 1}]::DOUBLE), 6) AS e{i}_std" for i in range(3)) + " FROM embeddings GROUP BY 1")
def _(spark, sf):
    out = stats.group_stats(_vectors(spark, sf), ["label"], ["e0", "e1", "e2"])
    return rounded(out, *[c for c in out.columns if c.startswith("e")])


@query("A3_hourly_profile", HOURLY + " SELECT event_type, hour(ts)::INT AS hour, round(avg(value), 6) AS mean_value FROM g GROUP BY 1, 2")
def _(spark, sf):
    return rounded(stats.hourly_profile(hourly(spark, sf), KEY, "ts", "value"), "mean_value")


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("A4_correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM lineitem" for a in _NUM for b in _NUM))
def _(spark, sf):
    return rounded(stats.correlation_matrix(table(spark, sf, "lineitem"), _NUM), "correlation")


@query("A4_correlation_embeddings", """WITH u AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS i FROM embeddings)
SELECT 'e' || a.i AS column_a, 'e' || b.i AS column_b, round(corr(a.v, b.v), 6) AS correlation FROM u a JOIN u b USING (vec_id) GROUP BY a.i, b.i""")
def _(spark, sf):
    names = [f"e{i}" for i in range(64)]
    rows = table(spark, sf, "embeddings").select(*[F.get("embedding", F.lit(i)).alias(c) for i, c in enumerate(names)])
    return rounded(stats.correlation_matrix(rows, names), "correlation")


@query("A5_histogram", """WITH r AS (SELECT l_returnflag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY 1),
b AS (SELECT l_returnflag, least(floor((l_extendedprice - lo) / ((hi - lo) / 50.0::DOUBLE)), 49)::INT AS bin, count(*) AS n
      FROM lineitem JOIN r USING (l_returnflag) GROUP BY 1, 2),
k AS (SELECT l_returnflag, lo, (hi - lo) / 50.0::DOUBLE AS w, unnest(range(50))::INT AS bin FROM r)
SELECT l_returnflag, bin, round(lo + w * bin, 6) AS bin_start, round(lo + w * (bin + 1), 6) AS bin_end, coalesce(n, 0)::BIGINT AS n
FROM k LEFT JOIN b USING (l_returnflag, bin)""")
def _(spark, sf):
    return rounded(stats.histogram(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", 50), "bin_start", "bin_end")


@query("A6_box_summary", """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75 FROM events GROUP BY 1),
i AS (SELECT *, value BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS inside FROM events JOIN q USING (event_type))
SELECT event_type, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75, min(value) FILTER (inside) AS whisker_low,
 max(value) FILTER (inside) AS whisker_high, (count(*) FILTER (NOT inside))::BIGINT AS outliers FROM i GROUP BY event_type, q25, q50, q75""")
def _(spark, sf):
    return rounded(stats.box_summary(table(spark, sf, "events"), KEY, "value"), "q25", "q50", "q75")


@query("A6_box_outliers", """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.75) AS q75 FROM events GROUP BY 1)
SELECT event_id, event_type, value FROM events JOIN q USING (event_type) WHERE value < q25 - 1.5 * (q75 - q25) OR value > q75 + 1.5 * (q75 - q25)""")
def _(spark, sf):
    return stats.box_outliers(table(spark, sf, "events"), KEY, "value").select("event_id", "event_type", "value")


@query("A7_missing_matrix", """WITH t AS (SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, 'quality' AS "column", (quality IS NULL)::INT AS is_missing FROM t UNION ALL SELECT doc_id, 'toxic', (toxic IS NULL)::INT FROM t""")
def _(spark, sf):
    from tidewatch.operators.profile import missing_matrix

    docs = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return missing_matrix(docs, ["doc_id"], ["quality", "toxic"])


@query("A8_totals", """SELECT count(*)::BIGINT AS total_records, (SELECT count(DISTINCT event_type) FROM events)::BIGINT AS metrics_tracked,
 ((epoch_us(max(ts)) - epoch_us(min(ts))) // 86400000000)::BIGINT AS duration_days, (count(*) FILTER (value > 150))::BIGINT AS total_anomalies,
 round((count(*) FILTER (value > 150)) * 100.0::DOUBLE / count(*), 6) AS anomaly_pct FROM events""")
def _(spark, sf):
    rows = table(spark, sf, "events").withColumn("hot", F.col("value") > 150)
    return rounded(stats.totals(rows, "ts", "hot", F.count_distinct("event_type")), "anomaly_pct")


@query("A9_method_breakdown", """SELECT 'threshold' AS method, (count(*) FILTER (value > 150))::BIGINT AS anomalies FROM events
UNION ALL SELECT 'trend', (count(*) FILTER (value > 200))::BIGINT FROM events
UNION ALL SELECT 'final', (count(*) FILTER (value > 150 AND value > 200))::BIGINT FROM events""")
def _(spark, sf):
    rows = table(spark, sf, "events").withColumns({"a": F.col("value") > 150, "b": F.col("value") > 200}).withColumn("c", F.col("a") & F.col("b"))
    return stats.method_breakdown(rows, {"threshold": "a", "trend": "b", "final": "c"})


@query("A10_value_counts", "SELECT label, count(*)::BIGINT AS n FROM embeddings GROUP BY 1")
def _(spark, sf):
    return stats.value_counts(table(spark, sf, "embeddings"), ["label"])


# -- rolling windows

def _frame(a, b):
    end = "CURRENT ROW" if b == 0 else f"{b} FOLLOWING"
    return f"OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN {a} PRECEDING AND {end})"


@query("W1_trailing_24", HOURLY + f""" SELECT event_type, ts, round(avg(value) {_frame(23, 0)}, 6) AS roll_mean_24,
    round(stddev_samp(value) {_frame(23, 0)}, 6) AS roll_std_24 FROM g""")
def _(spark, sf):
    out = rolling.trailing_stats(hourly(spark, sf), KEY, "value", 24)
    return rounded(out.select("event_type", "ts", "roll_mean_24", "roll_std_24"), "roll_mean_24", "roll_std_24")


@query("W2_trailing_5", HOURLY + f""" SELECT event_type, ts, round(avg(value) {_frame(4, 0)}, 6) AS roll_mean_5,
    round(coalesce(stddev_samp(value) {_frame(4, 0)}, 0), 6) AS roll_std_5 FROM g""")
def _(spark, sf):
    out = rolling.trailing_stats(hourly(spark, sf), KEY, "value", 5, std_null=0.0)
    return rounded(out.select("event_type", "ts", "roll_mean_5", "roll_std_5"), "roll_mean_5", "roll_std_5")


def _centered(rows):
    a, b = rows // 2, (rows - 1) // 2

    @query(f"W3_centered_{rows}", HOURLY + f""" SELECT event_type, ts, round(avg(value) {_frame(a, b)}, 6) AS center_mean,
        round(stddev_pop(value) {_frame(a, b)}, 6) AS center_std FROM g""")
    def _(spark, sf):
        out = rolling.centered_stats(hourly(spark, sf), KEY, "value", rows)
        return rounded(out.select("event_type", "ts", "center_mean", "center_std"), "center_mean", "center_std")


_centered(60)
_centered(5)


@query("W4_sustained", HOURLY + f""" SELECT event_type, ts, coalesce(sum((value > 50)::INT) {_frame(2, 0)}, 0) >= 3 AS high FROM g""")
def _(spark, sf):
    return rolling.sustained(hourly(spark, sf), KEY, {"high": F.col("value") > 50}, 3).select("event_type", "ts", "high")


WINDOWS = HOURLY + """, n AS (SELECT event_type, max(pos) + 1 AS len FROM g GROUP BY 1),
starts AS (SELECT event_type, unnest(generate_series(0, (len - 60) // 30)) AS window_id FROM n WHERE len >= 60),
win AS (SELECT s.event_type, s.window_id, g.pos - s.window_id * 30 AS i, g.value AS x FROM starts s
        JOIN g ON g.event_type = s.event_type AND g.pos BETWEEN s.window_id * 30 AND s.window_id * 30 + 59)"""


@query("W5_overlapping_windows", WINDOWS + " SELECT event_type, window_id, i, round(x, 6) AS value FROM win")
def _(spark, sf):
    return rounded(rolling.overlapping_windows(hourly(spark, sf), KEY, 60).select("event_type", "window_id", "i", "value"), "value")


@query("W6_difference", HOURLY + " SELECT event_type, ts, round(value - lag(value) OVER (PARTITION BY event_type ORDER BY pos), 6) AS diff FROM g")
def _(spark, sf):
    return rounded(rolling.difference(hourly(spark, sf), KEY, "value").select("event_type", "ts", "diff"), "diff")


# -- window features

def _phi(m):
    near = " AND ".join(f"abs(a[p + {k}] - a[q + {k}]) <= 0.2 * sd" for k in range(m))
    top = 60 - m + 1
    return f"""list_avg(list_transform(range(1, {top + 1}), lambda p: ln(list_sum(list_transform(range(1, {top + 1}),
        lambda q: CASE WHEN {near} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)) / {top}.0::DOUBLE)))"""


def _run(op):
    """Longest run of rows strictly above or below the mean, as gaps and islands."""
    return f"""(SELECT event_type, window_id, max(len) AS len FROM (SELECT event_type, window_id, count(*) AS len FROM (
      SELECT event_type, window_id, i, i - row_number() OVER (PARTITION BY event_type, window_id ORDER BY i) AS island
      FROM win JOIN m USING (event_type, window_id) WHERE x {op} mu) GROUP BY event_type, window_id, island) GROUP BY 1, 2)"""


def _autocorr(lag):
    return f"""list_sum(list_transform(range(1, {61 - lag}), lambda p: (a[p] - mu) * (a[p + {lag}] - mu))) / ({60 - lag}.0::DOUBLE * nullif(vr, 0))"""


_peak = " AND ".join(f"a[p] > a[p - {d}] AND a[p] > a[p + {d}]" for d in (1, 2, 3))
_spec = """list_transform(range(0, 31), lambda k: sqrt(
   list_sum(list_transform(range(0, 60), lambda t: a[t + 1] * cos(2 * pi() * k * t / 60))) ** 2
 + list_sum(list_transform(range(0, 60), lambda t: a[t + 1] * sin(2 * pi() * k * t / 60))) ** 2))"""

FEATURES_SQL = WINDOWS + f""", m AS (SELECT event_type, window_id, avg(x) AS mu FROM win GROUP BY 1, 2),
w AS (SELECT event_type, window_id, list(x ORDER BY i) AS a, avg(x) AS mu, stddev_pop(x) AS sd, var_pop(x) AS vr, median(x) AS med, min(x) AS mn,
  max(x) AS mx, skewness(x) AS sk, kurtosis(x) AS ku, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS q2, quantile_cont(x, 0.75) AS q3,
  sum(x * x) AS e, regr_slope(x, i) AS sl, regr_intercept(x, i) AS ic, count(*) FILTER (x >= -1 AND x < 1) AS rc FROM win GROUP BY 1, 2),
d AS (SELECT *, list_transform(range(1, 60), lambda p: a[p + 1] - a[p]) AS df, {_spec} AS spec FROM w),
f AS (SELECT event_type, window_id, mu AS mean, med AS median, sd AS standard_deviation, vr AS variance, mn AS minimum, mx AS maximum,
  list_sum(list_transform(df, lambda v: abs(v))) / 59 AS mean_abs_change, (a[60] - a[1]) / 59 AS mean_change, sk AS skewness, ku AS kurtosis,
  q1 AS quantile_25, q2 AS quantile_50, q3 AS quantile_75, e AS abs_energy, list_sum(list_transform(df, lambda v: abs(v))) AS absolute_sum_of_changes,
  len(list_filter(a, lambda v: v > mu)) AS count_above_mean, len(list_filter(a, lambda v: v < mu)) AS count_below_mean,
  sl AS linear_trend_slope, ic AS linear_trend_intercept, {_autocorr(1)} AS autocorrelation_lag_1, {_autocorr(2)} AS autocorrelation_lag_2,
  {_autocorr(5)} AS autocorrelation_lag_5, abs({_phi(2)} - {_phi(3)}) AS approximate_entropy,
  CASE WHEN sd = 0 THEN 0 ELSE sqrt(list_sum(list_transform(df, lambda v: (v / sd) ** 2))) END AS cid_ce,
  len(list_filter(range(4, 58), lambda p: {_peak})) AS number_peaks, rc AS range_count,
  len(list_filter(a, lambda v: abs(v - mu) > 2 * sd)) / 60.0::DOUBLE AS ratio_beyond_r_sigma,
  list_sum(list_transform(range(1, 32), lambda k: (k - 1) * spec[k])) / list_sum(spec) AS fft_centroid,
  list_sum(list_transform(range(1, 59), lambda p: a[p + 2] ** 2 * a[p + 1] - a[p + 1] * a[p] ** 2)) / 58 AS time_reversal_asymmetry FROM d),
feat AS (SELECT f.*, ra.len AS longest_strike_above_mean, rb.len AS longest_strike_below_mean FROM f
  LEFT JOIN {_run('>')} ra USING (event_type, window_id) LEFT JOIN {_run('<')} rb USING (event_type, window_id))"""

_COUNTS = {"count_above_mean", "count_below_mean", "longest_strike_above_mean", "longest_strike_below_mean", "number_peaks", "range_count"}


def _feat_cols(names):
    return ", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" if c in _COUNTS else f"round({c}, 6) AS {c}" for c in names)


GROUPS = {
    "F01_F06_location_and_spread": features.FEATURES[:6],
    "F07_F16_changes_and_shape": features.FEATURES[6:15],
    "F16_F19_runs_and_counts": features.FEATURES[15:19],
    "F20_F24_trend_and_autocorrelation": features.FEATURES[19:24],
    "F25_F31_complexity_and_spectrum": features.FEATURES[24:],
}


def _feature_group(name, cols):
    @query(name, FEATURES_SQL + f" SELECT event_type, window_id, {_feat_cols(cols)} FROM feat")
    def _(spark, sf):
        out = features.window_features(hourly(spark, sf), KEY, "value", 60).select("event_type", "window_id", *cols)
        return rounded(out, *[c for c in cols if c not in _COUNTS])


for _n, _c in GROUPS.items():
    _feature_group(_n, _c)




@query("F32_impute_features", HOURLY + """, h AS (SELECT event_type, pos, CASE WHEN pos % 5 = 0 THEN NULL WHEN pos % 7 = 0 THEN 'infinity'::DOUBLE
   WHEN pos % 11 = 0 THEN '-infinity'::DOUBLE ELSE value END AS value FROM g),
s AS (SELECT event_type, median(value) FILTER (isfinite(value)) AS md, min(value) FILTER (isfinite(value)) AS lo, max(value) FILTER (isfinite(value)) AS hi FROM h GROUP BY 1)
SELECT event_type, pos, round(CASE WHEN value IS NULL THEN md WHEN isfinite(value) THEN value WHEN value > 0 THEN hi ELSE lo END, 6) AS value FROM h JOIN s USING (event_type)""")
def _(spark, sf):
    p, inf = F.col("pos"), F.lit(float("inf"))
    holes = hourly(spark, sf).withColumn("value", F.when(p % 5 == 0, None).when(p % 7 == 0, inf).when(p % 11 == 0, -inf).otherwise(F.col("value")))
    return rounded(features.impute_features(holes.select("event_type", "pos", "value"), ["value"], KEY), "value")


@query("F33_drop_constant_features", HOURLY + " SELECT event_type, pos, round(value, 6) AS value FROM g")
def _(spark, sf):
    with_constant = hourly(spark, sf).select("event_type", "pos", "value", F.lit(7.0).alias("level"))
    return rounded(features.drop_constant_features(with_constant, ["value", "level"]), "value")


def _var_rows(names):
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, var_samp({c}::DOUBLE) AS v, avg({c}::DOUBLE) AS mu, stddev_samp({c}::DOUBLE) AS sd FROM base" for c in names)


_CATEGORY = """CASE WHEN regexp_matches(lower(feature), 'trend|slope|linear') THEN 'Trend Pattern'
 WHEN regexp_matches(lower(feature), 'energy|entropy|complexity') THEN 'Activity Level'
 WHEN regexp_matches(lower(feature), 'autocorrelation|recurrence') THEN 'Rhythm Pattern'
 WHEN regexp_matches(lower(feature), 'quantile|skewness|kurtosis') THEN 'Distribution Shape'
 WHEN regexp_matches(lower(feature), 'mean|median|std') THEN 'Central Tendency'
 WHEN regexp_matches(lower(feature), 'peak|fft') THEN 'Spectral Pattern' ELSE 'General Pattern' END"""


@query("A11_top_features", FEATURES_SQL + f""", base AS (SELECT event_type, window_id, {_feat_cols(features.FEATURES)} FROM feat),
v AS ({_var_rows(features.FEATURES)}), top AS (SELECT * FROM v ORDER BY v DESC, feature LIMIT 12)
SELECT feature, round(v, 4) AS variance, round(mu, 4) AS mean, round(sd, 4) AS std, {_CATEGORY} AS relevance FROM top""")
def _(spark, sf):
    feats = features.window_features(hourly(spark, sf), KEY, "value", 60)
    feats = rounded(feats, *[c for c in features.FEATURES if c not in _COUNTS])
    out = stats.top_features(feats, features.FEATURES, 12)
    return out.withColumns({c: F.round(c, 4) for c in ("variance", "mean", "std")})


@query("A12_feature_relevance", FEATURES_SQL + f""", base AS (SELECT event_type, window_id, {_feat_cols(features.FEATURES)} FROM feat),
v AS ({_var_rows(features.FEATURES)})
SELECT {_CATEGORY} AS relevance, count(*)::BIGINT AS features, (count(*) FILTER (v > 1e-9))::BIGINT AS varying FROM v GROUP BY 1""")
def _(spark, sf):
    feats = features.window_features(hourly(spark, sf), KEY, "value", 60)
    feats = rounded(feats, *[c for c in features.FEATURES if c not in _COUNTS])
    out = stats.top_features(feats, features.FEATURES, len(features.FEATURES))
    return out.groupBy("relevance").agg(F.count(F.lit(1)).alias("features"), F.count_if(F.col("variance") > 1e-9).alias("varying"))
