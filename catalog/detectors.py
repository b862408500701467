"""Baselines, detectors, votes and reports (T, N, J, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import CHAIN, HOURLY, KEY, NUDGE, grid_sql, hourly, near_sql, query, r6, rounded, table
from catalog.series import FEATURES_SQL, MINUTES, minutes
from tidewatch.operators import detect, local, trend, vote
from tidewatch.operators.cluster import eligibility, quality
from tidewatch.operators.stats import value_counts
from tidewatch.plans import reports, workflows
from tidewatch.plans.chunks import attach, with_position
from tidewatch.plans.staging import staging_path

# -- T1(a) line plus (weekday, hour) season on the hourly grid: CTE ``fit``

SEASONAL = HOURLY + """,
line AS (SELECT event_type, regr_slope(value, pos) AS b, regr_intercept(value, pos) AS a, max(pos) AS last_pos, max(ts) AS last_ts FROM g GROUP BY 1 HAVING count(value) >= 10),
det AS (SELECT g.*, a + b * pos AS trend, value - (a + b * pos) AS d, isodow(ts) * 24 + hour(ts) AS slot FROM g JOIN line USING (event_type)),
season AS (SELECT event_type, slot, avg(d) AS s FROM det GROUP BY 1, 2),
fit0 AS (SELECT event_type, ts, pos, value, trend + s AS yhat, value - trend - s AS residual FROM det JOIN season USING (event_type, slot)),
sig AS (SELECT event_type, stddev_samp(residual) AS sd, avg(residual) AS mean_r, stddev_pop(residual) AS sdp FROM fit0 GROUP BY 1),
fit AS (SELECT *, yhat - 1.6448536269514722 * sd AS yhat_lower, yhat + 1.6448536269514722 * sd AS yhat_upper FROM fit0 JOIN sig USING (event_type))"""


def seasonal(spark, sf):
    return trend.seasonal_baseline(hourly(spark, sf), KEY, "ts", "value")


@query("T1_seasonal_baseline", SEASONAL + """ SELECT event_type, ts, round(yhat, 6) AS yhat, round(residual, 6) AS residual,
    round(yhat_lower, 6) AS yhat_lower, round(yhat_upper, 6) AS yhat_upper FROM fit""")
def _(spark, sf):
    cols = ["yhat", "residual", "yhat_lower", "yhat_upper"]
    return rounded(seasonal(spark, sf).select("event_type", "ts", *cols), *cols)


@query("T1_fourier_baseline")
def _(spark, sf):
    return trend.fourier_baseline(hourly(spark, sf), KEY, "ts", "value", ("yearly", "weekly", "daily"), width=0.80)


@query("T2_fourier_defaults")
def _(spark, sf):
    return trend.fourier_baseline(hourly(spark, sf), KEY, "ts", "value", width=0.80)


# The level and the base slope are all but free, so their normal equations hold: residuals sum to 0, alone and times t.
FREE_TERMS = HOURLY + """ SELECT event_type, count(*)::BIGINT AS n_rows, 0.0::DOUBLE AS level, 0.0::DOUBLE AS slope FROM g GROUP BY 1"""


def _free_terms(out):
    spans = out.groupBy("event_type").agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("_a"), F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("_b"))
    t = (F.unix_micros(F.col("ts").cast("timestamp")) - F.col("_a")) / (F.col("_b") - F.col("_a"))
    return out.join(spans, "event_type").groupBy("event_type").agg(
        F.count("residual").alias("n_rows"), F.round(F.abs(F.avg("residual")), 4).alias("level"), F.round(F.abs(F.avg(F.col("residual") * t)), 4).alias("slope"))


@query("T1_fourier_normal_equations", FREE_TERMS)
def _(spark, sf):
    return _free_terms(trend.fourier_baseline(hourly(spark, sf), KEY, "ts", "value", ("yearly", "weekly", "daily"), width=0.80))


@query("T2_fourier_normal_equations", FREE_TERMS)
def _(spark, sf):
    return _free_terms(trend.fourier_baseline(hourly(spark, sf), KEY, "ts", "value", width=0.80))


# What makes a fit the best one under its priors: for a slope that changes the residuals' product with its hinge is the penalty,
# with the change's sign; for one that doesn't it is no larger; for a season it is the coefficient times its own penalty.
OPTIMAL = HOURLY + """ SELECT event_type, count(*)::BIGINT AS n_rows, 25::BIGINT AS changepoints, 0::BIGINT AS violated, true AS sparse, true AS seasons FROM g GROUP BY 1"""


def _optimal(spark, sf, seasons):
    rows, n = hourly(spark, sf), trend.CHANGEPOINTS
    placed = attach(rows, trend.fourier_fit(rows, KEY, "ts", "value", seasons), KEY)
    basis = trend.fourier_basis("ts", seasons)
    yhat = sum((F.col("_coef")[i] * b for i, b in enumerate(basis)), F.lit(0.0))
    sums = placed.withColumn("_r", F.col("value") - yhat).groupBy("event_type").agg(
        F.count("_r").alias("n_rows"), F.any_value("_coef").alias("_coef"), F.any_value("_penalty").alias("_penalty"), F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("_scale"),
        F.array(*[F.sum(b * F.col("_r")) for b in basis]).alias("_s"))
    penalty, near = F.col("_penalty"), F.col("_penalty") * 1e-4
    hinge = F.transform(F.sequence(F.lit(2), F.lit(n + 1)), lambda i: F.when(F.get(F.col("_coef"), i) == 0, F.abs(F.get(F.col("_s"), i)) <= penalty + near).otherwise(
        F.abs(F.get(F.col("_s"), i) - F.signum(F.get(F.col("_coef"), i)) * penalty) <= near))
    weight = penalty / F.col("_scale") * trend.CHANGEPOINT_PRIOR / trend.SEASON_PRIOR**2
    season = F.forall(F.sequence(F.lit(n + 2), F.lit(len(basis) - 1)), lambda i: F.abs(F.get(F.col("_s"), i) - weight * F.get(F.col("_coef"), i)) <= near)
    zero = F.size(F.filter(F.slice("_coef", 3, n), lambda c: c == 0))
    return sums.select("event_type", "n_rows", F.size(hinge).cast("bigint").alias("changepoints"), F.size(F.filter(hinge, lambda ok: ~ok)).cast("bigint").alias("violated"),
                       (zero >= n // 2).alias("sparse"), season.alias("seasons"))


@query("T1_fourier_optimality", OPTIMAL)
def _(spark, sf):
    return _optimal(spark, sf, ("yearly", "weekly", "daily"))


@query("T2_fourier_optimality", OPTIMAL)
def _(spark, sf):
    return _optimal(spark, sf, ("weekly", "daily"))


DECOMPOSE_SHORT = HOURLY + """, t AS (SELECT *, avg(value) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING) AS trend FROM g),
s AS (SELECT event_type, pos % {period} AS slot, {mid}(value - trend) AS seasonal FROM t GROUP BY 1, 2),
p AS (SELECT t.event_type, t.ts, t.pos, t.value, trend, seasonal, trend + seasonal AS predicted, value - trend - seasonal AS residual
      FROM t JOIN s ON t.event_type = s.event_type AND t.pos % {period} = s.slot),
z AS (SELECT event_type, stddev_pop(residual) AS sd FROM p GROUP BY 1),
dec AS (SELECT p.*, predicted - 1.96 * sd AS yhat_lower, predicted + 1.96 * sd AS yhat_upper FROM p JOIN z USING (event_type))"""
PARTS = ["trend", "seasonal", "predicted", "residual", "yhat_lower", "yhat_upper"]
PARTS_SQL = ", ".join(f"round({c}, 6) AS {c}" for c in PARTS)


@query("T3_decompose_daily_period", DECOMPOSE_SHORT.format(before=12, after=11, period=24, mid="avg") + f" SELECT event_type, ts, {PARTS_SQL} FROM dec")
def _(spark, sf):
    return rounded(trend.decompose(hourly(spark, sf), KEY, "value", period=24).select("event_type", "ts", *PARTS), *PARTS)


@query("T3_decompose_half_length", DECOMPOSE_SHORT.replace("avg(value) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING)",
    "(SELECT avg(h.value) FROM g h, nn WHERE h.event_type = g.event_type AND nn.event_type = g.event_type AND h.pos BETWEEN g.pos - nn.period // 2 AND g.pos + (nn.period - 1) // 2)")
    .replace(", t AS", ", nn AS (SELECT event_type, greatest(3, count(*) // 2) AS period FROM g GROUP BY 1), t AS", 1)
    .replace("pos % {period} AS slot", "pos % (SELECT period FROM nn WHERE nn.event_type = t.event_type) AS slot")
    .replace("t.pos % {period}", "t.pos % (SELECT period FROM nn WHERE nn.event_type = t.event_type)").format(mid="avg")
    + f" SELECT event_type, ts, {PARTS_SQL} FROM dec")
def _(spark, sf):
    return rounded(trend.decompose(hourly(spark, sf), KEY, "value").select("event_type", "ts", *PARTS), *PARTS)


@query("T3_decompose_robust", DECOMPOSE_SHORT.format(before=12, after=11, period=24, mid="median") + f" SELECT event_type, ts, {PARTS_SQL} FROM dec")
def _(spark, sf):
    return rounded(trend.decompose(hourly(spark, sf), KEY, "value", period=24, robust=True).select("event_type", "ts", *PARTS), *PARTS)


def _local_sql(period: int, rounds: int = 3) -> str:
    half = local.half_width(period)
    sql = HOURLY + ", r0 AS (SELECT event_type, ts, pos, value, 0::DOUBLE AS s, 1::DOUBLE AS w FROM g)"
    for i in range(rounds + 1):
        mid = "median(value - trend)" if i == 0 else "sum(w * (value - trend)) / sum(w)"
        sql += """,
t0 AS (SELECT *, median(value) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN {0} PRECEDING AND {0} FOLLOWING) AS trend FROM r0)""".format(period // 2) if i == 0 else f""",
near{i} AS (SELECT a.event_type, a.pos, (b.pos - a.pos) / {half + 1}::DOUBLE AS d, b.w * pow(1 - pow(abs(d), 3), 3) AS k, b.value - b.s AS y
      FROM r{i} a JOIN r{i} b ON a.event_type = b.event_type AND b.pos BETWEEN a.pos - {half} AND a.pos + {half}),
sums{i} AS (SELECT event_type, pos, sum(k) AS s0, sum(k * d) AS s1, sum(k * d * d) AS s2, sum(k * y) AS t0, sum(k * d * y) AS t1 FROM near{i} GROUP BY 1, 2),
t{i} AS (SELECT r.*, CASE WHEN s0 * s2 - s1 * s1 > 1e-9 * s0 * s0 THEN (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) ELSE t0 / s0 END AS trend
      FROM r{i} r JOIN sums{i} USING (event_type, pos))"""
        sql += f""",
c{i} AS (SELECT event_type, pos % {period} AS slot, {mid} AS seasonal FROM t{i} GROUP BY 1, 2),
p{i} AS MATERIALIZED (SELECT t.event_type, ts, pos, value, trend, seasonal, trend + seasonal AS predicted, value - trend - seasonal AS residual
      FROM t{i} t JOIN c{i} c ON t.event_type = c.event_type AND pos % {period} = slot)"""
        if i < rounds:
            sql += f""",
m{i} AS (SELECT event_type, median(abs(residual)) * 6 AS reach FROM p{i} GROUP BY 1),
r{i + 1} AS (SELECT event_type, ts, pos, value, seasonal AS s, CASE WHEN reach > 0 THEN greatest(0.001::DOUBLE,
      CASE WHEN abs(residual) < reach THEN pow(1 - pow(residual / reach, 2), 2) ELSE 0 END) WHEN residual = 0 THEN 1 ELSE 0.001 END AS w FROM p{i} JOIN m{i} USING (event_type))"""
    return sql + f""", z AS (SELECT event_type, stddev_pop(residual) AS sd FROM p{rounds} GROUP BY 1),
dec AS (SELECT p.*, predicted - 1.96 * sd AS yhat_lower, predicted + 1.96 * sd AS yhat_upper FROM p{rounds} p JOIN z USING (event_type))"""


@query("T3_decompose_local", _local_sql(24) + f" SELECT event_type, ts, {PARTS_SQL} FROM dec")
def _(spark, sf):
    return rounded(local.local_decompose(hourly(spark, sf), KEY, "value", period=24).select("event_type", "ts", *PARTS), *PARTS)


MINUTE_DECOMPOSE = f"""WITH {MINUTES}, {near_sql()}, g AS (SELECT event_type, ts, pos, value AS raw, {CHAIN} AS value FROM near),
t AS (SELECT *, avg(value) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 720 PRECEDING AND 719 FOLLOWING) AS trend FROM g),
s AS (SELECT event_type, pos % 1440 AS slot, avg(value - trend) AS seasonal FROM t GROUP BY 1, 2),
p AS (SELECT t.event_type, t.ts, t.pos, t.value, t.raw, trend, seasonal, trend + seasonal AS predicted, value - trend - seasonal AS residual
      FROM t JOIN s ON t.event_type = s.event_type AND t.pos % 1440 = s.slot),
z AS (SELECT event_type, stddev_pop(residual) AS sd FROM p GROUP BY 1),
dec AS (SELECT p.*, predicted - 1.96 * sd AS yhat_lower, predicted + 1.96 * sd AS yhat_upper FROM p JOIN z USING (event_type))"""


@query("T3_decompose_minute_grid", MINUTE_DECOMPOSE + " SELECT event_type, ts, " + ", ".join(f"round({c} + 1e-9::DOUBLE, 4) AS {c}" for c in PARTS) + " FROM dec")
def _(spark, sf):
    """Over a million values: compared to 4 digits, as some always lie next to a rounding at 6."""
    out = trend.decompose(minutes(spark, sf, "chain"), KEY, "value")
    return out.select("event_type", "ts", *[F.round(F.col(c) + NUDGE, 4).alias(c) for c in PARTS])


@query("T4_baseline_fallback", SEASONAL + " SELECT event_type, ts, round(yhat, 6) AS yhat FROM fit")
def _(spark, sf):
    return rounded(trend.predict(hourly(spark, sf), KEY, "ts", "value", "seasonal").select("event_type", "ts", "yhat"), "yhat")


@query("T5_seasonal_forecast", SEASONAL + """, f AS (SELECT l.event_type, last_ts + k * INTERVAL 1 MINUTE AS ts, a + b * (last_pos + k / 60.0::DOUBLE) AS trend, sd
    FROM line l JOIN sig USING (event_type), (SELECT unnest(generate_series(1, 1440)) AS k)),
 y AS (SELECT f.event_type, f.ts, sd, trend + coalesce(s, 0) AS yhat FROM f LEFT JOIN season ON f.event_type = season.event_type AND isodow(ts) * 24 + hour(ts) = slot)
SELECT event_type, ts, round(yhat, 6) AS yhat, round(yhat - 1.6448536269514722 * sd, 6) AS yhat_lower, round(yhat + 1.6448536269514722 * sd, 6) AS yhat_upper FROM y""")
def _(spark, sf):
    return rounded(trend.seasonal_forecast(hourly(spark, sf), KEY, "ts", "value", 24), "yhat", "yhat_lower", "yhat_upper")


@query("T5_fourier_forecast")
def _(spark, sf):
    out = trend.fourier_baseline(hourly(spark, sf), KEY, "ts", "value", hours=24, step="1min")
    return out.filter(F.col("value").isNull()).drop("value", "residual")


@query("T5_fourier_steps", HOURLY + """, l AS (SELECT event_type, max(ts) AS last, count(*) AS n FROM g GROUP BY 1)
SELECT event_type, unnest(generate_series(last + INTERVAL 1 MINUTE, last + INTERVAL 24 HOUR, INTERVAL 1 MINUTE)) AS ts, true AS inside FROM l""")
def _(spark, sf):
    out = trend.fourier_baseline(hourly(spark, sf), KEY, "ts", "value", hours=24, step="1min").filter(F.col("value").isNull())
    return out.select("event_type", "ts", ((F.col("yhat_lower") < F.col("yhat")) & (F.col("yhat") < F.col("yhat_upper"))).alias("inside"))


# What the band's variance has beyond the residuals' grows with the third power of the time ahead.
@query("T5_fourier_band_widens", HOURLY + " SELECT event_type, 1440::BIGINT AS steps, true AS cubic, true AS widens FROM g GROUP BY 1")
def _(spark, sf):
    out = trend.fourier_baseline(hourly(spark, sf), KEY, "ts", "value", hours=24, step="1min").filter(F.col("value").isNull())
    z = trend.Z_OF_WIDTH[0.90]
    half = (F.col("yhat_upper") - F.col("yhat_lower")) / 2.0
    last = out.groupBy("event_type").agg(F.min("ts").alias("_first"))
    k = F.round((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("_first").cast("timestamp"))) / 60e6) + 1.0
    extra = (half / z) * (half / z) - F.col("residual_std") * F.col("residual_std")
    per = attach(out, last, KEY).withColumns({"_k": k, "_e": extra}).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("steps"), F.max(F.when(F.col("_k") == 1440, F.col("_e"))).alias("_end"), F.max(F.when(F.col("_k") == 720, F.col("_e"))).alias("_mid"),
        F.max(F.col("residual_std")).alias("_s"),
        F.max(F.when(F.col("_k") == 1440, half)).alias("_wide"), F.max(F.when(F.col("_k") == 1, half)).alias("_narrow"))
    tiny = F.col("_end") < 1e-9 * F.col("_s") * F.col("_s")  # a series whose slope never changes
    return per.select("event_type", "steps", (tiny | (F.abs(F.col("_end") / F.nullif(F.col("_mid"), F.lit(0.0)) - 8.0) < 1e-3)).alias("cubic"), (tiny | (F.col("_wide") > F.col("_narrow"))).alias("widens"))


@query("T6_fit_metrics", SEASONAL + """, c AS (SELECT *, yhat - lag(yhat) OVER (PARTITION BY event_type ORDER BY pos) AS step FROM fit)
SELECT event_type, round(avg(abs(residual)), 6) AS mae, round(sqrt(avg(residual ** 2)), 6) AS rmse,
 round(1 / (1 + stddev_pop(step)), 6) AS trend_stability, round(stddev_samp(value), 6) AS data_volatility FROM c GROUP BY 1""")
def _(spark, sf):
    cols = ["mae", "rmse", "trend_stability", "data_volatility"]
    return rounded(trend.fit_metrics(seasonal(spark, sf), KEY, "value"), *cols)


# -- detectors

@query("N1_rolling_zscore", HOURLY + """, w AS (SELECT *, avg(value) OVER f AS mu, stddev_pop(value) OVER f AS sd FROM g
  WINDOW f AS (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 30 PRECEDING AND 29 FOLLOWING))
SELECT event_type, ts, coalesce(abs((value - mu) / nullif(sd, 0)) > 3.5, false) AS rolling_anomaly FROM w""")
def _(spark, sf):
    return detect.rolling_zscore(hourly(spark, sf), KEY, "value").select("event_type", "ts", "rolling_anomaly")


@query("N2_global_sigma", HOURLY + """, m AS (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sd FROM g GROUP BY 1)
SELECT event_type, ts, value > mu + 2 * sd OR value < mu - 2 * sd AS anomaly_threshold FROM g JOIN m USING (event_type)""")
def _(spark, sf):
    return detect.global_sigma(hourly(spark, sf), KEY, "value").select("event_type", "ts", "anomaly_threshold")


EVENT_RULES = (
    ("click", "click_value", 5, 60, 3),
    ("view", "view_value", 10, 40, 2),
    ("error", "error_value", 2, 150, 0),
)
_over = "OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
RULES_SQL = f"""WITH r AS (SELECT event_id, event_type, ts, value,
 sum((value > 60)::INT) {_over.format(2)} >= 3 AS ch, sum((value < 5)::INT) {_over.format(2)} >= 3 AS cl,
 sum((value > 40)::INT) {_over.format(1)} >= 2 AS vh, sum((value < 10)::INT) {_over.format(1)} >= 2 AS vl FROM events),
rules AS (SELECT event_id, event_type, ts, CASE WHEN event_type = 'click' AND cl THEN 'click_value < 5 (sustained)' WHEN event_type = 'click' AND ch THEN 'click_value > 60 (sustained)'
  WHEN event_type = 'view' AND vl THEN 'view_value < 10 (sustained)' WHEN event_type = 'view' AND vh THEN 'view_value > 40 (sustained)'
  WHEN event_type = 'error' AND value < 2 THEN 'error_value < 2' WHEN event_type = 'error' AND value > 150 THEN 'error_value > 150' ELSE '' END AS threshold_reason,
 CASE WHEN event_type IN ('click', 'view') AND CASE event_type WHEN 'click' THEN cl ELSE vl END THEN 'medium'
  WHEN event_type IN ('click', 'view') AND CASE event_type WHEN 'click' THEN ch ELSE vh END THEN 'high'
  WHEN event_type = 'error' AND value < 2 THEN 'high' WHEN event_type = 'error' AND value > 150 THEN 'medium' ELSE 'normal' END AS threshold_severity FROM r)"""


def _ruled(spark, sf):
    placed = with_position(table(spark, sf, "events").select("event_id", "event_type", "ts", "value"), KEY, ["ts", "event_id"])
    return detect.threshold_rules(placed, KEY, "event_type", "value", EVENT_RULES)


@query("N3_threshold_rules", RULES_SQL + " SELECT event_type, count(*)::BIGINT AS n, (count(*) FILTER (threshold_reason <> ''))::BIGINT AS hits FROM rules GROUP BY 1")
def _(spark, sf):
    return _ruled(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if("threshold_anomaly").alias("hits"))


@query("N4_sustained_thresholds", RULES_SQL + " SELECT event_id, threshold_reason <> '' AS threshold_anomaly, threshold_reason, threshold_severity FROM rules")
def _(spark, sf):
    return _ruled(spark, sf).select("event_id", "threshold_anomaly", "threshold_reason", "threshold_severity")


@query("N5_residual_two_sigma", SEASONAL + " SELECT event_type, ts, abs(residual) > 2 * sd AS anomaly_trend FROM fit")
def _(spark, sf):
    return detect.residual_two_sigma(seasonal(spark, sf), KEY).select("event_type", "ts", "anomaly_trend")


EVENT_CUTS = {"click": 2.5, "view": 2.8, "error": 3.2}
SCORES_SQL = SEASONAL + """, sc AS (SELECT event_type, ts, value, abs(residual) / nullif(sd, 0) AS score FROM fit),
fl AS (SELECT *, score > CASE event_type WHEN 'click' THEN 2.5 WHEN 'view' THEN 2.8 WHEN 'error' THEN 3.2 ELSE 3.0 END AS hit,
  CASE WHEN score <= 3.0 THEN 'Low' WHEN score <= 4.5 THEN 'Medium' ELSE 'High' END AS sev FROM sc)"""


def _scored(spark, sf):
    return detect.residual_scores(seasonal(spark, sf), KEY, "event_type", cuts=EVENT_CUTS)


@query("N6_residual_by_metric", SCORES_SQL + " SELECT event_type, ts, round(score, 6) AS anomaly_score, hit AS residual_anomaly FROM fl")
def _(spark, sf):
    return rounded(_scored(spark, sf).select("event_type", "ts", "anomaly_score", "residual_anomaly"), "anomaly_score")


@query("N7_severity", SCORES_SQL + " SELECT event_type, ts, sev AS severity FROM fl WHERE hit")
def _(spark, sf):
    return _scored(spark, sf).filter("residual_anomaly").select("event_type", "ts", "severity")


@query("N7_severity_heart_rate", """SELECT event_id, value / 20 AS score, CASE WHEN value / 20 <= 0 THEN NULL WHEN value / 20 <= 2.5 THEN 'Low'
    WHEN value / 20 <= 3.5 THEN 'Medium' ELSE 'High' END AS severity FROM events""")
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", (F.col("value") / 20).alias("score"))
    return rows.withColumn("severity", detect.severity(F.lit("heart_rate"), F.col("score")))


BAND_SQL = MINUTE_DECOMPOSE + """, b AS (SELECT event_type, ts, raw, raw - predicted AS residual, predicted, yhat_lower, yhat_upper FROM dec WHERE raw IS NOT NULL),
rs AS (SELECT event_type, avg(residual) AS mu, CASE WHEN stddev_pop(residual) = 0 THEN 1 ELSE stddev_pop(residual) END AS sdev FROM b GROUP BY 1),
band AS (SELECT b.*, mu, sdev, abs(residual - mu) > 3 * sdev OR raw > yhat_upper OR raw < yhat_lower AS hit FROM b JOIN rs USING (event_type))"""


def _banded(spark, sf):
    """Observed minutes against the decomposition of the filled minute grid."""
    dec = trend.decompose(minutes(spark, sf, "chain"), KEY, "value").select("event_type", "ts", "predicted", "yhat_lower", "yhat_upper")
    like = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    seen = table(spark, sf, "events").groupBy("event_type", like.alias("ts")).agg(F.avg("value").alias("value"))
    placed = with_position(vote.join_forecast(seen, dec, ["event_type", "ts"]), KEY, ["ts"])
    return detect.residual_band(placed, KEY, "value")


@query("N8_residual_band", BAND_SQL + """ SELECT event_type, ts, round(residual, 6) AS residual, hit AS residual_anomaly,
    CASE WHEN hit THEN 'Deviates from predicted trend' ELSE '' END AS residual_reason FROM band""")
def _(spark, sf):
    return rounded(_banded(spark, sf).select("event_type", "ts", "residual", "residual_anomaly", "residual_reason"), "residual")


# -- joins and unions

@query("J1_join_forecast", SEASONAL + """ SELECT e.event_id, round(f.yhat, 6) AS yhat FROM events e LEFT JOIN fit f
    ON e.event_type = f.event_type AND date_trunc('hour', e.ts) = f.ts""")
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
    return rounded(vote.join_forecast(rows, seasonal(spark, sf).select("event_type", "ts", "yhat"), ["event_type", "ts"]).select("event_id", "yhat"), "yhat")


@query("J2_join_flags", """SELECT d.doc_id, coalesce(toxic = 1, false) AS is_toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(spark, sf):
    flags = table(spark, sf, "labels").select("doc_id", (F.col("toxic") == 1).alias("is_toxic"))
    return vote.join_flags(table(spark, sf, "documents").select("doc_id"), flags, ["doc_id"])


@query("J3_concat_by_key", HOURLY + f""" SELECT event_type, pos, round(avg(value) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS roll_mean_5,
    value > 100 AS hot FROM g""")
def _(spark, sf):
    from tidewatch.operators.rolling import trailing_stats

    g = hourly(spark, sf)
    rolled = trailing_stats(g, KEY, "value", 5).select("event_type", "pos", r6("roll_mean_5").alias("roll_mean_5"))
    return vote.join_flags(rolled, g.select("event_type", "pos", (F.col("value") > 100).alias("hot")), ["event_type", "pos"])


@query("J4_union_tagged", """SELECT event_id AS id, value, NULL::VARCHAR AS o_orderstatus, 'events' AS data_type FROM events WHERE value > 150
    UNION ALL SELECT o_orderkey, NULL, o_orderstatus, 'orders' FROM orders WHERE o_totalprice > 400000""")
def _(spark, sf):
    return vote.union_tagged({
        "events": table(spark, sf, "events").filter("value > 150").select(F.col("event_id").alias("id"), "value"),
        "orders": table(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_orderkey").alias("id"), "o_orderstatus")})


@query("J5_semi_anti", """SELECT doc_id, true AS labelled FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
    UNION ALL SELECT doc_id, false FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def _(spark, sf):
    docs, labels = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels")
    return docs.join(labels, "doc_id", "left_semi").withColumn("labelled", F.lit(True)).unionByName(
        docs.join(labels, "doc_id", "left_anti").withColumn("labelled", F.lit(False)))


# -- votes, reasons, lists, evaluation

VOTE_SQL = SEASONAL + """, m AS (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sv FROM g GROUP BY 1),
v AS (SELECT event_type, ts, value, value > mu + 2 * sv OR value < mu - 2 * sv AS anomaly_threshold, abs(residual) > 2 * sd AS anomaly_trend, false AS is_outlier
      FROM fit JOIN m USING (event_type)),
vt AS (SELECT *, anomaly_threshold::INT + anomaly_trend::INT AS anomaly_score FROM v)"""


def _voted(spark, sf, policy="vote"):
    return workflows.ensemble(hourly(spark, sf), KEY, "ts", "value", policy=policy)


@query("N11_vote", VOTE_SQL + " SELECT event_type, ts, anomaly_score, anomaly_score >= 2 AS final_anomaly FROM vt")
def _(spark, sf):
    return _voted(spark, sf).select("event_type", "ts", "anomaly_score", "final_anomaly")


@query("N12_any_flag", VOTE_SQL + " SELECT event_type, ts, anomaly_threshold OR anomaly_trend AS is_anomaly FROM vt")
def _(spark, sf):
    return vote.any_flag(_voted(spark, sf), ["anomaly_threshold", "anomaly_trend", "is_outlier"]).select("event_type", "ts", "is_anomaly")


# Daily totals of three event types as the wide daily table with one flag per method and metric.
DAILY_SQL = """WITH d AS (SELECT date_trunc('day', ts)::TIMESTAMP AS day, sum(value) FILTER (event_type = 'click') AS hr,
  sum(value) FILTER (event_type IN ('view', 'signup')) AS steps, sum(value) FILTER (event_type IN ('purchase', 'error')) AS sleep FROM events GROUP BY 1),
s AS (SELECT avg(hr) AS mh, stddev_samp(hr) AS sh, avg(steps) AS ms, stddev_samp(steps) AS ss, avg(sleep) AS ml, stddev_samp(sleep) AS sl FROM d),
f AS (SELECT day, hr, steps, sleep, abs(hr - mh) > 1.5 * sh AS flag_threshold_hr, abs(steps - ms) > 1.5 * ss AS flag_threshold_steps, abs(sleep - ml) > 1.5 * sl AS flag_threshold_sleep,
  hr > mh + sh AS flag_trend_hr, steps > ms + ss AS flag_trend_steps, sleep > ml + sl AS flag_trend_sleep, hr < mh - sh AS flag_cluster FROM d, s),
r AS (SELECT *, concat_ws(';', CASE WHEN flag_threshold_hr THEN 'thr_hr' END, CASE WHEN flag_threshold_steps THEN 'thr_steps' END, CASE WHEN flag_threshold_sleep THEN 'thr_sleep' END,
  CASE WHEN flag_trend_hr THEN 'pr_hr' END, CASE WHEN flag_trend_steps THEN 'pr_steps' END, CASE WHEN flag_trend_sleep THEN 'pr_sleep' END,
  CASE WHEN flag_cluster THEN 'cluster_multi' END) AS anomaly_reasons FROM f)"""


def _daily(spark, sf):
    from tidewatch.functions.constants import REASON_CODES
    from tidewatch.plans.chunks import attach

    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    of = lambda *t: F.sum(F.when(F.col("event_type").isin(*t), F.col("value")))
    d = table(spark, sf, "events").groupBy(day.alias("day")).agg(of("click").alias("hr"), of("view", "signup").alias("steps"), of("purchase", "error").alias("sleep"))
    s = d.agg(*[f(c).alias(f"{n}_{c}") for c in ("hr", "steps", "sleep") for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    f = attach(d, s, [])
    for c in ("hr", "steps", "sleep"):
        m, sd = F.col(f"m_{c}"), F.col(f"s_{c}")
        f = f.withColumns({f"flag_threshold_{c}": F.abs(F.col(c) - m) > 1.5 * sd, f"flag_trend_{c}": F.col(c) > m + sd})
    f = f.withColumn("flag_cluster", F.col("hr") < F.col("m_hr") - F.col("s_hr"))
    f = vote.any_flag(f.withColumn("anomaly_reasons", vote.reasons()), [c for c, _ in REASON_CODES])
    return f


@query("N13_reason_codes", DAILY_SQL + " SELECT day, anomaly_reasons, anomaly_reasons <> '' AS is_anomaly FROM r")
def _(spark, sf):
    return _daily(spark, sf).select("day", "anomaly_reasons", "is_anomaly")


@query("N14_anomaly_summary", DAILY_SQL + " SELECT day, round(hr, 4) AS hr, anomaly_reasons FROM r WHERE anomaly_reasons <> '' ORDER BY day")
def _(spark, sf):
    return vote.flagged_rows(_daily(spark, sf), "is_anomaly", ["day"]).select("day", F.round("hr", 4).alias("hr"), "anomaly_reasons")


@query("N15_anomaly_list", SCORES_SQL + """ SELECT event_type, strftime(ts, '%Y-%m-%d %H:%M') AS timestamp_text, round(value, 6) AS value,
    round(score, 6) AS anomaly_score, sev AS severity FROM fl WHERE hit ORDER BY score DESC, event_type, ts""")
def _(spark, sf):
    return rounded(vote.anomaly_list(_scored(spark, sf), "residual_anomaly", "ts", "value", "anomaly_score", KEY), "value", "anomaly_score")


@query("N16_evaluate", """WITH t AS (SELECT coalesce(toxic = 1, false) AS label, n_chars > 1500 AS flag FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
c AS (SELECT (count(*) FILTER (label AND flag))::BIGINT AS tp, (count(*) FILTER (NOT label AND flag))::BIGINT AS fp,
  (count(*) FILTER (label AND NOT flag))::BIGINT AS fn, (count(*) FILTER (NOT label AND NOT flag))::BIGINT AS tn FROM t)
SELECT *, round(tp / nullif(tp + fp, 0)::DOUBLE, 6) AS precision, round(tp / nullif(tp + fn, 0)::DOUBLE, 6) AS recall FROM c""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") > 1500).alias("flag"))
    rows = docs.join(table(spark, sf, "labels").select("doc_id", (F.col("toxic") == 1).alias("label")), "doc_id", "left")
    return rounded(vote.evaluate(rows, "label", "flag"), "precision", "recall")


@query("N16_label_flag_counts", """SELECT toxic = 1 AS label, n_chars > 1500 AS flag, count(*)::BIGINT AS n
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2""")
def _(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        (F.col("toxic") == 1).alias("label"), (F.col("n_chars") > 1500).alias("flag"))
    return value_counts(rows, ["label", "flag"])


# -- whole analyses and reports

PREPARE_SQL = f"""WITH m AS (SELECT event_type, avg(value) AS mu, stddev_pop(value) AS sd FROM events GROUP BY 1),
cells AS (SELECT event_type, ts, CASE WHEN abs((value - mu) / (sd + 1e-9::DOUBLE)) > 4 THEN NULL ELSE value END AS value,
   row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS pos FROM events JOIN m USING (event_type)), {near_sql()},
clean AS (SELECT event_type, ts, {CHAIN} AS value FROM near),
{grid_sql(source='clean').replace('cells AS', 'cells2 AS').replace('obs AS', 'obs2 AS').replace('FROM obs', 'FROM obs2').replace('LEFT JOIN obs', 'LEFT JOIN obs2')},
{near_sql('cells2', name='near2')}, g AS (SELECT event_type, ts, pos, {CHAIN} AS value FROM near2)"""


@query("G1_prepare", PREPARE_SQL + """, w AS (SELECT *, avg(value) OVER f AS mu, stddev_pop(value) OVER f AS sd FROM g
  WINDOW f AS (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 30 PRECEDING AND 29 FOLLOWING))
SELECT event_type, ts, round(value, 6) AS value, coalesce(abs((value - mu) / nullif(sd, 0)) > 3.5, false) AS is_anomaly FROM w""")
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    return rounded(workflows.prepare(rows, KEY, "ts", ["value"], order=["event_id"], freq="1h").select("event_type", "ts", "value", "is_anomaly"), "value")


def _whole_preparation(spark, sf, out=None):
    """Every event twice, a third of the values missing in one column, names that the validation rules know."""
    e = table(spark, sf, "events").select("event_id", "event_type", "ts", "value", F.col("value").alias("heart_rate"),
                                          F.when(F.col("event_id") % 3 > 0, F.col("value") - 5).alias("steps"))
    return workflows.prepare_and_report(e.unionByName(e), KEY, numeric=["value"], order=["event_id"], freq="1h", out=out)


@query("G1_prepare_profile", """WITH e AS (SELECT event_id, event_type, ts, value, value AS heart_rate, CASE WHEN event_id % 3 > 0 THEN value - 5 END AS steps FROM events),
u AS (SELECT * FROM e UNION ALL SELECT * FROM e),
c AS (SELECT 'event_id' AS "column", 'bigint' AS dtype, count(event_id) AS k, min(event_id)::DOUBLE AS lo, max(event_id)::DOUBLE AS hi FROM u
 UNION ALL SELECT 'event_type', 'string', count(event_type), NULL, NULL FROM u UNION ALL SELECT 'ts', 'timestamp_ntz', count(ts), NULL, NULL FROM u
 UNION ALL SELECT 'value', 'double', count(value), min(value), max(value) FROM u UNION ALL SELECT 'heart_rate', 'double', count(heart_rate), min(heart_rate), max(heart_rate) FROM u
 UNION ALL SELECT 'steps', 'double', count(steps), min(steps), max(steps) FROM u)
SELECT "column", dtype, (n - k)::BIGINT AS missing_count, k::BIGINT AS present_count, round((n - k) / n::DOUBLE * 100, 2) AS missing_pct, lo AS min_value, hi AS max_value
FROM c, (SELECT count(*) AS n FROM u)""")
def _(spark, sf):
    return _whole_preparation(spark, sf)["profile"]


@query("G1_prepare_summary", PREPARE_SQL + """, t AS (SELECT count(*) AS n, count(*) FILTER (event_id % 3 = 0) AS m FROM events)
SELECT 'ts' AS timestamp_column, (2 * n)::BIGINT AS n_rows, 6::BIGINT AS n_columns, n::BIGINT AS duplicates, (2 * m)::BIGINT AS missing_cells, n::BIGINT AS rows_kept,
  (SELECT count(*) FROM g)::BIGINT AS rows_written FROM t""")
def _(spark, sf):
    return _whole_preparation(spark, sf)["summary"]


@query("G1_prepare_issues", """SELECT 'heart_rate' AS "column", 'heart_rate outside plausible range (30-220)' AS issue, (2 * count(*) FILTER (value < 30 OR value > 220))::BIGINT AS n FROM events
UNION ALL SELECT 'steps', 'negative steps', (2 * count(*) FILTER (event_id % 3 > 0 AND value - 5 < 0))::BIGINT FROM events""")
def _(spark, sf):
    return _whole_preparation(spark, sf)["issues"]


@query("G1_prepare_written", PREPARE_SQL + " SELECT event_type, ts, round(value, 6) AS value FROM g")
def _(spark, sf):
    return rounded(_whole_preparation(spark, sf, staging_path(spark, "prepared-csv"))["rows"].select("event_type", "ts", "value"), "value")


@query("G2_preprocess", """SELECT doc_id, TIMESTAMP '2024-01-01' + doc_id * INTERVAL 1 MINUTE AS timestamp, metric, source_column, value FROM (
 SELECT d.doc_id, 'metric_1' AS metric, 'quality' AS source_column, coalesce(quality::DOUBLE, (SELECT median(quality) FROM labels)) AS value FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
 UNION ALL SELECT d.doc_id, 'metric_2', 'toxic', coalesce(toxic::DOUBLE, (SELECT median(toxic) FROM labels)) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    minute = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("doc_id").cast("int"))
    out = workflows.preprocess(docs.withColumn("created_at", minute.cast("string")), metrics=["quality", "toxic"])
    return _with_doc(out)


def _with_doc(long):
    """The row number is recovered from its minute, as the long format carries only the time."""
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    ts = F.col("timestamp").cast("timestamp_ntz")
    return long.withColumn("timestamp", ts).withColumn(
        "doc_id", F.timestamp_diff("MINUTE", base.cast("timestamp"), F.col("timestamp").cast("timestamp")).cast("bigint"))


@query("G3_clean_resample", HOURLY.replace("avg(value)", "avg(k)").replace("FROM events", "FROM (SELECT *, json_extract(props, '$.k')::DOUBLE AS k FROM events)")
       + " SELECT event_type, ts, round(value, 6) AS k FROM g")
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("string").alias("ts"), F.get_json_object("props", "$.k").alias("k"))
    out = workflows.clean_resample(rows, KEY, "ts", ["k"], "1h", order=["event_id"])
    return rounded(out.select("event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "k"), "k")


RULES_AND_RESIDUAL = """, rl AS (SELECT *, sum((value > 60)::INT) OVER w >= 3 AND event_type = 'click' AS hi, sum((value < 5)::INT) OVER w >= 3 AND event_type = 'click' AS lo,
   (value > 150 OR value < 2) AND event_type = 'error' AS now FROM g WINDOW w AS (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
t AS (SELECT *, avg(value) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING) AS trend FROM g),
s AS (SELECT event_type, pos % 24 AS slot, avg(value - trend) AS seasonal FROM t GROUP BY 1, 2),
p AS (SELECT t.event_type, t.ts, t.pos, t.value, trend + seasonal AS predicted, value - trend - seasonal AS residual FROM t JOIN s ON t.event_type = s.event_type AND t.pos % 24 = s.slot),
z AS (SELECT event_type, stddev_pop(residual) AS sd, avg(residual) AS mu FROM p GROUP BY 1)"""


@query("G5_threshold_and_residual", HOURLY + RULES_AND_RESIDUAL + """
SELECT p.event_type, p.ts, hi OR lo OR now AS threshold_anomaly, abs(residual - mu) > 3 * sd OR p.value > predicted + 1.96 * sd OR p.value < predicted - 1.96 * sd AS residual_anomaly
FROM p JOIN z USING (event_type) JOIN rl ON p.event_type = rl.event_type AND p.pos = rl.pos""")
def _(spark, sf):
    rules = (EVENT_RULES[0], EVENT_RULES[2])
    g = hourly(spark, sf)
    flagged = detect.threshold_rules(g, KEY, "event_type", "value", rules)
    dec = trend.decompose(g, KEY, "value", period=24).select("event_type", "pos", "predicted", "yhat_lower", "yhat_upper")
    joined = flagged.join(dec, ["event_type", "pos"], "left")
    return detect.residual_band(joined, KEY, "value").select("event_type", "ts", "threshold_anomaly", "residual_anomaly")


@query("G6_ensemble", VOTE_SQL + """ SELECT event_type, ts, round(value, 6) AS value, anomaly_threshold, anomaly_trend, is_outlier, anomaly_score, anomaly_score >= 2 AS final_anomaly FROM vt""")
def _(spark, sf):
    return rounded(_voted(spark, sf).select("event_type", "ts", "value", "anomaly_threshold", "anomaly_trend", "is_outlier", "anomaly_score", "final_anomaly"), "value")


FLAGSHIP_SQL = VOTE_SQL + """, z AS (SELECT event_type, ts, coalesce(abs((value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0)) > 3.5, false) AS rolling_anomaly FROM g
  WINDOW w AS (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 30 PRECEDING AND 29 FOLLOWING))
SELECT event_type, ts, round(value, 6) AS value, anomaly_threshold, anomaly_trend, rolling_anomaly,
  (anomaly_threshold::INT + anomaly_trend::INT + rolling_anomaly::INT) AS anomaly_score FROM vt JOIN z USING (event_type, ts)
WHERE anomaly_threshold::INT + anomaly_trend::INT + rolling_anomaly::INT >= 2"""


@query("G6_ensemble_flagged", FLAGSHIP_SQL)
def _(spark, sf):
    """Grid, fill, baseline, three detectors, vote: the flagged hours."""
    fitted = detect.rolling_zscore(hourly(spark, sf), KEY, "value")
    flagged = detect.residual_two_sigma(trend.seasonal_baseline(fitted, KEY, "ts", "value"), KEY)
    voted = vote.vote(detect.global_sigma(flagged, KEY, "value"), ["anomaly_threshold", "anomaly_trend", "rolling_anomaly"])
    return rounded(voted.filter("final_anomaly").select(
        "event_type", "ts", "value", "anomaly_threshold", "anomaly_trend", "rolling_anomaly", "anomaly_score"), "value")


REPORT_SQL = SEASONAL + """, m AS (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sv FROM g GROUP BY 1),
fl AS (SELECT event_type, residual, value > mu + 2 * sv OR value < mu - 2 * sv AS t, abs(residual) > 2 * sd AS r FROM fit JOIN m USING (event_type)),
agg AS (SELECT event_type, count(*) AS n, count(*) FILTER (t) AS t, count(*) FILTER (r) AS r, avg(residual) AS mr, stddev_pop(residual) AS sr FROM fl GROUP BY 1),
rep AS (SELECT event_type, 'threshold' AS method, t::BIGINT AS anomalies_detected, t * 100.0::DOUBLE / n AS pct, NULL::DOUBLE AS mr, NULL::DOUBLE AS sr FROM agg
 UNION ALL SELECT event_type, 'residual', r::BIGINT, r * 100.0::DOUBLE / n, mr, sr FROM agg)"""


def _report(spark, sf):
    return reports.detector_report(_voted(spark, sf), "event_type", {"threshold": "anomaly_threshold", "residual": "anomaly_trend"}, "residual")


@query("G7_detector_report", REPORT_SQL + """ SELECT event_type, method, anomalies_detected, round(pct, 6) AS anomaly_percentage,
    round(mr, 6) AS residual_mean, round(sr, 6) AS residual_std FROM rep""")
def _(spark, sf):
    return rounded(_report(spark, sf), "anomaly_percentage", "residual_mean", "residual_std")


@query("G8_summary_counts", REPORT_SQL + " SELECT event_type || '-' || method AS label, anomalies_detected FROM rep")
def _(spark, sf):
    return reports.summary_counts(_report(spark, sf), "event_type")


@query("G10_json_report", """WITH s AS (SELECT count(value)::BIGINT AS count, round(avg(value), 3) AS mean, round(stddev_samp(value), 3) AS std, round(min(value), 3) AS min,
  round(max(value), 3) AS max, round(median(value), 3) AS q50, count(*) AS n, (count(*) FILTER (value > 150))::BIGINT AS hits,
  strftime(min(ts), '%Y-%m-%d') AS start, strftime(max(ts), '%Y-%m-%d') AS stop FROM events)
SELECT n::BIGINT AS n_rows, count, mean, std, min, q50, max, hits AS total_anomalies, printf('%.2f%%', hits * 100.0 / n) AS anomaly_percentage, start, stop, hits AS threshold FROM s""")
def _(spark, sf):
    rows = table(spark, sf, "events").withColumn("hot", F.col("value") > 150)
    report = reports.json_report(rows, "ts", ["value"], {"threshold": "hot"}, "hot")
    at = lambda p: F.get_json_object("report", f"$.{p}")
    stat = lambda c: at(f"summary_statistics.value.{c}").cast("double").alias(c)
    return report.select(
        at("data_shape[0]").cast("bigint").alias("n_rows"), at("summary_statistics.value.count").cast("bigint").alias("count"),
        stat("mean"), stat("std"), stat("min"), stat("q50"), stat("max"), at("anomaly_summary.total_anomalies").cast("bigint").alias("total_anomalies"),
        at("anomaly_summary.anomaly_percentage").alias("anomaly_percentage"), at("date_range.start").alias("start"), at("date_range.end").alias("stop"),
        at("anomaly_summary.breakdown.threshold").cast("bigint").alias("threshold"))


@query("K7_quality_band", """SELECT event_id, CASE WHEN value / 100 > 0.6 AND value / 60 < 0.8 THEN 'Excellent' WHEN value / 100 > 0.4 AND value / 60 < 1.2 THEN 'Good'
    WHEN value / 100 > 0.2 AND value / 60 < 2 THEN 'Fair' ELSE 'Poor' END AS quality FROM events""")
def _(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").select("event_id", quality(v / 100, v / 60).alias("quality"))


@query("K10_eligibility", """SELECT user_id, count(*)::BIGINT AS n_rows, count(*) >= 70 AS eligible,
    CASE WHEN count(*) < 70 THEN count(*) || ' rows, 70 needed' END AS reason FROM events GROUP BY 1""")
def _(spark, sf):
    return eligibility(table(spark, sf, "events"), ["user_id"], 70)
