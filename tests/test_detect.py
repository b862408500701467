"""Rules, residual detectors, votes and trend fits on hand-made series."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import detect, trend, vote
from tidewatch.plans import reports, workflows
from tidewatch.sources import arrays, readers, roles, writers
from tidewatch.operators import profile

T0 = dt.datetime(2024, 1, 1)


def minutes(spark, metric, values):
    return spark.createDataFrame([(metric, i, T0 + dt.timedelta(minutes=i), float(v)) for i, v in enumerate(values)],
                                 "metric string, pos long, ts timestamp_ntz, v double")


def test_sustained_rule_fires_from_the_tenth_row(spark):
    values = [70] * 5 + [150] * 9 + [70] + [150] * 12 + [35] * 11
    out = detect.threshold_rules(minutes(spark, "heart_rate", values), ["metric"], "metric", "v", chunk_rows=10).orderBy("pos").collect()
    assert [r.pos for r in out if r.threshold_severity == "high"] == [24, 25, 26]
    assert [r.pos for r in out if r.threshold_severity == "medium"] == [36, 37]
    assert out[24].threshold_reason == "heart_rate > 120 (sustained)" and out[36].threshold_reason == "heart_rate < 40 (sustained)"
    assert out[0].threshold_reason == "" and out[0].threshold_severity == "normal"


def test_immediate_rule_and_metric_without_rule(spark):
    out = detect.threshold_rules(minutes(spark, "sleep", [100, 400, 800]), ["metric"], "metric", "v").orderBy("pos").collect()
    assert [(r.threshold_reason, r.threshold_severity) for r in out] == [
        ("duration_minutes < 180", "high"), ("", "normal"), ("duration_minutes > 720", "medium")]
    assert not any(r.threshold_anomaly for r in detect.threshold_rules(minutes(spark, "other", [1e9] * 20), ["metric"], "metric", "v").collect())


def test_severity_bands_close_on_the_right(spark):
    rows = [("heart_rate", 2.5), ("heart_rate", 3.5), ("heart_rate", 3.6), ("sleep", 2.9), ("sleep", 3.0), ("sleep", 4.5), ("steps", 4.6), ("steps", 0.0)]
    out = spark.createDataFrame(rows, "m string, s double").withColumn("x", detect.severity(F.col("m"), F.col("s"))).collect()
    assert [r.x for r in out] == ["Low", "Medium", "High", "Low", "Low", "Medium", "High", None]


def test_low_severity_only_where_the_cut_is_below_the_band(spark):
    """An anomaly can be Low only for a metric whose cut lies below its Low band: sleep."""
    from tidewatch.functions.constants import RESIDUAL_CUTS, SEVERITY_BANDS, SEVERITY_BANDS_DEFAULT

    assert [m for m, cut in RESIDUAL_CUTS.items() if cut < SEVERITY_BANDS.get(m, SEVERITY_BANDS_DEFAULT)[0]] == ["sleep"]


def test_constant_series_is_never_anomalous(spark):
    df = minutes(spark, "steps", [5] * 30)
    assert detect.rolling_zscore(df, ["metric"], "v", 5).filter("rolling_anomaly").count() == 0
    assert detect.global_sigma(df, ["metric"], "v").filter("anomaly_threshold").count() == 0
    flat = df.withColumn("residual", F.lit(0.0))
    assert detect.residual_scores(flat, ["metric"], "metric").filter("residual_anomaly").count() == 0


def test_residual_band_fills_missing_predictions(spark):
    df = spark.createDataFrame([("a", 0, 1.0, None, None, None), ("a", 1, 1.2, 1.0, 0.5, 1.5), ("a", 2, 9.0, None, None, None)],
                               "k string, pos long, v double, predicted double, yhat_lower double, yhat_upper double")
    out = detect.residual_band(df, ["k"], "v").orderBy("pos").collect()
    assert [r.predicted for r in out] == [1.0, 1.0, 1.0]
    assert [(r.yhat_lower, r.yhat_upper) for r in out] == [(0.0, 2.0), (0.5, 1.5), (0.0, 2.0)]
    assert [r.residual_anomaly for r in out] == [False, False, True]


def test_votes(spark):
    rows = [(True, True, None), (True, False, False), (False, False, False), (True, True, True)]
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean")
    assert [(r.anomaly_score, r.final_anomaly) for r in vote.vote(df, ["a", "b", "c", "absent"]).collect()] == [(2, True), (1, False), (0, False), (3, True)]
    assert [r.final_anomaly for r in vote.vote(df, ["a", "b", "c"], policy="any").collect()] == [True, True, False, True]
    with pytest.raises(ValueError):
        vote.vote(df, ["a"], policy="most")


def test_evaluation_of_the_known_confusion(spark):
    rows = [(True, True)] * 8 + [(False, True)] * 6 + [(False, False)] * 76
    r = vote.evaluate(spark.createDataFrame(rows, "t boolean, f boolean"), "t", "f").first()
    assert (r.tp, r.fp, r.fn, r.tn) == (8, 6, 0, 76) and round(r.precision, 3) == 0.571 and r.recall == 1.0


def seasonal_values(n=24 * 60):
    rng = np.random.default_rng(0)
    h = np.arange(n)
    return 60 + 0.01 * h + 8 * np.sin(2 * np.pi * h / 24) + rng.normal(0, 1, n)


def hourly(spark, values, key="a"):
    return spark.createDataFrame([(key, i, T0 + dt.timedelta(hours=i), float(v)) for i, v in enumerate(values)],
                                 "k string, pos long, ts timestamp_ntz, v double")


def test_both_baselines_follow_trend_and_season(spark):
    values = seasonal_values()
    values[500] += 40
    df = hourly(spark, values)
    for fitted in (trend.seasonal_baseline(df, ["k"], "ts", "v"), trend.fourier_baseline(df, ["k"], "ts", "v")):
        p = fitted.orderBy("ts").toPandas()
        assert 0.7 < p.residual.std() < 2.2
        assert abs(p.residual_std - p.residual.std()).max() < 1e-6
        assert p.residual.abs().idxmax() == 500
        flagged = detect.residual_two_sigma(fitted, ["k"]).filter("anomaly_trend").select("ts").collect()
        assert any(r.ts == T0 + dt.timedelta(hours=500) for r in flagged)


def test_fourier_forecast_continues_the_season(spark):
    out = trend.fourier_baseline(hourly(spark, seasonal_values()), ["k"], "ts", "v", hours=24).filter("v is null").orderBy("ts").toPandas()
    h = np.arange(24 * 60, 24 * 60 + 24)
    assert len(out) == 24
    assert np.abs(out.yhat - (60 + 0.01 * h + 8 * np.sin(2 * np.pi * h / 24))).max() < 2.5


def test_sparse_minimum_against_small_steps():
    """The searched minimum is where small proximal steps end, and is exactly zero where they are."""
    rng = np.random.default_rng(2)
    for _ in range(20):
        x = rng.normal(size=(60, 12)) @ rng.normal(size=(12, 12))
        y = x[:, :4] @ rng.normal(size=4) + rng.normal(size=60)
        xx, xy = x.T @ x, x.T @ y
        quadratic, absolute = np.full(12, 0.5), np.where(np.arange(12) < 3, 0.0, 40.0)
        got = trend._sparse(xx, xy, quadratic, absolute)
        g = xx + np.diag(quadratic)
        slope = xy - g @ got
        assert (np.abs(slope[absolute == 0]) < 1e-6).all() and (np.abs(slope) <= absolute + 1e-6).all()
        off = got != 0
        assert np.allclose(slope[off], absolute[off] * np.sign(got[off]), atol=1e-6)


def test_a_bend_is_found_and_the_rest_stays_straight(spark):
    h = np.arange(60 * 24)
    values = 50 + np.where(h < 700, 0.02 * h, 14.0 - 0.05 * (h - 700)) + np.random.default_rng(3).normal(0, 0.3, len(h))
    fit = trend.fourier_fit(hourly(spark, values), ["k"], "ts", "v").first()
    change = np.array(fit._coef[2:27])
    assert (change == 0).sum() >= 15 and change.sum() < 0
    where = (np.abs(change) * (np.arange(1, 26) * 0.8 / 25)).sum() / np.abs(change).sum()
    assert abs(where - 700 / len(h)) < 0.05
    out = trend.fourier_baseline(hourly(spark, values), ["k"], "ts", "v", hours=240).filter("v is null").orderBy("ts").toPandas()
    width = (out.yhat_upper - out.yhat_lower).to_numpy()
    assert (np.diff(width) > 0).all() and width[-1] > 1.5 * width[0]


def test_short_series_take_the_decomposition(spark):
    df = hourly(spark, [1.0, 2.0, 3.0, 2.0, 1.0]).unionByName(hourly(spark, seasonal_values(240), "b"))
    p = trend.predict(df, ["k"], "ts", "v", "seasonal").toPandas()
    assert len(p) == 245 and p.yhat.notna().all()


@pytest.mark.parametrize("n", [5, 50, 101])
def test_decomposition_of_short_series_matches_a_loop(spark, n):
    values = np.random.default_rng(n).normal(size=n)
    got = trend.decompose(hourly(spark, values), ["k"], "v").orderBy("pos").toPandas()
    period = max(3, n // 2)
    tr = np.array([values[max(0, i - period // 2):i + (period - 1) // 2 + 1].mean() for i in range(n)])
    season = [np.mean((values - tr)[s::period]) for s in range(period)]
    np.testing.assert_allclose(got.predicted, tr + [season[i % period] for i in range(n)], rtol=1e-9)


def test_roles_and_typing(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "x", 1, 2.0), ("junk", "y", 2, 3.0), ("2024-01-03 00:00:00", "z", 3, 4.0)],
                               "logged string, name string, resting_hr int, step_count double")
    assert roles.timestamp_column(df) == "logged"
    assert roles.timestamp_column(df.select("name", "resting_hr")) is None
    assert roles.timestamp_column(df.withColumnRenamed("name", "update_time"), "substring") == "update_time"
    parsed = roles.parse_times(df, "logged")
    assert parsed.count() == 2
    assert roles.metric_of(["resting_hr", "step_count", "walk_m", "kcal", "x"]) == [
        ("heart_rate", "resting_hr"), ("steps", "step_count"), ("steps", "walk_m"), ("metric_1", "kcal"), ("metric_2", "x")]


def test_unknown_format_is_an_error(spark):
    with pytest.raises(ValueError):
        readers.read_table(spark, "/tmp/readings.xlsx")


def test_json_array_of_records(spark, tmp_path):
    path = tmp_path / "readings.json"
    path.write_text('[{"timestamp": "2024-01-01 00:00:00", "heart_rate": 70}, {"timestamp": "2024-01-01 00:10:00", "heart_rate": 72}]')
    assert readers.read_table(spark, str(path)).agg(F.sum("heart_rate")).first()[0] == 142


def test_validation_uses_the_real_range(spark):
    df = spark.createDataFrame([(1, 29.0, 5.0), (2, 30.0, -1.0), (3, 220.0, 0.0), (4, 221.0, 1.0), (5, None, None)], "id int, heart_rate double, steps double")
    assert sorted((r.id, r.column) for r in profile.validate(df, ["id"]).collect()) == [(1, "heart_rate"), (2, "steps"), (4, "heart_rate")]


def test_preprocess_makes_times_and_keeps_both_columns_of_a_metric(spark):
    df = spark.createDataFrame([(1, 60.0, 61.0), (2, None, 71.0), (3, 80.0, 81.0)], "id int, heart_a double, heart_b double")
    out = workflows.preprocess(df, order=["id"], metrics=["heart_a", "heart_b"]).orderBy("source_column", "timestamp").collect()
    assert [(r.metric, r.source_column, r.value) for r in out][:3] == [("heart_rate", "heart_a", v) for v in (60.0, 70.0, 80.0)]
    assert out[1].timestamp == dt.datetime(2024, 1, 1, 0, 1)


def test_single_file_needs_a_timestamp(spark):
    with pytest.raises(ValueError):
        workflows.parse_single_file(spark.createDataFrame([(1.0,)], "heart_rate double"))


def test_health_report_lines(spark):
    out = reports.health_report(spark.createDataFrame([("heart_rate", 3, 4, 31), ("sleep", 0, 0, 31)], "metric string, anomalies long, patterns long, features long"))
    rows = {r.metric: r for r in out.collect()}
    assert rows["heart_rate"].recommendation == "Heart Rate: Review 3 detected anomalies for potential health concerns"
    assert rows["sleep"].recommendation == "Sleep: Patterns appear normal and healthy"
    assert (rows[None].metrics, rows[None].anomalies, rows[None].patterns, rows[None].features) == (2, 3, 1, 62)


@pytest.mark.parametrize("share", ["128m", "64", "7"])
def test_json_arrays_are_read_in_shares(spark, tmp_path, share):
    """Any cut of the file gives the same records: signs and escapes in strings, nested arrays, several files, no array at all."""
    rnd = random.Random(5)
    texts = ["plain", "}", "{", "],[", '"', '\\"', "\\\\", 'a"}\\', "ü }{ é", "line\nbreak", ""]
    rows = [{"id": i, "a": rnd.choice(texts), "b": {"c": [rnd.choice(texts), "x"], "d": [[{"e": i}], []]}} for i in range(60)]
    (tmp_path / "one.json").write_text("\n  [" + ",\n ".join(json.dumps(r, ensure_ascii=False) for r in rows[:40]) + " ]\n", encoding="utf-8")
    (tmp_path / "two.json").write_text(json.dumps(rows[40:58], indent=1))
    (tmp_path / "three.json").write_text(json.dumps(rows[58]))
    (tmp_path / "four.json").write_text("[]")
    (tmp_path / "five.json").write_text("[" + json.dumps(rows[59]) + ', {"id": 99, "a": "cut')
    was = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", share)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = sorted((json.loads(r.record) for r in arrays.array_records(spark, str(tmp_path)).collect()), key=lambda r: r["id"])
        assert got == rows
        if share == "64":
            assert arrays._pieces(spark, str(tmp_path)).select("file", "block").distinct().count() > 50
            table = readers.read_table(spark, str(tmp_path), fmt="json")
            assert table.agg(F.count("id"), F.sum("id")).first()[:] == (60, sum(range(60))) and "STRUCT" in table.schema["b"].dataType.simpleString().upper()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was[0])
        spark.conf.set("spark.sql.files.openCostInBytes", was[1])


def test_json_arrays_of_any_length_have_bounded_shares(spark, tmp_path, monkeypatch):
    """One file of one array, written in no order and with no smallest row; no share has more than eight pieces, no task more than a few shares."""
    rows = spark.range(0, 300, 1, 7).select(F.when(F.col("id") % 9 > 0, F.col("id")).alias("id"), F.format_string('%d }],{[ " ', "id").alias("note"))
    path = str(tmp_path / "one.json")
    writers.write_json_array(rows, path)
    assert len(list((tmp_path / "one.json").glob("part-*"))) == 1
    monkeypatch.setattr(arrays, "SHARE_BITS", 3)
    pieces = arrays._pieces(spark, path)
    sizes = [r["count"] for r in pieces.groupBy("file", "block").count().collect()]
    assert sum(sizes) > 600 and max(sizes) <= 8 and pieces.rdd.getNumPartitions() * arrays.SHARES >= len(sizes) > 70
    assert sorted(map(str, readers.read_table(spark, path, rows.schema).collect())) == sorted(map(str, rows.collect()))
    writers.write_json_array(rows.limit(0), str(tmp_path / "none.json"))
    assert readers.read_table(spark, str(tmp_path / "none.json"), rows.schema).count() == 0
