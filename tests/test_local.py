"""Robust decomposition by local regression against plain loops."""

import numpy as np
import pytest

from tidewatch.operators import local, trend


def line(y, w, half):
    out = []
    for i in range(len(y)):
        j = np.arange(max(0, i - half), min(len(y), i + half + 1))
        d = (j - i) / (half + 1)
        k = (1 - np.abs(d) ** 3) ** 3 * w[j]
        a, b = np.polynomial.polynomial.polyfit(d, y[j], 1, w=np.sqrt(k)) if len(j) > 1 else (y[i], 0)
        out.append(a)
    return np.array(out)


def plain(y, period, rounds=3):
    slot, season, w = np.arange(len(y)) % period, np.zeros(len(y)), np.ones(len(y))
    for turn in range(rounds + 1):
        if turn == 0:
            trend = np.array([np.median(y[max(0, i - period // 2): i + period // 2 + 1]) for i in range(len(y))])
            season = np.array([np.median((y - trend)[slot == s]) for s in slot])
        else:
            trend = line(y - season, w, local.half_width(period))
            season = np.array([np.average((y - trend)[slot == s], weights=w[slot == s]) for s in slot])
        r = np.abs(y - trend - season)
        u = r / 6 / np.median(r)
        w = np.maximum(np.where(u < 1, (1 - u * u) ** 2, 0), 0.001)
    return trend, season


def series(n, seed):
    rnd = np.random.default_rng(seed)
    y = 50 + np.arange(n) * 0.02 + 8 * np.sin(np.arange(n) * 2 * np.pi / 24) + rnd.normal(size=n)
    y[rnd.choice(n, n // 40 + 1, replace=False)] += 300
    return y


@pytest.mark.parametrize("period, chunk", [(24, 50), (120, 150)])
def test_chunks_of_two_series_match_loops(spark, period, chunk):
    sets = {"a": series(500, 1), None: series(420, 2)}
    df = spark.createDataFrame([(k, i, float(v)) for k, y in sets.items() for i, v in enumerate(y)], "k string, pos long, v double")
    got = local.local_decompose(df, ["k"], "v", period=period, chunk_rows=chunk).toPandas()
    assert got.columns.tolist() == ["k", "pos", "v", "trend", "seasonal", "predicted", "residual", "yhat_lower", "yhat_upper"]
    for k, y in sets.items():
        mine = got[got.k.isna() if k is None else got.k == k].sort_values("pos")
        trend, season = plain(y, period)
        np.testing.assert_allclose(mine.trend, trend, rtol=1e-6)
        np.testing.assert_allclose(mine.seasonal, season, rtol=1e-5, atol=1e-5)


def test_outliers_leave_no_trace_and_missing_values_no_weight(spark):
    noise = np.random.default_rng(1).normal(size=300)
    y = 20 + np.arange(300) * 0.1 + 5 * (np.arange(300) % 24 == 3)
    spiked = y.copy()
    spiked[[40, 41, 150]] = 900.0
    rows = [(i, None if i == 77 else float("nan") if i == 78 else float(v + noise[i])) for i, v in enumerate(spiked)]
    got = local.local_decompose(spark.createDataFrame(rows, "pos long, v double"), [], "v", period=24).orderBy("pos").toPandas()
    assert np.abs(got.predicted - y).max() < 1.5 and got.residual.isna().sum() == 2
    assert set(got[got.residual.abs() > 100].pos) == {40, 41, 150}


def test_short_constant_and_empty_series(spark):
    df = spark.createDataFrame([("one", 0, 4.0), *[("flat", i, 2.5) for i in range(9)]], "k string, pos long, v double")
    got = local.local_decompose(df, ["k"], "v").toPandas()
    assert np.allclose(got.predicted, got.v) and np.allclose(got.yhat_upper, got.v) and len(got) == 10
    assert local.local_decompose(df.filter("k = 'none'"), ["k"], "v").count() == 0


def test_baseline_of_predictions(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(series(200, 3))], "k string, pos long, v double") \
        .selectExpr("k", "pos", "timestamp_seconds(pos * 3600) AS ts", "v")
    got = trend.predict(df, ["k"], "ts", "v", "local", period=24).toPandas()
    assert len(got) == 200 and got.yhat.notna().all() and (got.yhat_lower < got.yhat_upper).all()
