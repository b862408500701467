"""Grids, fills, windows and positions against pandas on small frames, with chunks of a few rows."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import clean, features, grid, rolling, stats
from tidewatch.operators.fill import fill_gaps
from tidewatch.operators.quantile import exact_quantiles
from tidewatch.plans import workflows
from tidewatch.plans.chunks import moving_mean, over_rows, with_position

T0 = dt.datetime(2024, 1, 1)


def series(spark, values, key="a"):
    return spark.createDataFrame([(key, i, None if v is None else float(v)) for i, v in enumerate(values)], "k string, pos long, v double")


def column(df, c, order="pos"):
    return [r[c] for r in df.orderBy(order).collect()]


def irregular(spark, seed=0, n=400):
    rng = np.random.default_rng(seed)
    secs = np.sort(rng.choice(86_400 * 5, n, replace=False))
    keys = np.where(rng.random(n) < 0.7, "hot", "cold")  # one series holds most rows
    vals = [None if rng.random() < 0.2 else float(np.round(rng.normal(50, 10), 3)) for _ in range(n)]
    return [(str(k), int(i), T0 + dt.timedelta(seconds=int(s)), v) for i, (k, s, v) in enumerate(zip(keys, secs, vals))]


SCHEMA = "k string, id long, ts timestamp_ntz, v double"


@pytest.mark.parametrize("method,pandas_fill", [
    ("interpolate", lambda s: s.interpolate("linear")),
    ("interpolate_both", lambda s: s.interpolate("linear", limit_direction="both")),
    ("chain", lambda s: s.interpolate("linear").bfill().ffill()),
    ("ffill", lambda s: s.ffill()), ("bfill", lambda s: s.bfill()), ("zero", lambda s: s.fillna(0.0))])
@pytest.mark.parametrize("rows", [3, 1 << 16])
def test_fills_match_pandas(spark, method, pandas_fill, rows):
    values = [None, None, 1.0, None, None, None, 4.0, 5.0] + [None] * 9 + [10.0, None, None]
    want = pandas_fill(pd.Series(values, dtype=float))
    got = column(fill_gaps(series(spark, values), ["k"], "pos", ["v"], method, chunk_rows=rows), "v")
    assert [None if pd.isna(w) else round(w, 9) for w in want] == [None if g is None else round(g, 9) for g in got]


def test_fill_of_empty_and_all_null_series(spark):
    assert column(fill_gaps(series(spark, [None, None]), ["k"], "pos", ["v"], "chain"), "v") == [None, None]
    assert column(fill_gaps(series(spark, []), ["k"], "pos", ["v"], "chain"), "v") == []
    with pytest.raises(ValueError):
        fill_gaps(series(spark, [1.0]), ["k"], "pos", ["v"], "cubic")


@pytest.mark.parametrize("rows", [5, 1 << 16])
@pytest.mark.parametrize("freq,pandas_freq", [("1h", "1h"), ("30min", "30min"), ("1D", "1D"), ("5T", "5min")])
def test_resample_matches_pandas(spark, rows, freq, pandas_freq):
    data = irregular(spark)
    pdf = pd.DataFrame(data, columns=["k", "id", "ts", "v"])
    got = grid.resample_mean(spark.createDataFrame(data, SCHEMA), ["k"], "ts", "v", freq, "chain", chunk_rows=rows).toPandas()
    got = got.sort_values(["k", "ts"]).reset_index(drop=True)
    want = []
    for k, d in pdf.groupby("k"):
        s = d.set_index("ts").v.astype(float).resample(pandas_freq).mean().interpolate("linear").bfill().ffill()
        want.append(pd.DataFrame({"k": k, "ts": s.index, "pos": range(len(s)), "v": s.values}))
    want = pd.concat(want).sort_values(["k", "ts"]).reset_index(drop=True)
    assert (got.ts == want.ts).all() and (got.pos == want.pos).all()
    np.testing.assert_allclose(got.v, want.v, rtol=1e-12)


def test_weekly_label_is_the_closing_sunday(spark):
    days = ["2024-01-07 23:59:59", "2024-01-08 00:00:00", "2024-01-21 12:00:00"]
    df = spark.createDataFrame([("a", d, 1.0) for d in days], "k string, ts string, v double").withColumn("ts", F.to_timestamp_ntz("ts"))
    out = grid.resample_sum(df, ["k"], "ts", "v", "1W").orderBy("ts").collect()
    assert [(r.ts.strftime("%m-%d"), r.v) for r in out] == [("01-07", 1.0), ("01-14", 1.0), ("01-21", 1.0)]


def test_empty_bins_of_a_sum_are_zero_and_types_keep(spark):
    df = spark.createDataFrame([("a", T0, 2.0), ("a", T0 + dt.timedelta(minutes=16), 3.0)], "k string, ts timestamp, v double")
    out = grid.resample_sum(df, ["k"], "ts", "v", "5min", chunk_rows=2)
    assert dict(out.dtypes)["ts"] == "timestamp"
    assert column(out, "v") == [2.0, 0.0, 0.0, 3.0]
    with pytest.raises(ValueError):
        grid.resample_sum(df, ["k"], "ts", "v", "7min")


def test_conform_starts_at_the_first_reading(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    df = spark.createDataFrame([("a", at(30), 1.0), ("a", at(90), 2.0), ("a", at(100), 9.0), ("a", at(270), 3.0)], "k string, ts timestamp_ntz, v double")
    out = grid.conform(df, ["k"], "ts", ["v"]).orderBy("pos")
    assert [(r.ts, r.v) for r in out.collect()] == [(at(30), 1.0), (at(90), 2.0), (at(150), None), (at(210), None), (at(270), 3.0)]


@pytest.mark.parametrize("rows", [16, 1 << 16])
@pytest.mark.parametrize("window", [5, 6, 7])
def test_centered_and_trailing_windows_match_pandas(spark, rows, window):
    values = list(np.random.default_rng(1).normal(size=50))
    df, s = series(spark, values), pd.Series(values)
    out = rolling.centered_stats(df, ["k"], "v", window, chunk_rows=rows)
    np.testing.assert_allclose(column(out, "center_mean"), s.rolling(window, min_periods=1, center=True).mean(), rtol=1e-9)
    np.testing.assert_allclose(column(out, "center_std"), s.rolling(window, min_periods=1, center=True).std(ddof=0), atol=1e-9)
    back = rolling.trailing_stats(df, ["k"], "v", window, chunk_rows=rows)
    std = column(back, f"roll_std_{window}")
    assert std[0] is None
    np.testing.assert_allclose(std[1:], s.rolling(window, min_periods=1).std()[1:], rtol=1e-9)


@pytest.mark.parametrize("rows", [24, 1 << 16])
def test_moving_mean_equals_the_window(spark, rows):
    values = [None if i % 7 == 3 else float(i * i % 13) for i in range(100)]
    df = series(spark, values)
    fast = moving_mean(df, ["k"], "pos", "v", "m", 12, 11, chunk_rows=rows)
    slow = over_rows(df, ["k"], "pos", {"m": lambda w: F.avg("v").over(w.rowsBetween(-12, 11))}, 12, 11)
    np.testing.assert_allclose(column(fast, "m"), column(slow, "m"), rtol=1e-12)


@pytest.mark.parametrize("rows", [4, 1 << 16])
def test_sustained_needs_k_rows(spark, rows):
    high = [0, 1, 1, 0, 1, 1, 1, 1, 0, 1]
    out = rolling.sustained(series(spark, [float(h) for h in high]), ["k"], {"hit": F.col("v") > 0.5}, 3, chunk_rows=rows)
    assert column(out, "hit") == [False] * 6 + [True, True, False, False]


@pytest.mark.parametrize("n", [4, 5, 6, 23, 60, 61, 89, 90])
@pytest.mark.parametrize("size", [5, 6, 60])
def test_overlapping_windows_match_slicing(spark, n, size):
    step = max(1, size // 2)
    want = {(w, p) for w, s in enumerate(range(0, n - size + 1, step)) for p in range(s, s + size)}
    out = rolling.overlapping_windows(series(spark, [float(i) for i in range(n)]), ["k"], size).collect()
    assert {(r.window_id, r.pos) for r in out} == want and all(r.i == r.pos - r.window_id * step for r in out)


def test_positions_are_dense_under_skew(spark):
    data = irregular(spark, 3)
    got = with_position(spark.createDataFrame(data, SCHEMA), ["k"], ["ts", "id"]).toPandas()
    want = pd.DataFrame(data, columns=["k", "id", "ts", "v"]).sort_values(["ts", "id"])
    want["pos"] = want.groupby("k").cumcount()
    merged = got.merge(want[["id", "pos"]], on="id")
    assert len(merged) == len(data) and (merged.pos_x == merged.pos_y).all()
    whole = with_position(spark.range(1000).repartition(7), [], ["id"])
    assert whole.filter(F.col("pos") != F.col("id")).count() == 0


def test_exact_quantiles_with_copies_and_skew(spark):
    rng = np.random.default_rng(5)
    rows = [("hot", 7.0)] * 3000 + [("hot", float(v)) for v in rng.lognormal(3, 4, 6000)] + [("cold", float(i)) for i in range(10)] + [("one", 3.0)]
    qs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = {r.k: r for r in exact_quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", qs).collect()}
    for k in ("hot", "cold", "one"):
        vals = [v for kk, v in rows if kk == k]
        np.testing.assert_allclose([got[k][n] for n in qs], np.quantile(vals, list(qs.values())), rtol=1e-12)


def test_null_outliers_leaves_short_columns_alone(spark):
    df = spark.createDataFrame([("s", 0.0), ("s", 1e9)] + [("l", 1.0)] * 30 + [("l", 100.0)], "k string, v double")
    out = clean.null_outliers(df, ["v"], 4.0, ["k"])
    assert out.filter("k = 's' and v is null").count() == 0
    assert out.filter("k = 'l' and v is null").count() == 1 and out.filter("k = 'l'").count() == 31


def test_required_cells():
    assert [clean.required_present(p, 10) for p in (90, 50, 100, 5)] == [1, 5, 1, 9]


def test_standardize_constant_column(spark):
    assert column(clean.standardize(series(spark, [5.0, 5.0]), ["v"], ["k"]), "v_scaled") == [0.0, 0.0]


def test_features_of_a_constant_window(spark):
    out = features.window_features(series(spark, [2.0] * 60), ["k"], "v").collect()[0]
    assert (out["mean"], out["variance"], out["cid_ce"], out["number_peaks"], out["longest_strike_above_mean"]) == (2.0, 0.0, 0.0, 0, 0)
    assert out["autocorrelation_lag_1"] is None


def test_constant_features_are_dropped(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert features.drop_constant_features(df, ["a", "b"]).columns == ["b"]


@pytest.mark.parametrize("few", [8, 1])
def test_correlations_over_the_rows_that_have_both(spark, monkeypatch, few):
    monkeypatch.setattr(stats, "FEW_COLUMNS", few)
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(1e6, 1, 300), rng.normal(0, 1, 300), np.full(300, 3.0), np.full(300, np.nan)])
    x[:, 1] += x[:, 0] - 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) and i % 2 else float(v) for v in row) for i, row in enumerate(x)], "a double, b double, c double, d double").repartition(3)
    got = {(r.column_a, r.column_b): r.correlation for r in stats.correlation_matrix(df, list("abcd")).collect()}
    both = ~np.isnan(x[:, 0]) & ~np.isnan(x[:, 1])
    assert len(got) == 16 and got["a", "b"] == got["b", "a"] == pytest.approx(np.corrcoef(x[both, 0], x[both, 1])[0, 1], abs=1e-9)
    assert got["a", "a"] == pytest.approx(1) and got["a", "c"] is None and got["c", "c"] is None and got["d", "a"] is None
    assert stats.correlation_matrix(df.limit(0), ["a", "b"]).filter("correlation is not null").count() == 0


def test_one_call_prepares_profiles_and_writes(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("k", t0 + dt.timedelta(minutes=i), float(70 + i % 5), i) for i in range(200)] + [("k", t0, 70.0, 0)] * 3 + [("k", t0 + dt.timedelta(minutes=200), 300.0, 200), (None, None, None, None)]
    df = spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, heart_rate double, n long")
    done = workflows.prepare_and_report(df, ["series"], numeric=["heart_rate"], order=["n"], out=str(tmp_path / "out"), fmt="parquet")
    s = done["summary"].first()
    assert (s.timestamp_column, s.n_rows, s.duplicates, s.missing_cells, s.rows_kept, s.rows_written) == ("timestamp", 205, 3, 4, 201, 201)
    assert done["rows"].count() == 201 and spark.read.parquet(str(tmp_path / "out")).count() == 201
    profile = {r.column: r for r in done["profile"].collect()}
    assert (profile["heart_rate"].min_value, profile["heart_rate"].max_value, profile["heart_rate"].missing_count) == (70.0, 300.0, 1)
    assert [r.n for r in done["issues"].collect()] == [1]
    twice = workflows.prepare_and_report(df, ["series"], ts="timestamp", numeric=["heart_rate"], order=["n"], drop_duplicates=False)
    assert twice["summary"].first().rows_kept == 204
