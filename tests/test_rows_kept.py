"""Rows without a series key, columns that only look like times, and readings at one timestamp."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewatch.operators import detect, features, grid
from tidewatch.operators.fill import fill_gaps
from tidewatch.plans.chunks import attach, with_position
from tidewatch.sources.roles import synthetic_times, timestamp_column

T0 = dt.datetime(2024, 1, 1)
ROWS = [(k, i, T0 + dt.timedelta(hours=2 * i), None if i % 3 == 1 else float(i)) for k in ("a", None) for i in range(6)]


def frame(spark):
    return spark.createDataFrame(ROWS, "k string, i long, ts timestamp_ntz, v double")


def halves(rows, *cols):
    side = lambda want: sorted(tuple(r[c] for c in cols) for r in rows if (r.k is None) == want)
    return side(False), side(True)


def test_rows_without_a_key_are_a_series(spark):
    df = frame(spark)
    placed = with_position(df, ["k"], ["i"])
    named, unnamed = halves(placed.collect(), "i", "pos", "n_rows")
    assert named == unnamed == [(i, i, 6) for i in range(6)]
    for chunk in (2, 100):
        for method in ("chain", "ffill", "bfill", "nearest"):
            named, unnamed = halves(fill_gaps(placed, ["k"], "pos", ["v"], method, chunk_rows=chunk).fillna(-1.0, ["v"]).collect(), "i", "v")
            assert named == unnamed and len(named) == 6
        named, unnamed = halves(grid.resample_mean(df, ["k"], "ts", "v", "1h", "chain", chunk_rows=chunk).collect(), "pos", "v")
        assert named == unnamed and len(named) == 11
    named, unnamed = halves(attach(df, df.groupBy("k").agg(F.max("i").alias("top")), ["k"]).collect(), "i", "top")
    assert named == unnamed and {t for _, t in named} == {5}
    wide = df.withColumns({"predicted": F.col("v"), "yhat_lower": F.lit(None).cast("double"), "yhat_upper": F.lit(None).cast("double")})
    assert detect.residual_band(with_position(wide, ["k"], ["i"]), ["k"], "v").count() == len(ROWS)


def test_two_readings_at_one_timestamp_are_told(spark):
    df = frame(spark).filter("k = 'a'")
    assert grid.conform(df, ["k"], "ts", ["v"], "1h").count() == 11
    with pytest.raises(PySparkException):
        grid.conform(df.unionByName(df.limit(1).withColumn("v", F.lit(9.0))), ["k"], "ts", ["v"], "1h").collect()


def test_a_number_with_a_hint_stays_a_metric(spark):
    df = spark.createDataFrame([(1, 7, "2024-01-01 00:00:00", "x"), (2, 8, None, "y")], "id int, sleep_time int, at string, note string")
    assert timestamp_column(df, "substring") == "at"
    assert timestamp_column(df.drop("at"), "substring") is None
    some = df.select("sleep_time", F.lit("junk").alias("note"), F.lit("2024-01-01").alias("noted"), F.lit("junk").alias("date_text"))
    assert timestamp_column(some, "substring") == "noted"
    assert timestamp_column(some.drop("noted"), "substring") == "date_text"


def test_synthetic_times_are_a_minute_apart(spark):
    row = synthetic_times(spark.range(3), ["id"]).orderBy("id").collect()
    assert [r.timestamp for r in row] == [T0 + dt.timedelta(minutes=i) for i in range(3)]


def test_entropy_and_spectrum_of_windows_of_several_lengths(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    windows = [rng.normal(size=n).tolist() for n in (5, 60, 2, 60, 30)] + [[0.0] * 8]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(windows)], "i int, w array<double>")
    got = df.select("i", features.approximate_entropy("w", F.lit(2), F.lit(0.2)).alias("e"), features.fft_centroid("w").alias("f")).orderBy("i").collect()

    def phi(x, m, tol):
        t = np.lib.stride_tricks.sliding_window_view(x, m)
        return np.log((np.abs(t[:, None] - t[None]).max(axis=2) <= tol).mean(axis=1)).mean()

    for r, w in zip(got, windows):
        x = np.array(w)
        want = 0.0 if len(x) <= 3 else abs(phi(x, 2, 0.2 * x.std()) - phi(x, 3, 0.2 * x.std()))
        a = np.abs(np.fft.rfft(x))
        assert abs(r.e - want) < 1e-12
        assert r.f is None if a.sum() == 0 else abs(r.f - (np.arange(len(a)) * a).sum() / a.sum()) < 1e-9
