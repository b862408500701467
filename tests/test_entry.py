"""The catalog against its SQL on the smallest tables, and the shape of the main plans."""

import os

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from catalog.base import KEY, nudged, table
from tidewatch.operators import grid

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
SAMPLE = ["S4_csv_sink_cleaned", "D3_synthetic_times", "P7_describe", "C6_interpolate_raw_rows", "R3_resample_mixed", "R8_parse_single_file",
          "A1_basic_features", "W5_overlapping_windows", "F20_F24_trend_and_autocorrelation", "T3_decompose_half_length", "N4_sustained_thresholds",
          "N13_reason_codes", "G1_prepare", "G6_ensemble_flagged", "X2_stream_alerts"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, queries()[name], oracle_sql()[name], SF)[0] == "ok"


def test_every_check_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_nudge_reaches_nested_rounds():
    assert nudged("round(a + coalesce(b, 6), 6), round(c, 2)") == "round((a + coalesce(b, 6)) + 1e-09::DOUBLE, 6), round((c), 2)"


def test_filled_grid_scans_once_and_never_gathers_rows(spark):
    out = grid.resample_mean(table(spark, SF, "events"), KEY, "ts", "value", "1h", "chain")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1
    assert "SinglePartition" not in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
