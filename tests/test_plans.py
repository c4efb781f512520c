"""Properties of the physical plans that matter at scale."""

import re
from types import SimpleNamespace

import pytest

import __spark_entry__ as entry
from energy_fixtures import queries
from helioledger.operators import intervals, rollups
from helioledger.session import scratch_path
from helioledger.sources import daily_json
from tests.conftest import rows

QUERIES = entry.queries()
CORE = [
    "daily_savings", "daily_savings_by_site", "solar_cleaned_by_site", "solar_cleaned_by_site_shuffled", "tariff_day_join_by_site",
    "payback_forecast_development_by_site", "payback_forecast_current_by_site", "hour_skeleton_by_site", "missing_dates_by_site",
    "label_tokens", "json_roundtrip", "dq_not_null",
]


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CORE)
def test_no_nested_loops_and_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for operator in ("NestedLoop", "CartesianProduct", "PythonUDF", "ArrowEval", "InPandas", "BatchEvalPython"):
        assert operator not in text


def test_scans_read_only_the_needed_columns(spark, small):
    text = plan(QUERIES["missing_dates_by_site"](spark, small))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == {"l_suppkey:bigint,l_shipdate:timestamp_ntz", "l_suppkey:bigint"}


def test_two_large_reference_tables_share_one_shuffle_of_the_readings(spark, small):
    text = plan(QUERIES["solar_cleaned_by_site_shuffled"](spark, small))
    assert text.count("SortMergeJoin") == 1 and text.count("Window [") == 1 and "BroadcastHashJoin" not in text
    # One for the readings with the exclusions, one for tariffs and one for the adapter's own hours.
    assert text.count("Exchange hashpartitioning") == 3


def test_small_reference_tables_leave_the_readings_in_place(spark, small):
    text = plan(QUERIES["solar_cleaned_by_site"](spark, small))
    assert text.count("BroadcastHashJoin") == 2
    # The adapter's own hours.
    assert text.count("Exchange hashpartitioning") == 1


def test_windows_are_split_by_site(spark, small):
    text = plan(QUERIES["payback_forecast_development_by_site"](spark, small))
    assert "SinglePartition" not in text and "Window" in text


def test_current_forecast_needs_no_window_and_no_join_of_days(spark, small):
    text = plan(QUERIES["payback_forecast_current_by_site"](spark, small))
    assert "Window" not in text


def test_skeleton_does_not_join_the_readings(spark, small):
    assert "Join" not in plan(QUERIES["hour_skeleton_by_site"](spark, small))


def test_scratch_is_the_folder_the_session_names(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_without_a_named_folder():
    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=SimpleNamespace(master=master))

    first, second = scratch_path(session("local[2]"), "a"), scratch_path(session("local[2]"), "a")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session("spark://host:7077"), "a")


def test_present_dates_do_not_open_files(spark, tmp_path):
    (tmp_path / "2026-01-17_data.json").write_text("x")
    text = plan(daily_json.present_dates(spark, str(tmp_path)))
    assert "ReadSchema: struct<path:string>" in text


def test_many_overlapping_tariffs_meet_by_equality(spark, small, monkeypatch):
    """Moments and tariffs are counted in windows by slot; every join is by a number or a moment, without a residual."""
    monkeypatch.setattr(intervals, "DENSE", 10)
    text = plan(QUERIES["tariffs_in_force_by_day"](spark, small))
    assert "NestedLoop" not in text and "Window [" in text
    joins = [line for line in text.splitlines() if "Join" in line]
    assert joins and not any(">=" in line or "<=" in line for line in joins)


def test_three_marts_from_one_pass(spark, small):
    text = plan(QUERIES["savings_by_level_by_site"](spark, small))
    # The adapter's own hours are the other exchange.
    assert text.count("Expand [") == 1 and text.count("Exchange hashpartitioning") == 2


def test_pairs_with_overlapping_tariffs_are_not_moved(spark, small, monkeypatch):
    """Few days go to the many tariffs; no pair of both is shuffled before it is counted."""
    monkeypatch.setattr(intervals, "DENSE", 10)
    text = plan(QUERIES["tariffs_in_force_by_day"](spark, small))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 3


def test_days_are_summed_where_the_join_dealt_their_hours(spark, small, monkeypatch):
    """Both joins, days and months take one shuffle of the hours; what is summed once is not dealt again by day."""
    monkeypatch.setattr(intervals, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(intervals, "TASK_ROWS", 1_000)
    fleet = queries.Fleet(spark, small)
    rollup = rollups.daily_rollup(queries._costs(fleet, slotted_rows=True, broadcast_bytes=0), fleet.keys, exact=True)
    text = plan(rollup)
    assert "_slot" not in rollup.columns and "REPARTITION_BY_NUM" in text
    assert not [line for line in text.splitlines() if "Exchange" in line and "reading_date#" in line]
    whole = rollups.daily_rollup(queries._costs(fleet, broadcast_bytes=0, split_above=None), fleet.keys, exact=True)
    assert rows(rollup) == rows(whole)
