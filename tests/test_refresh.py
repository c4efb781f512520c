"""Refreshed marts equal built ones, and only what has changed is read and written."""

import datetime as dt
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helioledger.plans import refresh, warehouse
from helioledger.sinks import readings as sinks
from helioledger.sources import marts
from tests.conftest import rows

READING = "site_id int, date date, hour string, grid string, solar string, battery string, home string"
TARIFF = "site_id int, start_date string, end_date string, off_peak_start_hour string, off_peak_end_hour string, off_peak_rate string, peak_rate string, export_rate string"
EXCLUSION = "site_id int, start_date string, start_time string, end_date string, end_time string, exclusion_reason string"
SERVED = (marts.daily_savings, marts.monthly_savings, marts.total_savings, marts.payback_forecast, marts.payback_forecast_development, marts.data_date)


def hours(days, seed=1, sites=(1, 2)):
    rng = random.Random(seed)
    return [(s, d, f"{h:02}:00", *[f"{rng.randrange(-300, 900) / 100}" for _ in range(4)]) for s in sites for d in days for h in (0, 9, 13)]


@pytest.mark.parametrize("keys", [["site_id"], []])
def test_refreshed_equals_built(spark, tmp_path, keys):
    location, built, path = str(tmp_path / "marts"), str(tmp_path / "built"), str(tmp_path / "raw")
    name = f"raw_to_refresh_{len(keys)}"
    days = [dt.date(2026, 1, 25) + dt.timedelta(days=n) for n in range(24)]
    sites = (1, 2) if keys else (1,)
    tariffs = spark.createDataFrame([(s, "2026-01-01", "2026-12-31", "00:00", "04:00", "0.07", "0.28", "0.15") for s in sites], TARIFF)
    exclusions = spark.createDataFrame([(1, "2026-02-06", "00:00:00", "2026-02-07", "23:59:00", "outage")], EXCLUSION)
    late = [days[9], days[10]]
    sinks.create_raw_table(spark.createDataFrame(hours([d for d in days if d not in late], sites=sites), READING), name, path, ["date"])

    def check(more_exclusions=exclusions):
        found = refresh.refresh(spark.table(name), tariffs, more_exclusions, location, keys, exact=True)
        warehouse.build(spark.table(name), tariffs, more_exclusions, built, keys, exact=True)
        for read in SERVED:
            assert rows(read(spark, location, keys)) == rows(read(spark, built, keys)), read.__name__
        assert rows(marts.open_relation(spark, "total_solar_generation", location)) == rows(marts.open_relation(spark, "total_solar_generation", built))
        return found

    assert refresh.refresh(spark.table(name), tariffs, exclusions, location, keys, exact=True) is None
    assert refresh.refresh(spark.table(name), tariffs, exclusions, location, keys, exact=True) == []
    sinks.append_new_readings(spark.createDataFrame(hours(late, 2, sites), READING), name, ["site_id"])
    before = {f: f.stat().st_mtime_ns for f in Path(location, "monthly_savings").rglob("*.parquet") if "_month=2026-02" not in str(f)}
    assert check() == late
    assert before == {f: f.stat().st_mtime_ns for f in before}
    sinks.replace_days(spark.createDataFrame(hours([days[0], days[-1]], 3, sites[:1]), READING), name, ["site_id"])
    if not keys:
        assert check() == [days[0], days[-1]]
        return
    gone = [(s, days[15], None, "1", "1", "1", "1") for s in sites]  # a day of which no hour counts any more
    sinks.replace_days(spark.createDataFrame(gone, READING), name, ["site_id"])
    assert check() == [days[0], days[15], days[-1]]
    new_day = [dt.date(2026, 7, 1)]
    sinks.append_new_readings(spark.createDataFrame(hours(new_day, 4, sites), READING), name, ["site_id"])
    assert check() == new_day
    assert check(exclusions.limit(0)) is None  # other terms: every day is worth something else


def test_only_changed_days_are_read(spark, tmp_path):
    days = [dt.date(2026, 3, d) for d in range(1, 31)]
    sinks.create_raw_table(spark.createDataFrame(hours(days), READING), "raw_days_read", str(tmp_path / "raw"), ["date"])
    raw = spark.table("raw_days_read")
    plan = refresh.files_by_day(raw)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    touched = raw.filter(F.col("date").cast("date").isin(days[3:5]))
    assert touched.count() == 12  # two days of two sites
    assert re.search(r"PartitionFilters: \[[^]]*date", touched._jdf.queryExecution().executedPlan().toString())
