"""Missing dates and hours, and the column checks."""

import datetime as dt

from pyspark.sql import functions as F

from helioledger.operators import coverage, quality
from helioledger.schemas import CHART_HOURS, PARSED_READINGS, RAW_TARIFFS
from tests.conftest import rows

D = dt.date


def test_gaps_at_start_middle_and_end(spark):
    present = spark.createDataFrame([(D(2026, 1, day),) for day in (3, 4, 7, 4, 30)], "date date")
    missing = coverage.missing_dates(present, D(2026, 1, 1), D(2026, 1, 9))
    assert rows(missing) == [(D(2026, 1, day),) for day in (1, 2, 5, 6, 8, 9)]
    assert coverage.newest_missing_date(missing).first()[0] == D(2026, 1, 9)
    assert [row[0].day for row in coverage.newest_first(missing).collect()] == [9, 8, 6, 5, 2, 1]


def test_default_end_is_yesterday(spark):
    none = spark.createDataFrame([], "date date")
    today = spark.sql("select current_date()").first()[0]
    missing = coverage.missing_dates(none, today - dt.timedelta(days=2))
    assert rows(missing) == [(today - dt.timedelta(days=2),), (today - dt.timedelta(days=1),)]
    assert coverage.missing_dates(none, today).count() == 0


def test_each_site_has_its_own_calendar(spark):
    present = spark.createDataFrame([(1, D(2026, 1, 1)), (2, D(2026, 1, 2))], "site_id int, date date")
    sites = spark.createDataFrame([(1,), (2,), (3,)], "site_id int")
    missing = coverage.missing_dates(present, D(2026, 1, 1), D(2026, 1, 2), ["site_id"], sites)
    assert rows(missing) == [(1, D(2026, 1, 2)), (2, D(2026, 1, 1)), (3, D(2026, 1, 1)), (3, D(2026, 1, 2))]


def test_skeleton_fills_hours_and_whole_dates(spark):
    data = [(D(2026, 1, 1), hour, 1.0, 1.0, 1.0, 1.0) for hour in CHART_HOURS if hour not in ("03:00", "23:00")]
    data += [(D(2026, 1, 1), "05:00", 2.0, 2.0, 2.0, 2.0), (D(2026, 1, 2), "09:30", 1.0, 1.0, 1.0, 1.0)]
    readings = spark.createDataFrame(data, PARSED_READINGS)
    dates = spark.createDataFrame([(D(2026, 1, 3),), (D(2026, 1, 1),)], "date date")
    full = coverage.hour_skeleton(readings, dates=dates)
    assert rows(full.filter("grid is not null")) == rows(readings)
    filled = full.filter("grid is null").groupBy("date").agg(F.sort_array(F.collect_list("hour"))).collect()
    assert {row[0].day: tuple(row[1]) for row in filled} == {1: ("03:00", "23:00"), 2: CHART_HOURS, 3: CHART_HOURS}


def test_quarters_of_an_hour(spark):
    quarters = [f"{minute // 60:02d}:{minute % 60:02d}" for minute in range(0, 1440, 15)]
    readings = spark.createDataFrame([(D(2026, 1, 1), quarters[i], 1.0, 1.0, 1.0, 1.0) for i in (0, 62, 63, 95)], PARSED_READINGS)
    full = coverage.hour_skeleton(readings, hours=quarters).collect()
    assert sorted(row["hour"] for row in full) == quarters and sum(row["grid"] is not None for row in full) == 4


def test_checks_report_and_never_fail(spark):
    tariffs = spark.createDataFrame(
        [("2026-01-01", None, None, None, "0.1", None, "0.1"), ("2026-01-01", None, None, None, "0.1", "0.1", "0.1"), (None,) * 7],
        RAW_TARIFFS,
    )
    report = {(row["column"], row["test"]): (row["failures"], row["passed"]) for row in quality.check_all({"raw_tariffs": tariffs}).collect()}
    assert report == {
        ("start_date", "not_null"): (1, False), ("off_peak_rate", "not_null"): (2, False), ("peak_rate", "not_null"): (1, False),
        ("export_rate", "not_null"): (1, False), ("start_date", "unique"): (1, False),
    }


def test_declared_checks():
    assert sum(map(len, quality.NOT_NULL.values())) == 26
    assert quality.UNIQUE == {"raw_tariffs": ("start_date",)}
