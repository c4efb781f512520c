"""Sums and the payback forecast."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from helioledger.functions import numbers
from helioledger.operators import payback, rollups
from helioledger.schemas import MEASURES
from tests.conftest import rows

COSTS = "site_id int, reading_datetime timestamp_ntz, " + ", ".join(f"{name} double" for name in MEASURES)


def costs(spark, seed=3, sites=3):
    rng = random.Random(seed)
    start = dt.datetime(2025, 11, 20)
    data = [
        (rng.randrange(sites), start + dt.timedelta(hours=rng.randrange(2400)),
         *[None if rng.random() < 0.1 else rng.randint(-500, 500) / 100 for _ in MEASURES])
        for _ in range(2000)
    ]
    return spark.createDataFrame(data, COSTS)


@pytest.mark.parametrize("keys", [(), ("site_id",)])
def test_marts_from_the_rollup_equal_marts_from_the_hours(spark, keys):
    hours = costs(spark)
    rollup = rollups.daily_rollup(hours, keys, exact=True)
    pairs = [
        (rollups.monthly_from_daily(rollup, keys, True), rollups.monthly_savings(hours, keys, True)),
        (rollups.total_from_daily(rollup, keys, True), rollups.total_savings(hours, keys, True)),
        (rollups.generation_from_daily(rollup, keys, True), rollups.total_solar_generation(hours, keys, True)),
        (rollups.data_date(rollup, keys, day="reading_date"), rollups.data_date(hours, keys)),
    ]
    for derived, direct in pairs:
        assert derived.columns == direct.columns
        assert rows(derived) == rows(direct)


def test_plain_sums_are_close_to_exact_ones(spark):
    hours = costs(spark)
    for build in (rollups.daily_rollup, rollups.monthly_savings, rollups.total_savings, rollups.total_solar_generation):
        plain, exact = build(hours, ("site_id",)), build(hours, ("site_id",), exact=True)
        first = plain.columns[1]
        key = ["site_id", first] if first in ("reading_date", "reading_month") else ["site_id"]
        for a, b in zip(plain.orderBy(*key).collect(), exact.orderBy(*key).collect()):
            assert [pytest.approx(x) if isinstance(x, float) else x for x in a] == list(b)


def test_nothing_in(spark):
    none = spark.createDataFrame([], COSTS)
    assert rows(rollups.total_savings(none)) == [(None,) * 9]
    assert rows(rollups.total_savings(none, exact=True)) == [(None,) * 9]
    assert rows(rollups.total_solar_generation(none)) == [(None, None)]
    assert rows(rollups.total_solar_generation(none, exact=True)) == [(None, None)]
    assert rows(rollups.data_date(none)) == [(None,)]
    assert rollups.daily_rollup(none).count() == 0
    assert payback.payback_forecast_current(rollups.daily_rollup(none)).count() == 0


def test_average_counts_readings_without_a_value(spark):
    hours = spark.createDataFrame([(None,), (3.0,), (3.0,)], "solar double")
    assert rows(rollups.total_solar_generation(hours)) == [(6.0, 2.0)]


def test_heat_map_grains(spark):
    hours = costs(spark, sites=1).drop("site_id")
    by_month = rollups.hourly_generation_by_month(hours, exact=True)
    assert by_month.columns == ["month", "hour", "solar"]
    again = rollups.hourly_generation_by_day(hours, exact=True).groupBy(F.trunc("day", "MM").alias("month"), "hour")
    again = again.agg(F.sum(F.col("solar").cast("decimal(28,6)")).cast("double").alias("solar"))
    assert rows(by_month) == rows(again)
    with pytest.raises(ValueError):
        rollups.hourly_generation_by_month(hours, agg="max")


def days(spark, savings):
    return spark.createDataFrame(
        [(dt.date(2026, 1, day), value) for day, value in savings], "reading_date date, total_saving double"
    )


def test_forecast_counts_days_with_data(spark):
    rollup = days(spark, [(1, 4.0), (5, 2.0)])
    found = payback.payback_forecast_development(rollup, installation_cost=100).collect()
    assert [row["day_number"] for row in found] == [1, 2]
    assert [row["cumulative_saving"] for row in found] == [4.0, 6.0]
    assert [row["average_daily_saving"] for row in found] == [4.0, 3.0]
    assert [row["payback_percentage"] for row in found] == [pytest.approx(4.0), pytest.approx(6.0)]
    assert [row["days_to_payback"] for row in found] == [25, 33]
    assert found[1]["forecast_payback_date"] == dt.datetime(2026, 1, 5) + dt.timedelta(days=33)


def test_half_days_round_to_even_and_zero_gives_no_forecast(spark):
    rollup = days(spark, [(1, 0.0), (2, 8.0), (3, -4.0), (4, -12.0)])
    found = payback.payback_forecast_development(rollup, installation_cost=10).collect()
    assert [row["days_to_payback"] for row in found] == [None, 2, 8, -5]
    assert found[0]["forecast_payback_date"] is None
    assert found[3]["forecast_payback_date"] == dt.datetime(2025, 12, 30)


def test_far_forecast_is_null_not_an_error(spark):
    rollup = days(spark, [(1, 1e-5)])
    row = payback.payback_forecast_development(rollup).select("days_to_payback", "forecast_payback_date").first()
    assert row["days_to_payback"] == 1_020_000_000 and row["forecast_payback_date"] is None


@pytest.mark.parametrize("keys", [(), ("site_id",)])
def test_current_forecast_three_ways(spark, keys):
    hours = costs(spark)
    rollup = rollups.daily_rollup(hours, keys, exact=True)
    development = payback.payback_forecast_development(rollup, keys, exact=True)
    latest = rollups.data_date(hours, keys)
    joined = payback.payback_on_data_date(development, latest, keys)
    current = payback.payback_forecast_current(rollup, keys, exact=True)
    assert joined.columns == current.columns
    assert rows(joined) == rows(current)


def test_exact_sums_keep_what_is_no_number_and_what_is_large(spark):
    data = [(1, 0.1), (1, 0.2), (2, float("nan")), (2, 1.0), (3, 9e14), (3, 9e14), (3, 0.000001), (4, 1e300), (4, 1.0), (5, None), (6, float("inf")), (7, -0.3)]
    frame = spark.createDataFrame(data * 3, "k int, v double").groupBy("k").agg(numbers.total(F.col("v"), exact=True).alias("t"))
    found = {row["k"]: row["t"] for row in frame.collect()}
    assert math.isnan(found.pop(2))
    assert found == {1: 0.9, 3: 5.4e15, 4: 3e300, 5: None, 6: float("inf"), 7: -0.9}
    again = frame.agg(numbers.total_of_totals(F.col("t"), exact=True)).first()[0]
    assert math.isnan(again)
