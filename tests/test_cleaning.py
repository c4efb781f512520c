"""Interval joins against nested loops, and the edges of tariffs and exclusions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helioledger.operators import cleaning, intervals
from tests.conftest import rows

READING = "site_id int, reading_datetime timestamp_ntz, grid double, solar double, battery double, home double"
TARIFF = (
    "site_id int, start_date date, end_date date, off_peak_start_hour int, off_peak_end_hour int, "
    "off_peak_rate double, peak_rate double, export_rate double"
)
OUTAGE = "site_id int, start_datetime timestamp_ntz, end_datetime timestamp_ntz"

WAYS = {
    "broadcast": {},
    "by day": {"grain": "day"},
    "shuffled": {"broadcast_bytes": 0, "split_above": None},
    "split": {"broadcast_bytes": 0, "split_above": 3},
    "split by day": {"broadcast_bytes": 0, "split_above": 2, "grain": "day"},
}


def case(seed):
    rng = random.Random(seed)
    epoch = dt.datetime(2026, 1, 1)

    def moment(days=150):
        return epoch + dt.timedelta(hours=rng.randint(0, 24 * days))

    # A third of the readings are copies of one row of one site.
    hot = (0, moment(), 1.0, 2.0, 3.0, 4.0)
    readings = [
        hot if rng.random() < 0.33 else
        (rng.choice([0, 1, 2, None]), None if rng.random() < 0.05 else moment(), *[round(rng.uniform(-3, 3), 2) for _ in range(4)])
        for _ in range(250)
    ]
    tariffs = []
    for number in range(25):
        first = moment().date()
        last = None if rng.random() < 0.15 else first + dt.timedelta(days=rng.randint(-3, 60))
        tariffs.append((rng.choice([0, 1, 2, None]), first, last, rng.randint(0, 23), rng.randint(0, 23), number / 100, number / 10, 0.15))
    tariffs.append((0, dt.date(2026, 1, 1), dt.date(9999, 12, 31), 0, 4, 0.5, 0.6, 0.7))
    outages = [(rng.choice([0, 1, 2]), moment(), None) if rng.random() < 0.1 else _span(rng, moment()) for _ in range(25)]
    return readings, tariffs, outages


def _span(rng, start):
    return rng.choice([0, 1, 2]), start, start + dt.timedelta(hours=rng.randint(-5, 100))


def loops(readings, tariffs, outages, sites):
    """The definition, row by row."""
    found = []
    for reading in readings:
        site, when = reading[0], reading[1]
        same = [o for o in outages if not sites or (site is not None and o[0] == site)]
        if when is not None and any(e is not None and s <= when <= e for _, s, e in same):
            continue
        for tariff in tariffs:
            if sites and (site is None or tariff[0] != site):
                continue
            if when is not None and tariff[2] is not None and tariff[1] <= when.date() <= tariff[2]:
                off = tariff[3] <= when.hour <= tariff[4]
                found.append((*((site,) if sites else ()), *reading[1:], *tariff[5:], off))
    return sorted(found, key=repr)


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("sites", [True, False])
def test_cleaned_equals_nested_loops(spark, way, sites):
    readings, tariffs, outages = case(len(way))
    frames = [
        spark.createDataFrame(data, schema)
        for data, schema in ((readings, READING), (tariffs, TARIFF), (outages, OUTAGE))
    ]
    keys = ("site_id",) if sites else ()
    if not sites:
        frames = [frame.drop("site_id") for frame in frames]
    found = cleaning.solar_cleaned(*frames, keys, **WAYS[way])
    assert rows(found) == loops(readings, tariffs, outages, sites)


def test_excluded_ends_are_inclusive_and_missing_times_survive(spark):
    hours = [dt.datetime(2026, 3, 7, hour) for hour in (1, 2, 6, 10, 11)] + [None]
    readings = spark.createDataFrame([(hour,) for hour in hours], "reading_datetime timestamp_ntz")
    outage = spark.createDataFrame([(dt.datetime(2026, 3, 7, 2), dt.datetime(2026, 3, 7, 10))], "start_datetime timestamp_ntz, end_datetime timestamp_ntz")
    kept = [row[0] for row in cleaning.drop_excluded(readings, outage).collect()]
    assert sorted(kept, key=repr) == sorted([hours[0], hours[4], None], key=repr)


def test_no_reference_rows(spark):
    readings, tariffs, outages = (
        spark.createDataFrame([], schema) for schema in (READING, TARIFF, OUTAGE)
    )
    some = spark.createDataFrame(case(1)[0], READING)
    assert cleaning.solar_cleaned(some, tariffs, outages, ["site_id"]).count() == 0
    assert cleaning.drop_excluded(some, outages, ["site_id"]).count() == some.count()
    assert cleaning.solar_cleaned(readings, spark.createDataFrame(case(1)[1], TARIFF), outages, ["site_id"]).count() == 0


def test_off_peak_hours(spark):
    def flags(first, last):
        frame = spark.range(24).select(
            F.make_timestamp_ntz(F.lit(2026), F.lit(1), F.lit(1), F.col("id").cast("int"), F.lit(0), F.lit(0)).alias("reading_datetime"),
            F.lit(first).alias("off_peak_start_hour"), F.lit(last).alias("off_peak_end_hour"),
        )
        return [row[0].hour for row in frame.filter(cleaning.off_peak()).select("reading_datetime").collect()]

    assert sorted(flags(0, 4)) == [0, 1, 2, 3, 4]
    assert flags(23, 5) == []


def test_measured_size_decides(spark):
    tariffs = spark.createDataFrame(case(2)[1], TARIFF)
    side = intervals.Intervals(tariffs, "start_date", "end_date", ("peak_rate",), "month", ("site_id",))
    measured = side.measure(0).first()
    assert measured["rows"] == side.spread().count()
    assert measured["size"] > 24 * measured["rows"]
    assert measured["longest"] > intervals.LONG_SPAN


def test_dense_exclusions_compare_no_pairs(spark, monkeypatch):
    """Thousands of overlapping exclusions of a month, against a plain check of each reading."""
    rng = random.Random(3)
    start = dt.datetime(2026, 1, 1)
    moments = [start + dt.timedelta(minutes=rng.randrange(40_000)) for _ in range(500)] + [None]
    spans = [(s := start + dt.timedelta(minutes=rng.randrange(40_000)), s + dt.timedelta(minutes=rng.randrange(-2, 9))) for _ in range(2_000)]
    readings = spark.createDataFrame([(i % 3 or None, m) for i, m in enumerate(moments)], "site int, reading_datetime timestamp_ntz")
    exclusions = spark.createDataFrame([(i % 3 or None, *span) for i, span in enumerate(spans)], "site int, start_datetime timestamp_ntz, end_datetime timestamp_ntz")
    want = [(i % 3 or None, m) for i, m in enumerate(moments) if m is None or not (i % 3) or not any(a <= m <= b for j, (a, b) in enumerate(spans) if j % 3 == i % 3)]
    for how in ({}, {"broadcast_bytes": 0, "split_above": 50}, {"live": True}, {"broadcast_bytes": 0, "split_above": None}):
        found = cleaning.drop_excluded(readings, exclusions, ["site"], **how)
        assert rows(found) == sorted(want, key=repr)


@pytest.mark.parametrize("how", [{}, {"broadcast_bytes": 0, "split_above": 40}, {"broadcast_bytes": 0, "split_above": None}, {"grain": "day"}])
@pytest.mark.parametrize("sites", [True, False])
def test_many_overlapping_tariffs(spark, monkeypatch, how, sites):
    """Each reading with every tariff that holds it, against a plain check; copies of tariffs and readings count each."""
    monkeypatch.setattr(intervals, "DENSE", 3)
    rng = random.Random(5)
    first = dt.date(2026, 1, 20)
    spans = [(s := first + dt.timedelta(days=rng.randrange(60)), s + dt.timedelta(days=rng.randrange(-2, 40))) for _ in range(150)]
    tariffs = [(rng.choice([1, 1, 1, 2, None]), s, e, 1, 5, 0.1, 0.2, float(n)) for n, (s, e) in enumerate(spans)]
    tariffs += [tariffs[0], (1, None, first, 1, 5, 0.1, 0.2, 900.0), (1, first, None, 1, 5, 0.1, 0.2, 901.0)]
    start = dt.datetime(2026, 1, 15)
    readings = [(rng.choice([1, 1, 2, 3, None]), start + dt.timedelta(hours=rng.randrange(2400)), float(n)) for n in range(300)]
    readings += [readings[0], (1, None, 5.0)]
    keys = ["site_id"] if sites else []
    want = []
    for site, when, value in readings:
        for t in tariffs:
            if when and t[1] and t[2] and t[1] <= when.date() <= t[2] and (not sites or site == t[0] is not None):
                want.append((site, when, value, t[7]))
    facts = spark.createDataFrame(readings, "site_id int, reading_datetime timestamp_ntz, _number double")
    side = spark.createDataFrame(tariffs, TARIFF)
    found = cleaning.attach_tariff(facts, side, keys, **how)
    assert rows(found.select("site_id", "reading_datetime", "_number", "export_rate")) == sorted(want, key=repr)


def test_measuring_spreads_nothing(spark):
    """An endless tariff is measured without a row per month, and the densest month is that of the spread intervals, clipped or not."""
    rng = random.Random(9)
    spans = [(rng.choice([1, 2, None]), s := dt.date(2026, 1, 1) + dt.timedelta(rng.randrange(400)), s + dt.timedelta(rng.randrange(-5, 200))) for _ in range(80)]
    spans += [(1, dt.date(2026, 3, 1), dt.date.max), (2, None, dt.date.max), (2, dt.date(2026, 3, 1), None)]
    frame = spark.createDataFrame(spans, "site_id int, start_date date, end_date date")
    for keys in ((), ("site_id",)):
        side = intervals.Intervals(frame, "start_date", "end_date", keys=keys)
        for bounds in ((), (2026 * 12 + 3, 2026 * 12 + 9)):
            slots = side.spread(*bounds)
            names = [f"_key_{key}" for key in keys]
            most = max(row["count"] for row in slots.groupBy(*names, "_slot_side").count().collect())
            assert side.densest(0, *bounds).first()["together"] == most
            assert side.measure(0, *bounds).first()["rows"] == slots.count()
        assert "Generate" not in side.measure(0)._jdf.queryExecution().toString()
        assert "sequence" not in side.densest(0)._jdf.queryExecution().toString()


def test_few_intervals_of_many_rows_are_spread_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(intervals, "DEAL_ROWS", 1_000)
    frame = spark.createDataFrame([(n, dt.date(2026, 1, 1), dt.date(2026, 12, 31)) for n in range(50)], "site_id int, start_date date, end_date date").coalesce(1)
    [side] = intervals._measured([intervals.Intervals(frame, "start_date", "end_date", grain="day", keys=("site_id",))])
    assert (side.rows, side.intervals) == (50 * 365, 50)
    assert side.spread().rdd.getNumPartitions() == 4
