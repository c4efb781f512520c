"""Files that arrive in turns."""

import datetime as dt

from helioledger.operators import rollups
from helioledger.plans import models
from helioledger.schemas import CHART_HOURS, PARSED_READINGS, RAW_EXCLUSIONS, RAW_TARIFFS
from helioledger.sinks import readings as sinks
from helioledger.streaming import ingest, rollup
from tests.conftest import rows


def readings(spark, *days, hours=CHART_HOURS):
    data = [(dt.date(2026, 1, day), hour, 1.0, 2.0, 0.5, 1.5) for day in days for hour in hours]
    return spark.createDataFrame(data, PARSED_READINGS)


def test_only_new_files_are_taken(spark, tmp_path):
    source, target, state = (str(tmp_path / name) for name in ("source", "target", "state"))

    def run():
        stream = ingest.stream_daily_json(spark, source, "part-*", "lines")
        ingest.append_readings(stream, target, state).awaitTermination()
        return spark.read.schema(PARSED_READINGS).parquet(target)

    sinks.save_daily_json(readings(spark, 1, 2), source)
    assert rows(run()) == rows(readings(spark, 1, 2))
    assert run().count() == 48
    sinks.save_daily_json(readings(spark, 3), source)
    assert rows(run()) == rows(readings(spark, 1, 2, 3))


def test_late_hours_are_added_to_their_day(spark, tmp_path):
    source, target, state = (str(tmp_path / name) for name in ("source", "target", "state"))
    tariffs = spark.createDataFrame([("2026-01-01", "2026-03-31", "00:00", "04:00", "0.3", "0.1", "0.2")], RAW_TARIFFS)
    exclusions = spark.createDataFrame([], RAW_EXCLUSIONS)

    def value(batch):
        return models.cost_savings(batch, tariffs, exclusions)

    def run(arrived):
        sinks.save_daily_json(arrived, f"{source}/{arrived.count()}")
        stream = ingest.stream_daily_json(spark, source, "part-*", "lines")
        rollup.write_partial_sums(stream, value, target, state, exact=True).awaitTermination()

    first, late = readings(spark, 9, hours=CHART_HOURS[:20]), readings(spark, 9, hours=CHART_HOURS[20:])
    run(first)
    run(readings(spark, 10, 11))
    run(late)
    whole = rollups.daily_rollup(value(readings(spark, 9, 10, 11)), exact=True)
    assert rows(rollup.rollup_from_partials(spark, target, exact=True).select(whole.columns)) == rows(whole)


def test_hours_that_come_again_count_once(spark, tmp_path):
    source, target, state = (str(tmp_path / name) for name in ("source", "target", "state"))

    def run(name, arrived):
        sinks.save_daily_json(arrived, f"{source}/{name}")
        ingest.append_readings(ingest.first_deliveries(ingest.stream_daily_json(spark, source)), target, state).awaitTermination()
        return spark.read.schema(PARSED_READINGS).parquet(target)

    run("a", readings(spark, 5, 6).unionByName(readings(spark, 6, hours=CHART_HOURS[:3])))
    # Days long before those that have come are not late, as the watermark follows the arrival.
    assert rows(run("b", readings(spark, 1, 6, 7))) == rows(readings(spark, 1, 5, 6, 7))
    again = readings(spark, 5).unionByName(spark.createDataFrame([(dt.date(2026, 1, 9), None, v, None, None, None) for v in (1.0, 2.0, 2.0)], PARSED_READINGS))
    found = run("c", again)
    assert rows(found.filter("hour IS NOT NULL")) == rows(readings(spark, 1, 5, 6, 7))
    assert [row["grid"] for row in found.filter("hour IS NULL").orderBy("grid").collect()] == [1.0, 2.0]
