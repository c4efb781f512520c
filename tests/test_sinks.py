"""CSV, parquet, the raw table and the marts."""

import datetime as dt
from pathlib import Path

import pytest

from energy_fixtures.queries import queries
from helioledger.plans import models, warehouse
from helioledger.schemas import PARSED_READINGS, RAW_EXCLUSIONS, RAW_READINGS, RAW_TARIFFS
from helioledger.sinks import readings as sinks
from helioledger.sources import marts, seeds
from tests.conftest import rows

READINGS = [
    (dt.date(2031, 8, 3), "19:00", 6.25, None, -0.0005, 12345678.0),
    (None, None, None, None, None, None),
]


def test_csv_text(spark, tmp_path):
    path = tmp_path / "csv"
    assert sinks.write_csv(spark.createDataFrame(READINGS, PARSED_READINGS).coalesce(1), str(path))
    text = "".join(part.read_text() for part in path.glob("part-*"))
    assert text == "date,hour,grid,solar,battery,home\n2031-08-03,19:00,6.25,,-0.0005,12345678.0\n,,,,,\n"


def test_csv_of_nothing_writes_nothing(spark, tmp_path):
    path = tmp_path / "csv"
    assert not sinks.write_csv(spark.createDataFrame([], PARSED_READINGS), str(path))
    assert not path.exists()


def test_parquet_types(spark, tmp_path):
    path = str(tmp_path / "parquet")
    sinks.write_parquet(spark.createDataFrame(READINGS, PARSED_READINGS), path)
    found = spark.read.parquet(path)
    assert [kind for _, kind in found.dtypes] == ["date", "timestamp_ntz", "double", "double", "double", "double"]
    assert found.filter("date is not null").first()["hour"] == dt.datetime(1970, 1, 1, 19)
    assert any("snappy" in part.name for part in Path(path).glob("part-*"))


def test_parquet_partitions(spark, tmp_path):
    path = str(tmp_path / "parquet")
    sinks.write_parquet(spark.createDataFrame(READINGS[:1], PARSED_READINGS), path, partition_by=["date"])
    assert (Path(path) / "date=2031-08-03").exists()


def test_second_load_is_a_no_op_and_append_adds_only_new_rows(spark):
    first = spark.createDataFrame(READINGS, PARSED_READINGS)
    more = spark.createDataFrame([*READINGS, (dt.date(2026, 1, 18), "00:00", 1.0, 1.0, 1.0, 1.0)], PARSED_READINGS)
    sinks.create_raw_table(first, "raw_once")
    sinks.create_raw_table(more, "raw_once")
    assert spark.table("raw_once").count() == 2
    sinks.append_new_readings(more, "raw_once")
    sinks.append_new_readings(more, "raw_once")
    assert rows(spark.table("raw_once")) == rows(more)


TARIFFS = "start_date,end_date,off_peak_start_hour,off_peak_end_hour,peak_rate,off_peak_rate,export_rate\n2031-05-10,2031-11-02,01:00,06:00,0.412,0.133,0.088\n2031-11-03,,22:00,23:00,0.365,0.121,0.094"
EXCLUSIONS = "start_date,start_time,end_date,end_time,exclusion_reason\n2031-06-18,21:15:00,2031-06-20,03:45:30,meter swapped"


def test_seed_files(spark, tmp_path):
    (tmp_path / "tariffs.csv").write_text(TARIFFS)
    (tmp_path / "exclusions.csv").write_text(EXCLUSIONS)
    tariffs = seeds.read_tariffs(spark, str(tmp_path / "tariffs.csv"))
    assert tariffs.schema == RAW_TARIFFS and tariffs.count() == 2
    assert tariffs.filter("end_date is null").count() == 1
    exclusions = seeds.read_exclusions(spark, str(tmp_path / "exclusions.csv"))
    assert rows(exclusions) == [("2031-06-18", "21:15:00", "2031-06-20", "03:45:30", "meter swapped")]


def test_build_writes_tables_and_views(spark):
    raw = spark.createDataFrame(
        [("2026-01-17", "12:00", "-1", "3", "0.5", "1.5"), ("2026-01-18", "01:00", "2", None, "1", "1")], RAW_READINGS
    )
    tariffs = spark.createDataFrame([("2026-01-01", "2026-03-31", "00:00", "04:00", "0.3", "0.1", "0.2")], RAW_TARIFFS)
    warehouse.build(raw, tariffs, spark.createDataFrame([], RAW_EXCLUSIONS))
    assert {row.name for row in spark.catalog.listTables()} >= set(warehouse.MARTS)
    for view in ("stg_scraper_solar", "int_admin_tariffs", "int_generation_solar_cleaned", "int_finance_cost_savings"):
        assert spark.table(view).count() > 0
    assert marts.data_date(spark).first()["data_date"] == dt.datetime(2026, 1, 18)
    days = marts.daily_savings(spark).collect()
    assert [row["reading_date"].day for row in days] == [18, 17]
    assert len(marts.daily_savings(spark).columns) == 10
    assert marts.monthly_savings(spark).count() == marts.total_savings(spark).count() == 1
    assert marts.payback_forecast(spark).columns[0] == "data_date"
    assert marts.payback_forecast_development(spark).count() == 2
    generated = spark.table("total_solar_generation").first()
    assert (generated["total_solar_generation"], generated["average_daily_solar_generation"]) == (3.0, 1.5)


def test_partitioned_raw_table(spark):
    readings = spark.createDataFrame(READINGS[:1], PARSED_READINGS)
    sinks.create_raw_table(readings, "raw_by_date", partition_by=["date"])
    more = spark.createDataFrame([READINGS[0], (dt.date(2026, 1, 18), "00:00", 1.0, 1.0, 1.0, 1.0)], PARSED_READINGS)
    sinks.append_new_readings(more, "raw_by_date")
    assert rows(spark.table("raw_by_date").select(more.columns)) == rows(more)


def test_build_from_named_tables(spark, tmp_path):
    location = str(tmp_path)
    raw = spark.createDataFrame([("2026-01-17", "12:00", "-1", "3", "0.5", "1.5")], RAW_READINGS)
    raw.write.parquet(f"{location}/raw_solar_data")
    spark.createDataFrame([("2026-01-01", "2026-03-31", "00:00", "04:00", "0.3", "0.1", "0.2")], RAW_TARIFFS).write.parquet(f"{location}/raw_tariffs")
    spark.createDataFrame([], RAW_EXCLUSIONS).write.parquet(f"{location}/raw_exclusions")
    warehouse.build_from_tables(spark, location)
    for name in warehouse.MARTS:
        assert marts.open_relation(spark, name, location).count() == 1


def _files(path):
    return {(file.parent.name, file.name): file.stat().st_mtime_ns for file in Path(path).rglob("*.parquet")}


def test_corrected_days_replace_whole_days_and_leave_other_files(spark, tmp_path):
    schema = "site int, date date, hour string, grid double, solar double, battery double, home double"
    days = [dt.date(2026, 5, d) for d in range(1, 6)]
    table = [(s, d, f"{h:02}:00", 1.0, float(h), None, 2.0) for s in (1, 2) for d in days for h in range(4)] + [(None, days[1], "00:00", 9.0, 9.0, 9.0, 9.0)]
    path = str(tmp_path / "raw")
    sinks.create_raw_table(spark.createDataFrame(table, schema), "raw_to_correct", path, ["date"])
    before = _files(path)
    new = [(1, days[1], "02:00", 5.0, 5.0, 5.0, 5.0), (1, days[1], "02:00", 4.0, None, 5.0, 5.0), (None, days[3], "07:00", 1.0, 1.0, 1.0, 1.0), (3, dt.date(2026, 6, 1), "00:00", 1.0, 1.0, 1.0, 1.0)]
    for _ in range(2):
        dates = sinks.replace_days(spark.createDataFrame(new, schema), "raw_to_correct", ["site"])
        assert sorted(dates) == [days[1], days[3], dt.date(2026, 6, 1)]
        want = [r for r in table if (r[0], r[1]) != (1, days[1])] + [new[0][:4] + (5.0,) + new[0][5:], *new[2:]]
        assert rows(spark.table("raw_to_correct").select(*[c.split()[0] for c in schema.split(", ")])) == sorted(want, key=repr)
    touched = {f"date={d}" for d in dates}
    assert {f: t for f, t in _files(path).items() if f[0] not in touched} == {f: t for f, t in before.items() if f[0] not in touched}
    assert sinks.replace_days(spark.createDataFrame([], schema), "raw_to_correct", ["site"]) == []
    sinks.create_raw_table(spark.createDataFrame(table, schema), "raw_unparted", str(tmp_path / "unparted"))
    with pytest.raises(ValueError, match="partitioned by date"):
        sinks.replace_days(spark.createDataFrame(new, schema), "raw_unparted", ["site"])


def test_loads_keep_their_stamp(spark, tmp_path):
    schema = "date date, hour string, grid double, solar double, battery double, home double"
    hours = [(dt.date(2031, 8, d), "19:00", 1.0, 1.0, 1.0, 1.0) for d in (3, 4, 5)]
    sinks.create_raw_table(spark.createDataFrame(hours[:1], schema), "raw_stamped", str(tmp_path / "raw"), ["date"], stamp=True)
    sinks.append_new_readings(spark.createDataFrame(hours[:2], schema), "raw_stamped")
    staged = models.stg_readings(spark.table("raw_stamped"))
    first = {row["date"]: row["ingested_at"] for row in staged.collect()}
    assert first == {row["date"]: row["ingested_at"] for row in staged.collect()}
    assert first[hours[0][0]] < first[hours[1][0]]
    sinks.replace_days(spark.createDataFrame([hours[0], hours[2]], schema), "raw_stamped")
    second = {row["date"]: row["ingested_at"] for row in models.stg_readings(spark.table("raw_stamped")).collect()}
    assert second[hours[1][0]] == first[hours[1][0]] < second[hours[0][0]] == second[hours[2][0]]


def test_sums_by_site_move_no_bucketed_readings(spark, small):
    frame = queries()["bucketed_daily_savings_by_site"](spark, small)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not [line for line in moved if "site_id" in line and "REPARTITION" not in line and "BroadcastExchange" not in line], plan
    assert "Bucketed: true" in plan and "BroadcastHashJoin" in plan
    with pytest.raises(ValueError, match="go together"):
        sinks.create_raw_table(frame, "raw_odd_buckets", bucket_by=["site_id"])
