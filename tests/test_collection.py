"""From tooltips to files to CSV and the raw table."""

import datetime as dt
import json

from helioledger.plans import collection
from helioledger.sources import daily_json
from tests.conftest import rows

TOKENS = ["07:00", "Grd : ", "2.75", "Sol : ", "0.5", "Bat : ", "-1.25", "Hom : ", "4.5"]
TOOLTIP = "date date, hour string, tokens array<string>"


def test_every_requested_hour_gives_a_row(spark):
    day = dt.date(2026, 1, 17)
    tooltips = spark.createDataFrame([(day, "07:00", TOKENS), (day, "08:00", None), (day, "09:00", ["09:00"])], TOOLTIP)
    found = {row["hour"]: row[2:] for row in collection.readings_from_tooltips(tooltips).collect()}
    assert len(found) == 24
    assert found.pop("07:00") == ("2.75", "0.5", "-1.25", "4.5")
    assert set(found.values()) == {(None,) * 4}


def test_collect_saves_missing_days_as_text(spark, tmp_path):
    folder = str(tmp_path / "days")
    days = [dt.date(2026, 1, day) for day in (17, 18, 19)]
    tooltips = spark.createDataFrame([(day, "07:00", TOKENS) for day in days], TOOLTIP)
    collection.collect(tooltips, folder, days[0], days[1])
    assert daily_json.read_daily_json(spark, folder).count() == 48
    collection.collect(tooltips, folder, days[0], days[2])
    assert daily_json.read_daily_json(spark, folder).count() == 72
    first = json.loads(next((tmp_path / "days" / "year=2026" / "month=01" / "day=17").glob("part-*")).read_text())
    assert first[7] == {"date": "2026-01-17", "hour": "07:00", "grid": "2.75", "solar": "0.5", "battery": "-1.25", "home": "4.5"}


def test_consolidated_csv_keeps_file_order(spark, tmp_path):
    for name, hours in (("2026-01-18", ["01:00", "00:00"]), ("2026-01-17", ["05:00"])):
        folder = tmp_path / "files" / name[:4] / name[5:7] / name[8:]
        folder.mkdir(parents=True)
        (folder / f"{name}_data.json").write_text(json.dumps([{"date": name, "hour": hour, "grid": "1"} for hour in hours]))
    assert collection.consolidate_csv(spark, str(tmp_path / "files"), str(tmp_path / "csv"), ordered=True)
    parts = sorted((tmp_path / "csv").glob("part-*"))
    lines = [line for part in parts for line in part.read_text().splitlines() if not line.startswith("date")]
    assert lines == ["2026-01-17,05:00,1.0,,,", "2026-01-18,01:00,1.0,,,", "2026-01-18,00:00,1.0,,,"]
    collection.consolidate_table(spark, str(tmp_path / "files"), "raw_from_files")
    assert rows(spark.table("raw_from_files").select("date", "hour", "grid")) == [
        ("2026-01-17", "05:00", "1"), ("2026-01-18", "00:00", "1"), ("2026-01-18", "01:00", "1"),
    ]


def test_one_row_for_each_tap_whatever_hour_it_shows(spark):
    day = dt.date(2026, 1, 17)
    taps = [(day, "22:00", ["22:00", "Sol : ", "1"]), (day, "23:00", ["22:00", "Sol : ", "1"]), (day, "00:00", ["Sol : ", "3"])]
    found = collection.readings_from_tooltips(spark.createDataFrame(taps, TOOLTIP)).collect()
    assert len(found) == 24
    assert sorted(str(row["hour"]) for row in found if row["solar"]) == ["22:00", "22:00", "None"]


def test_wanted_days_without_tooltips_are_saved_empty(spark, tmp_path):
    days = [dt.date(2026, 1, day) for day in (17, 18)]
    collection.collect(spark.createDataFrame([(days[0], "07:00", TOKENS)], TOOLTIP), str(tmp_path / "days"), *days)
    found = daily_json.read_daily_json(spark, str(tmp_path / "days"))
    assert found.count() == 48 and found.filter("date = '2026-01-18' AND solar IS NULL").count() == 24


def test_each_site_collects_its_own_days_beside_files_of_either_name(spark, tmp_path):
    folder = tmp_path / "days" / "2026" / "01" / "17"
    folder.mkdir(parents=True)
    (folder / "2026-01-17_data.json").write_text(json.dumps([{"site": 1, "date": "2026-01-17", "hour": "07:00", "solar": "9"}], indent=2))
    days = [dt.date(2026, 1, day) for day in (17, 18)]
    tooltips = spark.createDataFrame([(site, day, "07:00", TOKENS) for site in (1, 2) for day in days], "site bigint, " + TOOLTIP)
    for _ in range(2):
        collection.collect(tooltips, str(tmp_path / "days"), *days, keys=["site"])
    found = daily_json.read_daily_json(spark, str(tmp_path / "days"), keys={"site": "bigint"})
    counts = {(row["site"], row["date"].day): row["count"] for row in found.groupBy("site", "date").count().collect()}
    assert counts == {(1, 17): 1, (1, 18): 24, (2, 17): 24, (2, 18): 24}
