"""Reading files: what is skipped, what is kept, what is written."""

import datetime as dt
import re
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helioledger.schemas import CHART_HOURS, PARSED_READINGS
from helioledger.sinks import readings as sinks
from helioledger.sources import daily_json
from tests.conftest import rows

DAY = "2026-01-17"


def place(folder: Path, day: str, text: str) -> None:
    target = folder / day[:4] / day[5:7] / day[8:]
    target.mkdir(parents=True, exist_ok=True)
    (target / f"{day}_data.json").write_text(text, encoding="utf-8")


def reading(day=DAY, hour="14:00", grid="2.75", solar="0.5", battery="-1.25", home="4.5"):
    return {"date": day, "hour": hour, "grid": grid, "solar": solar, "battery": battery, "home": home}


def test_whole_files_are_skipped(spark, tmp_path):
    good = json.dumps([reading()], indent=4)
    texts = [good, "[{", good + " x", good + "]", good + "}", good[:-1] + ",]", f"{good},{good}", f'{good},"text":{good}', "[1],[2]", "", "null",
             json.dumps(reading()), json.dumps(json.dumps([reading()])), '"text"', "12", good.replace('"', "'"), "\ufeff" + good, "\u00a0" + good]
    for number, text in enumerate(texts):
        place(tmp_path, f"2026-01-{number + 1:02d}", text)
    found = rows(daily_json.read_daily_json(spark, str(tmp_path)))
    assert found == [(dt.date(2026, 1, 17), "14:00", 2.75, 0.5, -1.25, 4.5)]


def test_what_is_skipped_is_told(spark, tmp_path):
    good = json.dumps([reading()])
    texts = {"malformed": ["[{", good + " x", good + "]", f"{good},{good}", " \n", good.replace('"', "'"), f'{good},"text":{good}'],
             "not an array": ["null", json.dumps(reading()), '"text"', "12", ' {"a": [1]} '], None: [good, "[]", " [ ] "]}
    number, want = 0, []
    for reason, spelled in texts.items():
        for text in spelled:
            number += 1
            place(tmp_path, f"2026-01-{number:02d}", text)
            want += [(f"2026-01-{number:02d}", 0, None, reason)] if reason else []
    place(tmp_path, "2026-02-01", json.dumps([1, reading(), None, "x", [reading()], reading(solar=True), {}]))
    place(tmp_path, "2026-02-02", json.dumps([None, reading()]) + "\n" + json.dumps([reading(), 5]))
    want += [("2026-02-01", 0, p, "not an object") for p in (0, 2, 3, 4)] + [("2026-02-02", 0, 0, "not an object"), ("2026-02-02", 1, 1, "not an object")]
    kept, rejects = daily_json.read_with_rejects(spark, str(tmp_path))
    named = rejects.select(F.regexp_extract("source_file", r"(\d+-\d+-\d+)_data", 1), "array", "position", "reason")
    assert rows(named) == sorted(want, key=repr)
    assert rows(kept.drop("source_file", "array", "position")) == rows(daily_json.read_daily_json(spark, str(tmp_path)))
    assert kept.filter("source_file LIKE '%2026-02-01%'").count() == 3


def test_entries_and_fields(spark, tmp_path):
    entries = [
        1, "text", None, [reading()], reading(),
        reading(grid=1.5, solar=2, battery=True, home=None),
        reading(grid="", solar="  ", battery="x", home=" 1.5 "),
        reading(grid=[1], solar={"a": 1}, battery="1.5d", home="1_0"),
        reading(day="2026-13-01", hour="24:00"), reading(day=20260117, hour=14), reading(day="20260117", hour="4:05"),
        {"date": DAY}, {},
    ]
    place(tmp_path, DAY, json.dumps(entries))
    day = dt.date(2026, 1, 17)
    rest = (2.75, 0.5, -1.25, 4.5)
    expected = [
        (day, "14:00", *rest), (day, "14:00", 1.5, 2.0, 1.0, None), (day, "14:00", None, None, None, 1.5),
        (day, "14:00", None, None, None, 10.0), (None, None, *rest), (None, None, *rest), (day, "04:05", *rest),
        (day, None, None, None, None, None), (None, None, None, None, None, None),
    ]
    found = daily_json.read_daily_json(spark, str(tmp_path))
    assert [f.dataType for f in found.schema] == [f.dataType for f in PARSED_READINGS]
    assert rows(found) == sorted(expected, key=repr)


def test_flat_arrays_agree_with_mixed_ones(spark, tmp_path):
    """The same odd fields in an array of objects only, and beside a number."""
    entries = [
        reading(), reading(grid=1.5, solar=2, battery=-3e-7, home=12345678901234567890), reading(day=[1], hour={"a": "4:05"}), {},
        reading(grid=None, solar="nan", battery="true", home="[1]"), {"date": DAY, "x": {"y": [True]}}, reading(day="20260117", hour=14),
        None, reading(grid="a\u00e9\\n\"b", hour="4:5"),
    ]
    found = []
    for name, more in (("flat", []), ("mixed", [5])):
        place(tmp_path / name, DAY, json.dumps(entries + more, indent=2))
        found.append(rows(daily_json.read_daily_json(spark, str(tmp_path / name))))
    assert repr(found[0]) == repr(found[1]) and len(found[0]) == 8


def test_last_of_repeated_fields_wins(spark, tmp_path):
    place(tmp_path, DAY, '[{"date": "2026-01-17", "grid": "1", "grid": "2"}]')
    assert daily_json.read_daily_json(spark, str(tmp_path)).first()["grid"] == 2.0


def test_origin_gives_a_stable_order(spark, tmp_path):
    place(tmp_path, "2026-01-02", json.dumps([7, reading(hour="01:00"), reading(hour="00:00")]))
    place(tmp_path, "2026-01-01", json.dumps([reading(hour="05:00")]))
    found = daily_json.read_daily_json(spark, str(tmp_path), with_origin=True).orderBy("source_file", "position")
    assert [row["hour"] for row in found.collect()] == ["05:00", "01:00", "00:00"]


def test_strict_load_keeps_text_and_fails_on_broken_files(spark, tmp_path):
    place(tmp_path, DAY, json.dumps([reading(), reading(hour="15:00")], indent=4))
    assert daily_json.read_raw_json(spark, str(tmp_path)).count() == 2
    place(tmp_path, "2026-01-18", "[{")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        daily_json.read_raw_json(spark, str(tmp_path)).collect()


def test_arrays_on_lines_are_all_read(spark, tmp_path):
    lines = "\n".join(json.dumps([reading(hour=hour)]) for hour in ("02:00", "01:00"))
    place(tmp_path, DAY, lines + "\n")
    place(tmp_path, "2026-01-16", json.dumps([reading("2026-01-16")], indent=1))
    assert daily_json.read_raw_json(spark, str(tmp_path)).count() == 3
    found = daily_json.read_daily_json(spark, str(tmp_path), with_origin=True).orderBy("source_file", "array", "position")
    assert [row["hour"] for row in found.collect()] == ["14:00", "02:00", "01:00"]
    for odd in (lines + " x", lines + "\n{", lines.replace("\n", ",")):
        place(tmp_path, DAY, odd)
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            daily_json.read_raw_json(spark, str(tmp_path)).collect()


def test_small_arrays_come_back_with_the_defaults(spark, tmp_path):
    path = str(tmp_path / "days")
    sinks.save_daily_json(day_of_readings(spark), path, array_entries=10)
    assert rows(daily_json.read_daily_json(spark, path)) == rows(day_of_readings(spark))
    assert daily_json.read_raw_json(spark, path).count() == 24


def test_present_dates_read_names_only(spark, tmp_path):
    place(tmp_path, DAY, "not json at all")
    place(tmp_path, "2026-01-20", "[]")
    frame = daily_json.present_dates(spark, str(tmp_path))
    assert rows(frame) == [(dt.date(2026, 1, 17),), (dt.date(2026, 1, 20),)]


def day_of_readings(spark, day=DAY, value=0.5):
    data = [(dt.date.fromisoformat(day), hour, value, None, -value, 1.0) for hour in reversed(CHART_HOURS)]
    return spark.createDataFrame(data, PARSED_READINGS)


def test_saved_days_are_one_array_in_hour_order(spark, tmp_path):
    path = str(tmp_path / "days")
    sinks.save_daily_json(day_of_readings(spark), path)
    files = list((tmp_path / "days").rglob("part-*.txt"))
    assert len(files) == 1 and "year=2026/month=01/day=17" in str(files[0])
    entries = json.loads(files[0].read_text())
    assert [entry["hour"] for entry in entries] == list(CHART_HOURS)
    assert entries[0] == {"date": DAY, "hour": "00:00", "grid": 0.5, "solar": None, "battery": -0.5, "home": 1.0}


def test_existing_days(spark, tmp_path):
    path = str(tmp_path / "days")
    first = day_of_readings(spark)
    sinks.save_daily_json(first, path)
    both = day_of_readings(spark, value=9.0).unionByName(day_of_readings(spark, "2026-01-18"))
    with pytest.raises(FileExistsError):
        sinks.save_daily_json(both, path)
    sinks.save_daily_json(both, path, existing="skip")
    found = daily_json.read_daily_json(spark, path, "part-*", "lines")
    assert rows(found) == rows(first.unionByName(day_of_readings(spark, "2026-01-18")))
    assert rows(daily_json.present_dates(spark, path, "part-*")) == [(dt.date(2026, 1, 17),), (dt.date(2026, 1, 18),)]


def test_a_day_of_very_many_copies_is_cut_and_kept_whole(spark):
    copies = spark.range(0, 5000, 1, 16).select(
        F.lit(dt.date(2026, 1, 17)).alias("date"), F.lit("14:00").alias("hour"),
        *[F.lit(1.0).alias(name) for name in ("grid", "solar", "battery", "home")],
    )
    arrays = [json.loads(row["value"]) for row in sinks.day_arrays(copies, array_entries=1000).collect()]
    assert sum(map(len, arrays)) == 5000
    assert max(map(len, arrays)) <= 1500


def test_sites_share_a_folder(spark, tmp_path):
    path = str(tmp_path / "fleet")
    fleet = day_of_readings(spark).crossJoin(spark.range(3).withColumnRenamed("id", "site_id"))
    sinks.save_daily_json(fleet, path, ["site_id"])
    found = daily_json.read_daily_json(spark, path, "part-*", "lines", {"site_id": "bigint"})
    assert rows(found.select(fleet.columns)) == rows(fleet)


def test_no_text_is_parsed_twice_the_same_way(spark, tmp_path):
    """One plain parse and one careful one in the plan, whatever else asks for what they found."""
    (tmp_path / "2026-01-17_data.json").write_text('[{"date": "2026-01-17", "hour": "00:00", "solar": true}, 5]')
    text = daily_json.read_daily_json(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"parseJson|parse_json", text)) <= 1 and len(re.findall(r"from_json", text)) <= 1


def test_what_is_no_array_by_its_ends_is_still_told_apart(spark, tmp_path):
    lines = ['[{"hour": "00:00"}', '[1],2', '{"hour": "00:00"}', '"x]"', '[{"hour": "01:00"}] x', ' [{"hour": "02:00"}, 7]\t', '[', ']', '[1] ]', '[]', '7']
    (tmp_path / "2026-01-17_data.json").write_text("\n".join(lines))
    kept, rejects = daily_json.read_with_rejects(spark, str(tmp_path), layout="lines")
    assert [row["hour"] for row in kept.collect()] == ["02:00"]
    reasons = sorted(row["reason"] for row in rejects.collect())
    assert reasons == ["malformed"] * 6 + ["not an array"] * 3 + ["not an object"]
    text = daily_json.read_daily_json(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "THEN from_json" in text
