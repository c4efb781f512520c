"""What an hour is worth, case by case."""

import datetime as dt

import pytest

from helioledger.operators import finance

SCHEMA = (
    "reading_datetime timestamp_ntz, grid double, solar double, battery double, home double, "
    "off_peak_rate double, peak_rate double, export_rate double, is_off_peak boolean"
)
NOON = dt.datetime(2026, 1, 17, 12)

CASES = {
    # grid, battery, home, off-peak -> kw_saved, kw_exported, saving, export_income, total_saving
    "importing at peak": ((0.4, 0.0, 1.0, False), (0.6, 0.0, 0.18, 0.0, 0.18)),
    "exporting at peak": ((-2.0, 0.0, 1.0, False), (1.0, 2.0, 0.3, 0.4, 0.7)),
    "charging from the grid at peak": ((3.0, 2.0, 1.0, False), (-2.0, 0.0, -0.6, 0.0, -0.6)),
    "charging off-peak": ((3.0, 2.0, 1.0, True), (0.0, 0.0, -0.2, 0.0, -0.2)),
    "discharging off-peak": ((0.0, -2.0, 1.0, True), (0.0, 0.0, 0.0, 0.0, 0.0)),
    "exporting off-peak": ((-1.0, 0.0, 1.0, True), (0.0, 1.0, 0.0, 0.2, 0.2)),
    "no grid value at peak": ((None, None, 1.0, False), (1.0, 0.0, 0.3, 0.0, 0.3)),
    "no home value at peak": ((1.0, 0.0, None, False), (None, 0.0, None, 0.0, None)),
    "no values off-peak": ((None, None, None, True), (0.0, 0.0, 0.0, 0.0, 0.0)),
}


@pytest.mark.parametrize("name", CASES)
def test_hour(spark, name):
    (grid, battery, home, off_peak), expected = CASES[name]
    cleaned = spark.createDataFrame([(NOON, grid, 0.0, battery, home, 0.1, 0.3, 0.2, off_peak)], SCHEMA)
    row = finance.cost_savings(cleaned).first()
    found = [row[name] for name in ("kw_saved", "kw_exported", "saving", "export_income", "total_saving")]
    assert found == [None if value is None else pytest.approx(value) for value in expected]


def test_columns(spark):
    cleaned = spark.createDataFrame([(NOON, 1.0, 1.0, 1.0, 1.0, 0.1, 0.3, 0.2, False)], SCHEMA)
    assert finance.cost_savings(cleaned).columns == [
        "reading_datetime", "grid", "solar", "battery", "home", "off_peak_rate", "peak_rate", "export_rate", "is_off_peak",
        "kw_saved", "kw_exported", "export_income", "saving", "total_saving",
    ]
