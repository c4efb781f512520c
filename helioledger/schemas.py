"""Column names and types shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

READING_VALUES = ("grid", "solar", "battery", "home")
RATES = ("off_peak_rate", "peak_rate", "export_rate")

# The nine additive measures of the savings marts.
MEASURES = (
    *READING_VALUES,
    "kw_saved",
    "kw_exported",
    "saving",
    "export_income",
    "total_saving",
)

# The hours the collector reads on each date.
CHART_HOURS = tuple(f"{hour:02d}:00" for hour in range(24))

# Fixed value: what the installation cost, in pounds.
INSTALLATION_COST = 10200


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


RAW_READINGS = _text("date", "hour", *READING_VALUES)
RAW_TARIFFS = _text(
    "start_date",
    "end_date",
    "off_peak_start_hour",
    "off_peak_end_hour",
    "peak_rate",
    "off_peak_rate",
    "export_rate",
)
RAW_EXCLUSIONS = _text("start_date", "start_time", "end_date", "end_time", "exclusion_reason")

# Readings after the tolerant parse: what the raw table holds.
PARSED_READINGS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.StringType()),
        *[T.StructField(name, T.DoubleType()) for name in READING_VALUES],
    ]
)
