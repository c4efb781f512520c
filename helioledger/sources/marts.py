"""Serving reads of the finished marts.

``location`` is a folder of parquet tables; without it the names are looked up in
the catalog.  Everything stays a DataFrame; sorting is done here, at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioledger.schemas import MEASURES

_FORECAST = ("payback_percentage", "day_number", "days_to_payback", "average_daily_saving", "forecast_payback_date")


def open_relation(spark: SparkSession, name: str, location: str | None = None) -> DataFrame:
    """A raw table, model or mart by name."""
    return spark.read.parquet(f"{location}/{name}") if location else spark.table(name)


def data_date(spark: SparkSession, location: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Last day with data; the single value is ``.first()["data_date"]``."""
    return open_relation(spark, "data_date", location).select(*keys, "data_date")


def daily_savings(spark: SparkSession, location: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Ten columns, newest day first."""
    mart = open_relation(spark, "daily_savings", location)
    return mart.select(*keys, "reading_date", *MEASURES).orderBy(F.desc("reading_date"), *keys)


def monthly_savings(spark: SparkSession, location: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Ten columns, newest month first."""
    mart = open_relation(spark, "monthly_savings", location)
    return mart.select(*keys, "reading_month", *MEASURES).orderBy(F.desc("reading_month"), *keys)


def total_savings(spark: SparkSession, location: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Nine columns, one row (per key)."""
    return open_relation(spark, "total_savings", location).select(*keys, *MEASURES)


def payback_forecast(spark: SparkSession, location: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Six columns, one row (per key)."""
    return open_relation(spark, "payback_forecast_current", location).select(*keys, "data_date", *_FORECAST)


def payback_forecast_development(
    spark: SparkSession, location: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Six of the nine columns, in no set order."""
    return open_relation(spark, "payback_forecast_development", location).select(*keys, "reading_date", *_FORECAST)
