"""Build every mart in one pass over the hours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from helioledger.operators import cleaning, finance, payback, rollups
from helioledger.plans import models
from helioledger.schemas import INSTALLATION_COST
from helioledger.sinks.marts import register_views, write_mart
from helioledger.sources.marts import open_relation

MARTS = (
    "daily_savings",
    "monthly_savings",
    "total_savings",
    "payback_forecast_development",
    "payback_forecast_current",
    "total_solar_generation",
    "data_date",
)


def marts_from_rollup(
    rollup: DataFrame,
    keys: Sequence[str] = (),
    installation_cost: int = INSTALLATION_COST,
    exact: bool = False,
) -> dict[str, DataFrame]:
    """All seven marts from the daily rollup."""
    return {
        "daily_savings": rollups.daily_savings(rollup, keys),
        "monthly_savings": rollups.monthly_from_daily(rollup, keys, exact),
        "total_savings": rollups.total_from_daily(rollup, keys, exact),
        "payback_forecast_development": payback.payback_forecast_development(rollup, keys, installation_cost, exact),
        "payback_forecast_current": payback.payback_forecast_current(rollup, keys, installation_cost, exact),
        "total_solar_generation": rollups.generation_from_daily(rollup, keys, exact),
        "data_date": rollups.data_date(rollup, keys, day="reading_date"),
    }


def build(
    raw_readings: DataFrame,
    raw_tariffs: DataFrame,
    raw_exclusions: DataFrame,
    location: str | None = None,
    keys: Sequence[str] = (),
    installation_cost: int = INSTALLATION_COST,
    exact: bool = False,
    **how,
) -> None:
    """Publish the staging and intermediate views and write the marts.

    The hours are joined and valued once, for the rollup.  It is written before it
    is read again, so a lost executor costs a few tasks and never the whole build.
    """
    spark = raw_readings.sparkSession
    readings = models.stg_readings(raw_readings, keys)
    tariffs = models.stg_tariffs(raw_tariffs, keys)
    exclusions = models.stg_exclusions(raw_exclusions, keys)
    typed_tariffs = models.int_tariffs(tariffs, keys)
    typed_exclusions = models.int_exclusions(exclusions, keys)
    cleaned = cleaning.solar_cleaned(models.typed_readings(readings, keys), typed_tariffs, typed_exclusions, keys, slotted_rows=True, **how)
    costs = finance.cost_savings(cleaned, keys)
    # The views outlive today's tables, so their plan holds nothing measured in them.
    options = {name: value for name, value in how.items() if name not in ("broadcast_bytes", "split_above")}
    current = models.typed_readings(readings, keys), typed_tariffs, typed_exclusions, keys
    live = cleaning.solar_cleaned(*current, **options, live=True)
    register_views(
        {
            "stg_scraper_solar": readings,
            "stg_seeded_tariffs": tariffs,
            "stg_seeded_exclusions": exclusions,
            "int_admin_tariffs": typed_tariffs,
            "int_admin_exclusions": typed_exclusions,
            "int_generation_solar_cleaned": live,
            "int_finance_cost_savings": finance.cost_savings(live, keys),
        }
    )
    write_mart(rollups.daily_rollup(costs, keys, exact), "daily_rollup", location)
    rollup = open_relation(spark, "daily_rollup", location)
    for name, frame in marts_from_rollup(rollup, keys, installation_cost, exact).items():
        write_mart(frame, name, location)


def build_from_tables(spark: SparkSession, location: str | None = None, **how) -> None:
    """The same from the raw tables ``raw_solar_data``, ``raw_tariffs`` and ``raw_exclusions``."""
    raw = [open_relation(spark, name, location) for name in ("raw_solar_data", "raw_tariffs", "raw_exclusions")]
    build(*raw, location, **how)
