"""Staging and intermediate models as plain functions of DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioledger.functions.timestamps import hour_of_clock, wall_clock
from helioledger.operators import cleaning, finance
from helioledger.schemas import RATES, RAW_EXCLUSIONS, READING_VALUES


def stg_readings(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The raw columns and the time of the load where the raw table keeps it, else the time of the query."""
    stamp = F.col("ingested_at") if "ingested_at" in raw.columns else F.current_timestamp().alias("ingested_at")
    return raw.select(*keys, "date", "hour", *READING_VALUES, stamp)


def stg_tariffs(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return raw.select(*keys, "start_date", "end_date", "off_peak_start_hour", "off_peak_end_hour", *RATES)


def stg_exclusions(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return raw.select(*keys, *RAW_EXCLUSIONS.names)


def int_tariffs(staged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Typed tariffs.  Of the off-peak times only the hour is ever used, so it is kept as INT."""
    return staged.select(
        *keys,
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
        hour_of_clock(F.col("off_peak_start_hour")).alias("off_peak_start_hour"),
        hour_of_clock(F.col("off_peak_end_hour")).alias("off_peak_end_hour"),
        *[F.col(rate).cast("double").alias(rate) for rate in RATES],
    )


def int_exclusions(staged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Exclusions with both ends as timestamps."""
    return staged.select(
        *keys,
        "exclusion_reason",
        wall_clock(F.col("start_date"), F.col("start_time")).alias("start_datetime"),
        wall_clock(F.col("end_date"), F.col("end_time")).alias("end_datetime"),
    )


def typed_readings(staged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One timestamp from date and hour, and the four values as doubles."""
    stamp = [name for name in ("ingested_at",) if name in staged.columns]
    return staged.select(
        *keys,
        wall_clock(F.col("date"), F.col("hour")).alias("reading_datetime"),
        *[F.col(name).cast("double").alias(name) for name in READING_VALUES],
        *stamp,
    )


def solar_cleaned(
    raw_readings: DataFrame, raw_tariffs: DataFrame, raw_exclusions: DataFrame, keys: Sequence[str] = (), **how
) -> DataFrame:
    """Cleaned readings straight from the three raw tables."""
    return cleaning.solar_cleaned(
        typed_readings(stg_readings(raw_readings, keys), keys),
        int_tariffs(stg_tariffs(raw_tariffs, keys), keys),
        int_exclusions(stg_exclusions(raw_exclusions, keys), keys),
        keys,
        **how,
    )


def cost_savings(
    raw_readings: DataFrame, raw_tariffs: DataFrame, raw_exclusions: DataFrame, keys: Sequence[str] = (), **how
) -> DataFrame:
    """Valued readings straight from the three raw tables."""
    return finance.cost_savings(solar_cleaned(raw_readings, raw_tariffs, raw_exclusions, keys, **how), keys)
