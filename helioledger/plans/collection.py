"""From chart tooltips to daily files, and from daily files to the raw table or CSV."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helioledger.functions.labels import tooltip_fields
from helioledger.operators import coverage
from helioledger.schemas import READING_VALUES
from helioledger.sinks import readings as sinks
from helioledger.sources import daily_json


def readings_from_tooltips(tooltips: DataFrame, keys: Sequence[str] = (), dates: DataFrame | None = None) -> DataFrame:
    """Readings as text from rows of date, requested hour and token array: one per request.

    A read tooltip names its own hour; a failed one (no tokens) keeps the requested
    hour with NULL values.  Hours that were never requested are filled in likewise,
    also on those of ``dates`` that have no request at all.
    """
    fields = tooltips.withColumn("fields", tooltip_fields(F.col("tokens")))
    hour = F.when(F.col("tokens").isNull(), F.col("hour")).otherwise(F.col("fields.hour"))
    values = [F.col(f"fields.{name}").alias(name) for name in READING_VALUES]
    read = fields.select(*keys, "date", hour.alias("hour"), F.col("hour").alias("asked"), *values)
    return coverage.hour_skeleton(read, keys, dates, asked="asked")


def collect(
    tooltips: DataFrame,
    folder: str,
    start: dt.date | Column,
    end: dt.date | Column | None = None,
    keys: Sequence[str] = (),
) -> None:
    """Save the days from ``start`` to ``end`` (by default yesterday) that have no file yet.

    With keys each key among the tooltips has its own days.  A day without tooltips is saved with empty hours.
    """
    spark = tooltips.sparkSession
    end = coverage.yesterday() if end is None else end
    kinds = {key: tooltips.schema[key].dataType.simpleString() for key in keys}
    stored = sinks.stored_days(spark, folder, kinds, start, end)
    if stored is None:
        stored = tooltips.select(*keys, "date").limit(0)
    missing = coverage.missing_dates(stored, start, end, keys, tooltips.select(*keys) if keys else None)
    wanted = tooltips.join(missing, [*keys, "date"], "left_semi")
    sinks.save_daily_json(readings_from_tooltips(wanted, keys, missing), folder, keys, existing="skip")


def in_file_order(spark: SparkSession, folder: str, glob: str = daily_json.DAILY_FILES, layout: str = "auto") -> DataFrame:
    """All readable readings below ``folder`` by path, array and place in it, which is a global sort."""
    order = ["source_file", "array", "position"]
    return daily_json.read_daily_json(spark, folder, glob, layout, with_origin=True).orderBy(*order).drop(*order)


def consolidate_csv(
    spark: SparkSession,
    folder: str,
    path: str,
    glob: str = daily_json.DAILY_FILES,
    layout: str = "auto",
    ordered: bool = False,
) -> bool:
    """All readable readings below ``folder`` as CSV, on request in the order of the files, which is a global sort."""
    read = in_file_order if ordered else daily_json.read_daily_json
    return sinks.write_csv(read(spark, folder, glob, layout), path)


def consolidate_table(spark: SparkSession, folder: str, table: str, path: str | None = None, glob: str = daily_json.JSON_FILES) -> None:
    """Load the files below ``folder`` to the raw table if there is none."""
    sinks.create_raw_table(daily_json.read_raw_json(spark, folder, glob), table, path)
