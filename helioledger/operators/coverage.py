"""Which dates and hours are missing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioledger.schemas import CHART_HOURS, READING_VALUES
from helioledger.session import scratch_path

# Hours that one long marks.
_BITS = 63


def yesterday() -> Column:
    """The last complete day."""
    return F.date_sub(F.current_date(), 1)


def missing_dates(
    present: DataFrame,
    start: dt.date | Column,
    end: dt.date | Column | None = None,
    keys: Sequence[str] = (),
    sites: DataFrame | None = None,
) -> DataFrame:
    """Dates from ``start`` through ``end`` (by default yesterday) that ``present`` lacks.

    With keys each row of ``sites``, or else each key found in ``present``, has its
    own calendar.  Present rows shrink to distinct dates within the map tasks, and
    both sides of the anti join then hold a date once per key.
    """
    end = yesterday() if end is None else end
    first, last = (bound if isinstance(bound, Column) else F.lit(bound) for bound in (start, end))
    days = F.explode(F.when(first <= last, F.sequence(first, last))).alias("date")
    found = present.select(*keys, F.col("date").cast("date").alias("date")).distinct()
    if keys:
        owners = (found if sites is None else sites).select(*keys).distinct()
    else:
        owners = present.sparkSession.range(1)
    return owners.select(*keys, days).join(found, [*keys, "date"], "left_anti")


def newest_missing_date(missing: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The missing date to collect next: the latest one."""
    return missing.groupBy(*keys).agg(F.max("date").alias("date"))


def newest_first(missing: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Missing dates in the order of collection."""
    return missing.orderBy(F.desc("date"), *keys)


def hour_skeleton(
    readings: DataFrame,
    keys: Sequence[str] = (),
    dates: DataFrame | None = None,
    hours: Sequence[str] = CHART_HOURS,
    asked: str = "hour",
) -> DataFrame:
    """Readings plus a row of NULL values for each configured hour a date lacks.

    The readings are passed on as they are.  Beside them, one bit per hour is ORed
    per key and date, and the clear bits become the added rows, so no reading is
    shuffled.  The input is written once first, as both branches read it.  ``dates``
    adds dates of which every hour failed.  ``asked`` names the column with the hour
    that was asked for, where the hour of a reading can be another.
    """
    spark = readings.sparkSession
    group = [*keys, "date"]
    landed = scratch_path(spark, "skeleton")
    readings.select(*dict.fromkeys([*group, "hour", asked, *READING_VALUES])).write.parquet(landed)
    readings = spark.read.parquet(landed)
    labels = F.array(*[F.lit(hour) for hour in hours])
    place = F.array_position(labels, F.col(asked)).cast("int") - 1
    words = range(-(-len(hours) // _BITS))
    bits = [
        F.when(F.floor(place / _BITS) == word, F.call_function("shiftleft", F.lit(1).cast("long"), place % _BITS)).otherwise(F.lit(0))
        for word in words
    ]
    marked = readings.select(*group, *[bit.alias(f"bits_{word}") for word, bit in zip(words, bits)])
    seen = marked.groupBy(*group).agg(*[F.bit_or(f"bits_{word}").alias(f"seen_{word}") for word in words])
    if dates is not None:
        seen = dates.select(*group).distinct().join(seen, group, "full")
    held = F.array(*[F.coalesce(F.col(f"seen_{word}"), F.lit(0)) for word in words])
    lacking = F.filter(labels, lambda _, place: F.getbit(F.get(held, F.floor(place / _BITS).cast("int")), place % _BITS) == 0)
    types = dict(readings.dtypes)
    added = seen.select(
        *group,
        F.explode(lacking).alias("hour"),
        *[F.lit(None).cast(types[name]).alias(name) for name in READING_VALUES],
    )
    return readings.select(*group, "hour", *READING_VALUES).unionByName(added)
