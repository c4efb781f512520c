"""From typed readings to readings with a tariff."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioledger.operators.intervals import SLOT, Intervals, join_intervals
from helioledger.schemas import RATES, READING_VALUES

_OFF_PEAK_HOURS = ("off_peak_start_hour", "off_peak_end_hour")


def _outages(exclusions: DataFrame, keys: Sequence[str]) -> tuple[str, Intervals]:
    """Of the exclusions that start together only the longest matters, so copies do not pile up in one task."""
    longest = exclusions.groupBy(*keys, "start_datetime").agg(F.max("end_datetime").alias("end_datetime"))
    return "left_anti", Intervals(longest, "start_datetime", "end_datetime", condensed=True)


def _tariffs(tariffs: DataFrame, open_ended: bool = False) -> tuple[str, Intervals]:
    if open_ended:
        tariffs = tariffs.withColumn("end_date", F.coalesce("end_date", F.lit(dt.date.max)))
    return "inner", Intervals(tariffs, "start_date", "end_date", (*RATES, *_OFF_PEAK_HOURS))


def drop_excluded(readings: DataFrame, exclusions: DataFrame, keys: Sequence[str] = (), **how) -> DataFrame:
    """Readings outside every exclusion; both ends of an exclusion belong to it.

    A reading without a timestamp stays.
    """
    return join_intervals(readings, "reading_datetime", [_outages(exclusions, keys)], keys, **how)


def attach_tariff(
    readings: DataFrame, tariffs: DataFrame, keys: Sequence[str] = (), open_ended: bool = False, **how
) -> DataFrame:
    """Readings with the rates of each tariff whose days include theirs.

    No tariff drops the reading, two tariffs give it twice, and a tariff without an
    end date applies to none, or with ``open_ended`` to all days from its first on.
    ``grain="day"`` meets tariffs by day instead of month.
    """
    return join_intervals(readings, "reading_datetime", [_tariffs(tariffs, open_ended)], keys, **how)


def off_peak(wrap_midnight: bool = False, end_inclusive: bool = True) -> Column:
    """True from the first off-peak hour through the last; a span over midnight is never true.

    ``wrap_midnight`` lets a span whose end is before its start go on past midnight,
    and without ``end_inclusive`` the last hour is no longer off-peak.
    """
    hour = F.hour("reading_datetime")
    start, end = (F.col(name) for name in _OFF_PEAK_HOURS)
    begun, not_over = hour >= start, (hour <= end if end_inclusive else hour < end)
    within = begun & not_over
    if wrap_midnight:
        within = F.when(start > end, begun | not_over).otherwise(within)
    return F.coalesce(within, F.lit(False))


def solar_cleaned(
    readings: DataFrame,
    tariffs: DataFrame,
    exclusions: DataFrame,
    keys: Sequence[str] = (),
    open_ended: bool = False,
    wrap_midnight: bool = False,
    end_inclusive: bool = True,
    **how,
) -> DataFrame:
    """Typed readings without excluded times, with rates and the off-peak flag.

    If both reference tables are too large to broadcast, the two joins share one
    shuffle of the readings.  ``slotted_rows`` keeps the slot by which that dealt them.
    """
    steps = [_outages(exclusions, keys), _tariffs(tariffs, open_ended)]
    joined = join_intervals(readings, "reading_datetime", steps, keys, **how)
    stamp = [name for name in ("ingested_at",) if name in readings.columns]
    stamp += [SLOT] if how.get("slotted_rows") else []
    return joined.select(
        *keys, "reading_datetime", *READING_VALUES, *stamp, *RATES, off_peak(wrap_midnight, end_inclusive).alias("is_off_peak")
    )
