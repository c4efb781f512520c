"""Wall-clock dates and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Adding more days than this leaves the range of a timestamp.
_MOST_DAYS = 100_000_000


def wall_clock(day: Column, time: Column) -> Column:
    """Join a date and a time of day to a zone-free timestamp.

    NULL if either part is missing; a lone date would otherwise read as midnight.
    """
    text = F.concat_ws(" ", day.cast("string"), time.cast("string"))
    return F.when(day.isNotNull() & time.isNotNull(), text.cast("timestamp_ntz"))


def day_of(moment: Column) -> Column:
    return F.to_date(moment)


def month_of(moment: Column) -> Column:
    return F.trunc(F.to_date(moment), "MM")


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def hour_of_clock(text: Column) -> Column:
    """Hour of an ``HH:MM`` or ``HH:MM:SS`` text; an error if it is no time of day."""
    return F.hour(F.concat(F.lit("1970-01-01 "), text).cast("timestamp_ntz"))


def plus_days(moment: Column, days: Column) -> Column:
    """Moment plus whole days; NULL where the sum leaves the calendar."""
    safe = F.when(F.abs(days.cast("long")) <= _MOST_DAYS, days)
    return F.try_add(moment, F.make_dt_interval(safe))
