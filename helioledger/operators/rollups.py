"""Sums by day, by month and overall.

Only ``daily_rollup`` has to see the hours.  Its sums can be summed again, so the
other marts are derived from it: 24 times fewer rows and one pass over the hours.
Each groupBy combines within the map tasks first, so a site or day with very many
rows reaches its reducer as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioledger.functions.numbers import ratio, total, total_of_totals
from helioledger.functions.timestamps import day_of, midnight, month_of
from helioledger.operators.intervals import SLOT
from helioledger.schemas import MEASURES


def _sums(exact: bool, again: bool = False) -> list:
    add = total_of_totals if again else total
    return [add(F.col(name), exact).alias(name) for name in MEASURES]


def daily_rollup(costs: DataFrame, keys: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """The nine sums and the number of readings per day, with the day as DATE.

    Hours that tell their slot are summed where it has put them.
    """
    slot = [SLOT] if SLOT in costs.columns else []
    summed = costs.groupBy(*keys, *slot, day_of(F.col("reading_datetime")).alias("reading_date")).agg(
        *_sums(exact), F.count(F.lit(1)).alias("readings")
    )
    return summed.drop(*slot)


def daily_savings(rollup: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return rollup.select(*keys, midnight(F.col("reading_date")).alias("reading_date"), *MEASURES)


def monthly_savings(costs: DataFrame, keys: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """The nine sums per month, straight from the hours."""
    by_month = costs.groupBy(*keys, month_of(F.col("reading_datetime")).alias("reading_month")).agg(*_sums(exact))
    return by_month.withColumn("reading_month", midnight(F.col("reading_month")))


def monthly_from_daily(rollup: DataFrame, keys: Sequence[str] = (), exact: bool = False) -> DataFrame:
    by_month = rollup.groupBy(*keys, month_of(F.col("reading_date")).alias("reading_month")).agg(*_sums(exact, True))
    return by_month.withColumn("reading_month", midnight(F.col("reading_month")))


def total_savings(costs: DataFrame, keys: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """The nine sums overall; one row of NULLs for no input and no keys.

    Exact sums go by way of the days, because millionths of a whole fleet may not fit a long.
    """
    if exact:
        return total_from_daily(daily_rollup(costs, keys, exact), keys, exact)
    return costs.groupBy(*keys).agg(*_sums(exact))


def total_from_daily(rollup: DataFrame, keys: Sequence[str] = (), exact: bool = False) -> DataFrame:
    return rollup.groupBy(*keys).agg(*_sums(exact, True))


def savings_by_level(costs: DataFrame, keys: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """Daily, monthly and total sums from one pass over the hours and one shuffle, told apart by ``level``.

    ``level`` is ``day``, ``month`` or ``total``; the date is NULL but for days, the month NULL for totals.  Sums
    combine within the map tasks, so what is shuffled is a row per task and group.  Hours without a timestamp make a
    day and a month of their own, as in the separate sums.  Exact sums hold two billion hours a group; a total of
    more goes by way of the days.  Without keys and hours there is the total alone, a row of NULLs.
    """
    moment = F.col("reading_datetime")
    dated = costs.withColumns({"reading_month": midnight(month_of(moment)), "reading_date": midnight(day_of(moment))})
    day, month = F.grouping("reading_date"), F.grouping("reading_month")
    sets = [[*keys, "reading_month", "reading_date"], [*keys, "reading_month"], [*keys]]
    columns = [F.col(name) for name in (*keys, "reading_month", "reading_date")]
    level = F.when(day == 0, F.lit("day")).when(month == 0, F.lit("month")).otherwise(F.lit("total"))
    summed = dated.groupingSets([[F.col(name) for name in names] for names in sets], *columns).agg(level.alias("level"), *_sums(exact))
    return summed.select("level", *keys, "reading_date", "reading_month", *MEASURES)


def marts_by_level(levels: DataFrame, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The three marts of written ``savings_by_level``."""
    columns = {"daily_savings": ("day", ["reading_date"]), "monthly_savings": ("month", ["reading_month"]), "total_savings": ("total", [])}
    return {name: levels.filter(F.col("level") == level).select(*keys, *dates, *MEASURES) for name, (level, dates) in columns.items()}


def total_solar_generation(cleaned: DataFrame, keys: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """Energy generated, and the same per reading: the average counts hours, also those without a value."""
    solar, readings = total(F.col("solar"), exact).alias("solar"), F.count(F.lit(1)).alias("readings")
    if exact:
        by_day = cleaned.groupBy(*keys, day_of(F.col("reading_datetime")).alias("reading_date")).agg(solar, readings)
        return generation_from_daily(by_day, keys, exact)
    return _generation(cleaned.groupBy(*keys).agg(solar, readings), keys)


def generation_from_daily(
    rollup: DataFrame, keys: Sequence[str] = (), exact: bool = False, per_day: bool = False
) -> DataFrame:
    """The same from the daily rollup; ``per_day`` divides by the days with a reading instead of the readings."""
    solar = total_of_totals(F.col("solar"), exact).alias("solar")
    readings = F.count("reading_date") if per_day else F.coalesce(F.sum("readings"), F.lit(0))
    readings = readings.alias("readings")
    return _generation(rollup.groupBy(*keys).agg(solar, readings), keys)


def _generation(summed: DataFrame, keys: Sequence[str]) -> DataFrame:
    average = ratio(F.col("solar"), F.col("readings")).alias("average_daily_solar_generation")
    return summed.select(*keys, F.col("solar").alias("total_solar_generation"), average)


def data_date(cleaned: DataFrame, keys: Sequence[str] = (), day: str = "reading_datetime") -> DataFrame:
    """The last day with a reading.  ``day="reading_date"`` reads it off the daily rollup."""
    latest = F.max(day_of(F.col(day)))
    return cleaned.groupBy(*keys).agg(midnight(latest).alias("data_date"))


def hourly_generation_by_day(readings: DataFrame, keys: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """Energy generated per day and hour of day."""
    moment = F.col("reading_datetime")
    return readings.groupBy(*keys, day_of(moment).alias("day"), F.hour(moment).alias("hour")).agg(
        total(F.col("solar"), exact).alias("solar")
    )


def hourly_generation_by_month(
    readings: DataFrame, keys: Sequence[str] = (), exact: bool = False, agg: str = "sum"
) -> DataFrame:
    """Energy generated per month and hour of day: the sum, or ``agg="avg"`` for the mean of the readings."""
    if agg not in ("sum", "avg"):
        raise ValueError(f"agg must be 'sum' or 'avg', not {agg!r}")
    moment = F.col("reading_datetime")
    value = total(F.col("solar"), exact)
    if agg == "avg":
        value = ratio(value, F.count("solar"))
    return readings.groupBy(*keys, month_of(moment).alias("month"), F.hour(moment).alias("hour")).agg(
        value.alias("solar")
    )
