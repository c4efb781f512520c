"""When the installation has paid for itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helioledger.functions.numbers import nearest_int, ratio, total_of_totals
from helioledger.functions.timestamps import midnight, plus_days
from helioledger.schemas import INSTALLATION_COST

_FORECAST = ("payback_percentage", "day_number", "days_to_payback", "average_daily_saving", "forecast_payback_date")


def _with_forecast(saved: DataFrame, day: str, basis: str = "whole") -> DataFrame:
    """Add the forecast to rows of cumulative saving, day number and cost.

    All of the cost over the average so far is counted from the row's own day, and
    the day count rounds half to even.  A zero average gives no forecast.  With
    ``basis="remaining"`` only what is not saved yet is counted; it is negative once
    the cost is saved.
    """
    if basis not in ("whole", "remaining"):
        raise ValueError(f"basis must be 'whole' or 'remaining', not {basis!r}")
    cumulative, cost = F.col("cumulative_saving"), F.col("installation_cost")
    open_cost = cost - cumulative if basis == "remaining" else cost
    return (
        saved.withColumn("average_daily_saving", ratio(cumulative, F.col("day_number")))
        .withColumn("payback_percentage", ratio(cumulative, cost) * 100)
        .withColumn("days_to_payback", nearest_int(ratio(open_cost, F.col("average_daily_saving"))))
        .withColumn("forecast_payback_date", plus_days(F.col(day), F.col("days_to_payback")))
    )


def payback_forecast_development(
    rollup: DataFrame,
    keys: Sequence[str] = (),
    installation_cost: int = INSTALLATION_COST,
    exact: bool = False,
    ordered: bool | None = None,
    basis: str = "whole",
    before: DataFrame | None = None,
) -> DataFrame:
    """Cumulative saving and forecast after each day with data.

    ``before`` has the ``cumulative_saving`` and ``day_number`` (per key) that the rollup's first days go on from.

    The window sees one row per day and key, so a partition of it holds at most the
    days of the calendar, however many hours lie below.  Without keys the rows come
    in date order; with keys a global sort is done only on request.
    """
    window = Window.partitionBy(*keys).orderBy("reading_date")
    running = total_of_totals(F.col("total_saving"), exact=False)
    if exact:
        running = F.sum(F.col("total_saving").cast("decimal(28,6)"))
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cumulative, number = running.over(so_far), F.row_number().over(window).cast("long")
    if before is not None:
        names = {"_saved": "cumulative_saving", "_days": "day_number"}
        if keys:
            carried = before.select(*[F.col(key).alias(f"_key_{key}") for key in keys], *[F.col(old).alias(new) for new, old in names.items()])
            same = [F.col(key).eqNullSafe(F.col(f"_key_{key}")) for key in keys]
            rollup = rollup.join(carried, same, "left")
        else:  # one row
            row = before.first()
            rollup = rollup.withColumns({new: F.lit(row and row[old]).cast(before.schema[old].dataType) for new, old in names.items()})
        saved_before = F.col("_saved").cast("decimal(28,6)") if exact else F.col("_saved")
        # A sum over missing values alone stays missing.
        cumulative = F.coalesce(cumulative + saved_before, cumulative, saved_before)
        number = number + F.coalesce("_days", F.lit(0))
    saved = rollup.select(
        *keys,
        midnight(F.col("reading_date")).alias("reading_date"),
        "total_saving",
        cumulative.cast("double").alias("cumulative_saving"),
        number.alias("day_number"),
        F.lit(installation_cost).alias("installation_cost"),
    )
    result = _with_forecast(saved, "reading_date", basis).select(
        *keys,
        "reading_date",
        "total_saving",
        "cumulative_saving",
        "day_number",
        "installation_cost",
        "payback_percentage",
        "days_to_payback",
        "average_daily_saving",
        "forecast_payback_date",
    )
    return result.orderBy("reading_date", *keys) if (ordered if ordered is not None else not keys) else result


def payback_forecast_current(
    rollup: DataFrame,
    keys: Sequence[str] = (),
    installation_cost: int = INSTALLATION_COST,
    exact: bool = False,
    basis: str = "whole",
) -> DataFrame:
    """The forecast on the last day with data.

    On that day the cumulative saving is the whole sum and the day number the count
    of days, so one aggregate replaces the window and the join.
    """
    saved = (
        rollup.groupBy(*keys)
        .agg(
            midnight(F.max("reading_date")).alias("data_date"),
            total_of_totals(F.col("total_saving"), exact).alias("cumulative_saving"),
            F.count(F.lit(1)).alias("day_number"),
        )
        .filter(F.col("data_date").isNotNull())
        .withColumn("installation_cost", F.lit(installation_cost))
    )
    return _with_forecast(saved, "data_date", basis).select(*keys, "data_date", *_FORECAST)


def payback_on_data_date(development: DataFrame, latest: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of an existing development table on each key's last day, by equi join.

    Without keys ``latest`` is an aggregate of exactly one row and is broadcast; with
    keys the optimizer decides from its size.
    """
    side = latest.select(*[F.col(key).alias(f"_key_{key}") for key in keys], "data_date")
    match = F.col("reading_date") == F.col("data_date")
    for key in keys:
        match = match & (F.col(key) == F.col(f"_key_{key}"))
    joined = development.drop("forecast_payback_date").join(side if keys else F.broadcast(side), match, "inner")
    forecast = plus_days(F.col("data_date"), F.col("days_to_payback"))
    return joined.withColumn("forecast_payback_date", forecast).select(*keys, "data_date", *_FORECAST)
