"""What each hour was worth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioledger.operators.intervals import SLOT
from helioledger.schemas import RATES, READING_VALUES


def kw_saved() -> Column:
    """Household use at peak that the grid did not supply; negative if the battery charged from it."""
    own_use = F.when(F.col("grid") > 0, F.col("home") - F.col("grid")).otherwise(F.col("home"))
    return F.when(~F.col("is_off_peak"), own_use).otherwise(F.lit(0.0))


def kw_exported() -> Column:
    return F.when(F.col("grid") < 0, -F.col("grid")).otherwise(F.lit(0.0))


def battery_charge_cost() -> Column:
    """Cost of charging off-peak, as a negative amount."""
    charging = F.col("is_off_peak") & (F.col("battery") > 0)
    return F.when(charging, -F.col("battery") * F.col("off_peak_rate")).otherwise(F.lit(0.0))


def cost_savings(cleaned: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Energy saved and exported per hour, and both in money net of battery charging."""
    valued = cleaned.withColumns({"kw_saved": kw_saved(), "kw_exported": kw_exported()}).withColumns(
        {
            "gross_saving": F.col("kw_saved") * F.col("peak_rate"),
            "export_income": F.col("kw_exported") * F.col("export_rate"),
            "charge_cost": battery_charge_cost(),
        }
    )
    slot = [SLOT] if SLOT in cleaned.columns else []
    return valued.select(
        *keys,
        *slot,
        "reading_datetime",
        *READING_VALUES,
        *RATES,
        "is_off_peak",
        "kw_saved",
        "kw_exported",
        "export_income",
        (F.col("gross_saving") + F.col("charge_cost")).alias("saving"),
        (F.col("gross_saving") + F.col("export_income") + F.col("charge_cost")).alias("total_saving"),
    )
