"""Sums, ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MILLION = 1_000_000.0
_HALF = float(1 << 32)
_LARGE = 1e15
_PLAIN = r"^(-?)(\d)\.(\d+)E(-?)(\d+)$"


def total(column: Column, exact: bool = False) -> Column:
    """SUM as double.

    ``exact`` adds whole millionths, so the result does not depend on the order in
    which partitions arrive.  They are added in two halves, which together hold any
    sum of values below 1e15.  Larger values and those that are no number are added
    as doubles to that: they make the sum as inexact, or as little a number, as they are.
    """
    if exact:
        odd = F.isnan(column) | (F.abs(column) >= _LARGE)
        millionths = F.rint(F.when(~odd, column) * _MILLION)
        high = F.floor(millionths / _HALF)
        low = (millionths - high * _HALF).cast("long")
        whole = (F.sum(high).cast("double") * _HALF + F.sum(low).cast("double")) / _MILLION
        rest = F.sum(F.when(odd, column))
        return F.when(rest.isNull(), whole).otherwise(F.coalesce(whole, F.lit(0.0)) + rest)
    return F.sum(column)


def total_of_totals(column: Column, exact: bool = False) -> Column:
    """SUM over values that are sums themselves: few rows, so wide decimals are cheap enough.

    Values that no decimal holds are added as doubles.
    """
    if exact:
        held = column.try_cast("decimal(28,6)")
        rest = F.sum(F.when(held.isNull(), column))
        return F.when(rest.isNull(), F.sum(held).cast("double")).otherwise(F.coalesce(F.sum(held).cast("double"), F.lit(0.0)) + rest)
    return F.sum(column)


def ratio(top: Column, bottom: Column) -> Column:
    """Double division; NULL for a zero divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def nearest_int(value: Column) -> Column:
    """Round half to even to INT; NULL where the value has none."""
    return F.rint(value).try_cast("int")


def float_text(value: Column) -> Column:
    """Shortest text of a double: plain from 0.0001 up to 1e16, else ``1.5e-07`` style."""
    text = value.cast("string")
    sign, head, tail, minus, power = (F.regexp_extract(text, _PLAIN, group) for group in range(1, 6))
    size = F.abs(value)
    plain = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), r"0+$", "")
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.when(tail == "0", head).otherwise(F.concat(head, F.lit("."), tail))
    exponent = F.concat(
        F.when(minus == "-", F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.length(power) < 2, F.lpad(power, 2, "0")).otherwise(power),
    )
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(size == F.lit(float("inf")), F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.concat(sign, mantissa, exponent))
    )
