"""Tolerant text parsers.  Bad text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One optional underscore may stand between two digits.
_DIGITS = r"[0-9](?:_?[0-9])*"
_DECIMAL = rf"[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
_NUMBER = rf"^\s*{_DECIMAL}\s*\z"
# Blanks of any script around a number, or one of the special values.
_UNUSUAL = rf"(?iU)^\s*(?:({_DECIMAL})|([+-]?)(inf|infinity|nan))\s*\z"

_CALENDAR_DATE = r"^(?!0000)\d{4}-\d{2}-\d{2}\z"
_COMPACT_DATE = r"^(?!0000)\d{8}\z"
_WEEK_DATE = r"^((?!0000)\d{4})(-?)W(\d{2})(?:\2([1-7]))?\z"

_CLOCK = r"^(2[0-3]|[01]\d|\d):([0-5]\d|\d)\z"

# Day, then "|", "/" or blanks, then month, blanks and a four-digit year.
_SPACED_DATE = r"(?U)^(3[01]|[12]\d|0[1-9]| ?[1-9])(?:\s*\|\s*|/|\s+)(1[0-2]|0[1-9]|[1-9])\s+((?!0000)\d{4})\z"


def tolerant_float(text: Column) -> Column:
    """Text to double; blank or unreadable text gives NULL.

    The pattern keeps out spellings that only the JVM takes, such as ``1.5d``.
    """
    plain = F.when(text.contains("_"), F.replace(text, F.lit("_"), F.lit(""))).otherwise(text)
    return F.when(text.rlike(_NUMBER), plain.try_cast("double")).when(text.rlike(_UNUSUAL), _unusual_float(text))


def _unusual_float(text: Column) -> Column:
    number, sign, name = (F.regexp_extract(text, _UNUSUAL, group) for group in (1, 2, 3))
    return (
        F.when(number != "", F.replace(number, F.lit("_"), F.lit("")).try_cast("double"))
        .when(F.lower(name) == "nan", F.lit(float("nan")))
        .when(sign == "-", F.lit(float("-inf")))
        .otherwise(F.lit(float("inf")))
    )


def iso_date(text: Column) -> Column:
    """ISO 8601 calendar dates (long or compact) and week dates to DATE, else NULL."""
    compact = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return (
        F.when(text.rlike(_CALENDAR_DATE), text.try_cast("date"))
        .when(text.rlike(_COMPACT_DATE), compact.try_cast("date"))
        .when(text.rlike(_WEEK_DATE), _week_date(text))
    )


def _week_date(text: Column) -> Column:
    year = F.regexp_extract(text, _WEEK_DATE, 1)
    week = F.regexp_extract(text, _WEEK_DATE, 3).try_cast("int")
    day = F.coalesce(F.nullif(F.regexp_extract(text, _WEEK_DATE, 4), F.lit("")).try_cast("int"), F.lit(1))

    # Week 1 is the week of 4 January; 28 December always lies in the last week.
    def monday(month_day: str) -> Column:
        anchor = F.concat(year, F.lit(month_day)).try_cast("date")
        return F.date_sub(anchor, F.weekday(anchor))

    first = monday("-01-04")
    wanted = F.date_add(first, (week - 1) * 7)
    return F.when((week >= 1) & (wanted <= monday("-12-28")), F.date_add(wanted, day - 1))


def clock_text(text: Column) -> Column:
    """``H:M`` or ``HH:MM`` text to ``HH:MM``, else NULL."""
    hour = F.lpad(F.regexp_extract(text, _CLOCK, 1), 2, "0")
    minute = F.lpad(F.regexp_extract(text, _CLOCK, 2), 2, "0")
    padded = F.when(F.length(text) == 5, text).otherwise(F.concat(hour, F.lit(":"), minute))
    return F.when(text.rlike(_CLOCK), padded)


def spaced_date(text: Column, on_error: str = "null") -> Column:
    """A date as read off the screen, such as ``07 | 02 2026``, to DATE.

    ``on_error="fail"`` raises on text in no accepted spelling; ``"null"`` gives NULL.
    """
    if on_error not in ("null", "fail"):
        raise ValueError(f"on_error must be 'null' or 'fail', not {on_error!r}")
    day, month, year = (F.regexp_extract(text, _SPACED_DATE, group) for group in (1, 2, 3))
    parsed = F.when(text.rlike(_SPACED_DATE), F.concat_ws("-", year, month, F.trim(day)).try_cast("date"))
    if on_error == "null":
        return parsed
    complaint = F.concat(F.lit("date text in no accepted spelling: "), F.coalesce(text, F.lit("NULL")))
    return F.coalesce(parsed, F.raise_error(complaint).cast("date"))
