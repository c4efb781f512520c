"""Column checks.  They report failures and never stop a job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioledger.schemas import RATES, READING_VALUES

# The columns each relation must fill, and the one that must be unique.
NOT_NULL = {
    "raw_solar_data": ("date", "hour", *READING_VALUES),
    "raw_tariffs": ("start_date", *RATES),
    "raw_exclusions": ("start_date", "start_time", "end_date", "end_time", "exclusion_reason"),
    "int_admin_exclusions": ("start_datetime", "end_datetime"),
    "int_admin_tariffs": ("start_date", "end_date", "off_peak_start_hour", "off_peak_end_hour", *RATES),
    "int_finance_cost_savings": ("reading_datetime",),
    "data_date": ("data_date",),
}
UNIQUE = {"raw_tariffs": ("start_date",)}


def not_null(frame: DataFrame, relation: str, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass and with one row per map task to merge."""
    counted = frame.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    rows = [F.struct(F.lit(name).alias("column"), F.col(name).alias("failures")) for name in columns]
    return counted.select(F.inline(F.array(*rows))).select(
        F.lit(relation).alias("relation"), "column", F.lit("not_null").alias("test"), "failures"
    )


def unique(frame: DataFrame, relation: str, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Values that occur more than once, per column (within the keys, if given)."""
    return reduce(DataFrame.unionByName, [_repeated(frame, relation, name, keys) for name in columns])


def _repeated(frame: DataFrame, relation: str, name: str, keys: Sequence[str]) -> DataFrame:
    counts = frame.filter(F.col(name).isNotNull()).groupBy(*keys, name).agg(F.count(F.lit(1)).alias("uses"))
    return counts.agg(F.count_if(F.col("uses") > 1).alias("failures")).select(
        F.lit(relation).alias("relation"), F.lit(name).alias("column"), F.lit("unique").alias("test"), "failures"
    )


def check_all(relations: Mapping[str, DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """Every declared check on the relations at hand: relation, column, test, failures, passed."""
    reports = [not_null(frame, name, NOT_NULL[name]) for name, frame in relations.items() if name in NOT_NULL]
    reports += [unique(frame, name, UNIQUE[name], keys) for name, frame in relations.items() if name in UNIQUE]
    return reduce(DataFrame.unionByName, reports).withColumn("passed", F.col("failures") == 0)
