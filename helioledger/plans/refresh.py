"""Marts kept up to date by day: only days whose files have changed are valued again.

The raw table is partitioned by date.  A ledger holds which files each day had when the marts were made; days whose
files differ now are the changed ones, however they changed.  Finding them opens no reading.  Their hours are joined
and valued, and replace the same days of the rollup.  Months are added up again where a day changed, and the running
totals of the forecast go on from the stored row before the first changed day.  Tariffs and exclusions change the worth
of any day, so the marts are built anew when these differ from the ledger's.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helioledger.operators import cleaning, finance, payback, rollups
from helioledger.plans import models
from helioledger.schemas import INSTALLATION_COST
from helioledger.session import scratch_path
from helioledger.sinks.marts import write_mart
from helioledger.sources.marts import open_relation

LEDGER, TERMS = "ledger_files", "ledger_terms"
#: The name of a mart's partitions; no column of a mart is called so.
MONTH = "_month"


def _landed(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _stored(spark: SparkSession, location: str, name: str) -> DataFrame | None:
    try:
        return open_relation(spark, name, location)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def files_by_day(raw: DataFrame) -> DataFrame:
    """``date`` and ``file`` of a table partitioned by date; no column of the files is read."""
    return raw.select(F.col("date").cast("date").alias("date"), F.col("_metadata.file_path").alias("file")).distinct()


def _terms(tariffs: DataFrame, exclusions: DataFrame) -> DataFrame:
    """How many rows each reference table has and a sum of their hashes, which their order does not change."""
    counted = [
        frame.agg(F.lit(name).alias("relation"), F.count("*").alias("rows"), F.sum(F.xxhash64(*frame.columns).cast("decimal(38,0)")).alias("hashes"))
        for name, frame in (("tariffs", tariffs), ("exclusions", exclusions))
    ]
    return counted[0].unionByName(counted[1])


def changed_days(raw: DataFrame, tariffs: DataFrame, exclusions: DataFrame, location: str) -> tuple[list[dt.date] | None, DataFrame, DataFrame]:
    """Days whose files have changed since the ledger (None: all of them), and what the ledger has to say next.

    What comes to the driver is dates, at most the days of the calendar, and the two rows of terms.
    """
    spark = raw.sparkSession
    files, terms = _landed(files_by_day(raw), "ledger"), _landed(_terms(tariffs, exclusions), "terms")
    known, agreed = _stored(spark, location, LEDGER), _stored(spark, location, TERMS)
    if known is None or agreed is None or sorted(terms.collect()) != sorted(agreed.select(*terms.columns).collect()):
        return None, files, terms
    both = files.withColumn("_new", F.lit(True)).join(known.withColumn("_old", F.lit(True)), ["date", "file"], "full")
    changed = both.filter(F.col("_new").isNull() | F.col("_old").isNull()).select("date").distinct()
    return sorted(row["date"] for row in changed.collect() if row["date"] is not None), files, terms


def _month(date: str) -> Column:
    return F.date_format(date, "yyyy-MM").alias(MONTH)


def _replace(rows: DataFrame, location: str, name: str, months: Sequence[str] | None) -> DataFrame:
    """Write a mart in partitions by month: all of it, or only these months, of which ``rows`` has all that is left."""
    path, spark = f"{location}/{name}", rows.sparkSession
    writer = rows.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH)
    if months is None:
        writer.parquet(path)
    else:
        left = {row[0] for row in rows.select(MONTH).distinct().collect()}
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        for month in sorted(set(months) - left):  # nothing is left of these, and other months keep their files
            rows.drop(MONTH).limit(0).write.mode("overwrite").parquet(f"{path}/{MONTH}={month}")
    return spark.read.schema(rows.schema).parquet(path)


def refresh(
    raw_readings: DataFrame,
    raw_tariffs: DataFrame,
    raw_exclusions: DataFrame,
    location: str,
    keys: Sequence[str] = (),
    installation_cost: int = INSTALLATION_COST,
    exact: bool = False,
    **how,
) -> list[dt.date] | None:
    """Bring the seven marts below ``location`` up to date; the days valued again (None: all).

    Running totals go on from stored doubles, which with ``exact`` hold millionths up to nine billion.  The ledger is
    written last: after a failure the same days are valued again.
    """
    spark = raw_readings.sparkSession
    tariffs, exclusions = models.stg_tariffs(raw_tariffs, keys), models.stg_exclusions(raw_exclusions, keys)
    days, files, terms = changed_days(raw_readings, tariffs, exclusions, location)
    if days is not None and not days:
        return days
    touched = raw_readings if days is None else raw_readings.filter(F.col("date").cast("date").isin(days))
    typed = models.int_tariffs(tariffs, keys), models.int_exclusions(exclusions, keys)
    cleaned = cleaning.solar_cleaned(models.typed_readings(models.stg_readings(touched, keys), keys), *typed, keys, **how)
    fresh = _landed(rollups.daily_rollup(finance.cost_savings(cleaned, keys), keys, exact).select("*", _month("reading_date")), "fresh-days")
    if days is None:
        months, rollup = None, _replace(fresh, location, "daily_rollup", None)
    else:
        months = sorted({f"{d:%Y-%m}" for d in days})
        rest = open_relation(spark, "daily_rollup", location).filter(F.col(MONTH).isin(months) & ~F.col("reading_date").isin(days))
        rollup = _replace(_landed(rest.select(*fresh.columns).unionByName(fresh), "fresh-months"), location, "daily_rollup", months)
    some = rollup if months is None else rollup.filter(F.col(MONTH).isin(months))
    _replace(rollups.daily_savings(some, keys).select("*", _month("reading_date")), location, "daily_savings", months)
    _replace(rollups.monthly_from_daily(some, keys, exact).select("*", _month("reading_month")), location, "monthly_savings", months)
    if days is None:
        development = payback.payback_forecast_development(rollup, keys, installation_cost, exact, ordered=False)
        _replace(development.select("*", _month("reading_date")), location, "payback_forecast_development", None)
    else:
        _go_on(rollup, location, keys, installation_cost, exact, days[0])
    totals = open_relation(spark, "monthly_savings", location)
    write_mart(rollups.total_from_daily(totals, keys, exact), "total_savings", location)
    write_mart(payback.payback_forecast_current(rollup, keys, installation_cost, exact), "payback_forecast_current", location)
    write_mart(rollups.generation_from_daily(rollup, keys, exact), "total_solar_generation", location)
    write_mart(rollups.data_date(rollup, keys, day="reading_date"), "data_date", location)
    write_mart(terms, TERMS, location)
    write_mart(files, LEDGER, location)
    return days


def _go_on(rollup: DataFrame, location: str, keys: Sequence[str], installation_cost: int, exact: bool, first: dt.date) -> None:
    """The forecast from the first changed day on, after the totals stored before it."""
    name, begin = "payback_forecast_development", f"{first:%Y-%m}"
    stored = open_relation(rollup.sparkSession, name, location)
    earlier = stored.filter((F.col(MONTH) <= begin) & (F.col("reading_date") < F.lit(first).cast("timestamp_ntz")))
    last = F.max_by(F.struct("cumulative_saving", "day_number"), "reading_date").alias("_last")
    before = _landed(earlier.groupBy(*keys).agg(last).filter("_last IS NOT NULL").select(*keys, "_last.*"), "totals-before")
    onward = rollup.filter((F.col(MONTH) >= begin) & (F.col("reading_date") >= F.lit(first)))
    later = payback.payback_forecast_development(onward, keys, installation_cost, exact, ordered=False, before=before)
    new = later.select("*", _month("reading_date"))
    same_month = earlier.filter(F.col(MONTH) == begin).select(*new.columns)
    months = [row[0] for row in stored.filter(F.col(MONTH) >= begin).select(MONTH).distinct().collect()]
    _replace(_landed(same_month.unionByName(new), "forecast"), location, name, months)
