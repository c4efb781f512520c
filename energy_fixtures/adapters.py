"""Readings, tariffs and exclusions derived from the driver's tables.

One site comes from ``events`` (hours of a month).  Many sites come from
``lineitem``: a supplier is a site, its tariffs come from ``supplier`` and its
outages from ``orders``, so all three grow with the scale factor.  Values are added
in cents and handed on as text, the way the raw files hold them.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helioledger.functions.parsing import tolerant_float
from helioledger.plans import models
from helioledger.schemas import RAW_EXCLUSIONS, RAW_TARIFFS, READING_VALUES

SITE = ("site_id",)

TARIFF_ROWS = [
    ("2024-01-01", "2024-01-15", "00:00", "04:00", "0.279", "0.079", "0.151"),
    ("2024-01-16", "2024-01-28", "00:00", "04:00", "0.2539", "0.0439", "0.151"),
]
EXCLUSION_ROWS = [("2024-01-07", "02:00:00", "2024-01-07", "10:00:00", "outage")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(name: str) -> Column:
    return F.rint(F.col(name) * 100).cast("long")


def _clock(moment) -> Column:
    return F.concat(F.lpad(F.hour(moment).cast("string"), 2, "0"), F.lit(":00"))


def _as_text(hours: DataFrame, keys=()) -> DataFrame:
    """Hourly sums in cents to the text columns of the raw table."""
    moment = F.col("reading_datetime")
    in_cents = hours.withColumn("grid", F.col("home") + F.col("battery") - F.col("solar"))
    return in_cents.select(
        *keys,
        F.to_date(moment).cast("string").alias("date"),
        _clock(moment).alias("hour"),
        *[(F.col(name).cast("decimal(16,0)") * F.lit(Decimal("0.01"))).cast("string").alias(name) for name in READING_VALUES],
    )


def site_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One site, hourly, from ``events``: no purchase in an hour means no solar value."""
    kind = F.col("event_type")

    def of(name: str):
        return F.coalesce(F.sum(F.when(kind == name, _cents("value"))), F.lit(0))

    solar = F.when(F.count_if(kind == "purchase") > 0, of("view"))
    hours = (
        table(spark, sf_dir, "events")
        .groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("reading_datetime"))
        .agg(solar.alias("solar"), of("click").alias("home"), (of("signup") - of("error")).alias("battery"))
    )
    return _as_text(hours)


def _literal(spark: SparkSession, rows: list[tuple[str, ...]], schema) -> DataFrame:
    """Rows as literals of the plan."""
    structs = [F.struct(*[F.lit(cell).alias(name) for name, cell in zip(schema.names, row)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def one_tariff(spark: SparkSession) -> DataFrame:
    return _literal(spark, TARIFF_ROWS, RAW_TARIFFS)


def one_exclusion(spark: SparkSession) -> DataFrame:
    return _literal(spark, EXCLUSION_ROWS, RAW_EXCLUSIONS)


def fleet_readings(spark: SparkSession, sf_dir: str, site: Column | None = None) -> DataFrame:
    """Many sites, hourly, from ``lineitem``; an hour made of seventh lines only is a failed reading.

    A site is a supplier unless ``site`` says otherwise.
    """
    site = F.col("l_suppkey") if site is None else site
    hours = F.pmod(F.col("l_orderkey"), F.lit(24)).cast("int")
    moment = F.to_timestamp_ntz(F.col("l_shipdate")) + F.make_dt_interval(F.lit(0), hours)

    def units(flag: str):
        return F.coalesce(F.sum(F.when(F.col("l_returnflag") == flag, _cents("l_quantity"))), F.lit(0))

    percent = F.when(F.col("l_linestatus") == "O", _cents("l_discount")).otherwise(-_cents("l_tax"))
    read = F.bool_or(F.col("l_linenumber") != 7)
    hourly = (
        table(spark, sf_dir, "lineitem")
        .groupBy(site.alias("site_id"), moment.alias("reading_datetime"))
        .agg(
            F.when(read, units("A")).alias("solar"),
            F.when(read, units("N")).alias("home"),
            F.when(read, F.sum(percent) * 100).alias("battery"),
        )
    )
    return _kept(_as_text(hourly, SITE), sf_dir, f"fleet-{site is not None}")


def _kept(frame: DataFrame, sf_dir: str, name: str) -> DataFrame:
    """The frame itself, or its copy below the folder that ``spark.helioledger.fixtures`` names, so that a benchmark times queries."""
    spark = frame.sparkSession
    folder = spark.conf.get("spark.helioledger.fixtures", None)
    if not folder:
        return frame
    path = f"{folder}/{name}-{sf_dir.strip('/').replace('/', '-')}"
    if path not in _KEPT:  # even a write that is ignored is planned
        frame.write.mode("ignore").parquet(path)
        _KEPT.add(path)
    return spark.read.schema(frame.schema).parquet(path)


_KEPT: set[str] = set()


def area_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers in five areas: dense days, which hour skeletons do not multiply by 24."""
    return fleet_readings(spark, sf_dir, F.col("l_suppkey") % 5)


def fleet_tariffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tariffs per site: some start late, overlap, have no end or span midnight off-peak."""
    nation = F.col("s_nationkey")

    def day(first: str, shift) -> Column:
        return F.date_add(F.lit(first).cast("date"), shift.cast("int")).cast("string")

    def rate(base: str, step: str):
        return (F.lit(base).cast("decimal(6,4)") + (nation % 10) * F.lit(step).cast("decimal(6,4)")).cast("decimal(8,4)")

    wraps = nation % 5 == 0
    early = F.struct(
        day("1995-01-01", F.col("s_suppkey") % 300).alias("start_date"),
        day("1998-06-30", nation % 7).alias("end_date"),
        F.lit("00:00").alias("off_peak_start_hour"),
        F.lit("04:00").alias("off_peak_end_hour"),
        rate("0.2700", "0.0011").cast("string").alias("peak_rate"),
        rate("0.0700", "0.0009").cast("string").alias("off_peak_rate"),
        F.lit("0.1510").alias("export_rate"),
    )
    late = F.struct(
        day("1998-07-01", nation * 0).alias("start_date"),
        F.when(nation % 11 != 0, day("2001-06-30", F.col("s_suppkey") % 90)).alias("end_date"),
        F.when(wraps, F.lit("23:00")).otherwise(F.lit("01:00")).alias("off_peak_start_hour"),
        F.when(wraps, F.lit("05:00")).otherwise(F.lit("06:00")).alias("off_peak_end_hour"),
        rate("0.2500", "0.0013").cast("string").alias("peak_rate"),
        rate("0.0400", "0.0007").cast("string").alias("off_peak_rate"),
        F.lit("0.1500").alias("export_rate"),
    )
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("site_id"), F.inline(F.array(early, late)))


def fleet_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outages from ``orders``: a customer number names a site; the price sets the length in hours."""
    start = F.to_timestamp_ntz(F.col("o_orderdate")) + F.make_dt_interval(F.lit(0), F.pmod("o_orderkey", F.lit(24)).cast("int"))
    end = start + F.make_dt_interval(F.lit(0), F.pmod(F.floor("o_totalprice"), F.lit(1000)).cast("int"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("site_id"),
        F.to_date(start).cast("string").alias("start_date"),
        F.concat(_clock(start), F.lit(":00")).alias("start_time"),
        F.to_date(end).cast("string").alias("end_date"),
        F.concat(_clock(end), F.lit(":00")).alias("end_time"),
        F.col("o_orderpriority").alias("exclusion_reason"),
    )


def parsed(raw: DataFrame, keys=()) -> DataFrame:
    """Raw text as the tolerant load would type it."""
    return raw.select(
        *keys,
        F.col("date").cast("date").alias("date"),
        "hour",
        *[tolerant_float(F.col(name)).alias(name) for name in READING_VALUES],
    )


class OneSite:
    """Raw and typed tables of one site, each set up when first asked for."""

    keys: tuple[str, ...] = ()

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return site_readings(self.spark, self.sf_dir)

    @cached_property
    def raw_tariffs(self) -> DataFrame:
        return one_tariff(self.spark)

    @cached_property
    def raw_exclusions(self) -> DataFrame:
        return one_exclusion(self.spark)

    @cached_property
    def readings(self) -> DataFrame:
        return models.typed_readings(self.raw, self.keys)

    @cached_property
    def tariffs(self) -> DataFrame:
        return models.int_tariffs(models.stg_tariffs(self.raw_tariffs, self.keys), self.keys)

    @cached_property
    def exclusions(self) -> DataFrame:
        return models.int_exclusions(models.stg_exclusions(self.raw_exclusions, self.keys), self.keys)


class Fleet(OneSite):
    """The same with every supplier as a site."""

    keys = SITE

    @cached_property
    def raw(self) -> DataFrame:
        return fleet_readings(self.spark, self.sf_dir)

    @cached_property
    def raw_tariffs(self) -> DataFrame:
        return fleet_tariffs(self.spark, self.sf_dir)

    @cached_property
    def raw_exclusions(self) -> DataFrame:
        return fleet_exclusions(self.spark, self.sf_dir)
