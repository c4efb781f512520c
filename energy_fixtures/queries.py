"""The registered queries: name to a function of session and data folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from energy_fixtures import adapters
from energy_fixtures.adapters import SITE, Fleet, OneSite, parsed, table
from helioledger.functions import labels, parsing
from helioledger.operators import cleaning, coverage, finance, ordering, payback, quality, rollups
from helioledger.plans import collection, models, refresh, warehouse
from helioledger.schemas import PARSED_READINGS, READING_VALUES
from helioledger.session import scratch_path
from helioledger.sinks import readings as sinks
from helioledger.sources import daily_json, marts, seeds
from helioledger.streaming import ingest, rollup as stream_rollup

Query = Callable[[SparkSession, str], DataFrame]


def _cleaned(site: OneSite, **how) -> DataFrame:
    return cleaning.solar_cleaned(site.readings, site.tariffs, site.exclusions, site.keys, **how)


def _costs(site: OneSite, **how) -> DataFrame:
    return finance.cost_savings(_cleaned(site, **how), site.keys)


def _rollup(site: OneSite) -> DataFrame:
    return rollups.daily_rollup(_costs(site, slotted_rows=True), site.keys, exact=True)


def _epoch_day(forecast: DataFrame) -> DataFrame:
    """The forecast date as days since 1970: a tiny saving puts it past the years Python can hold."""
    day = F.unix_date(F.to_date("forecast_payback_date")).cast("long")
    return forecast.withColumn("forecast_payback_date", day).withColumnRenamed("forecast_payback_date", "forecast_epoch_day")


def _models(kind: type[OneSite], suffix: str = "") -> dict[str, Query]:
    """Intermediate models and marts over one site or the fleet."""

    def on(build: Callable[[OneSite], DataFrame]) -> Query:
        return lambda spark, sf_dir: build(kind(spark, sf_dir))

    k = kind.keys
    plain = _epoch_day if k else (lambda frame: frame)
    found = {
        "solar_cleaned": _cleaned,
        "cost_savings": _costs,
        "daily_savings": lambda s: rollups.daily_savings(_rollup(s), k),
        "monthly_savings": lambda s: rollups.monthly_savings(_costs(s), k, exact=True),
        "total_savings": lambda s: rollups.total_savings(_costs(s), k, exact=True),
        "payback_forecast_development": lambda s: plain(payback.payback_forecast_development(_rollup(s), k, exact=True)),
        "payback_forecast_current": lambda s: payback.payback_forecast_current(_rollup(s), k, exact=True),
        "payback_current_join": lambda s: payback.payback_on_data_date(
            payback.payback_forecast_development(_rollup(s), k, exact=True, ordered=False),
            rollups.data_date(_cleaned(s), k),
            k,
        ),
        "total_solar_generation": lambda s: rollups.total_solar_generation(_cleaned(s), k, exact=True),
        "data_date": lambda s: rollups.data_date(_cleaned(s), k),
        "hourly_generation_by_day": lambda s: rollups.hourly_generation_by_day(_cleaned(s), k, exact=True),
        "hourly_generation_by_month": lambda s: rollups.hourly_generation_by_month(_cleaned(s), k, exact=True),
        "hourly_generation_by_month_avg": lambda s: rollups.hourly_generation_by_month(_cleaned(s), k, True, "avg"),
        "excluded_readings_removed": lambda s: cleaning.drop_excluded(s.readings, s.exclusions, k),
        "tariff_range_join": lambda s: cleaning.attach_tariff(s.readings, s.tariffs, k),
        "tariff_day_join": lambda s: cleaning.attach_tariff(s.readings, s.tariffs, k, grain="day"),
    }
    return {name + suffix: on(build) for name, build in found.items()}


# ------------------------------------------------------------------ files and tables


def _parsed_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(adapters.site_readings(spark, sf_dir))


def _saved_json(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "daily-json")
    sinks.save_daily_json(_parsed_site(spark, sf_dir), path)
    return path


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_json.read_daily_json(spark, _saved_json(spark, sf_dir))


def json_roundtrip_small_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days in several arrays each, read with the defaults."""
    path = scratch_path(spark, "small-arrays")
    sinks.save_daily_json(_parsed_site(spark, sf_dir), path, array_entries=10)
    return daily_json.read_daily_json(spark, path)


def _saved_areas(spark: SparkSession, sf_dir: str) -> str:
    """Even and odd hours as two sites, in several arrays a day."""
    path = scratch_path(spark, "area-json")
    sites = _parsed_site(spark, sf_dir).withColumn("site_id", F.substring("hour", 1, 2).cast("bigint") % 2)
    sinks.save_daily_json(sites, path, SITE, array_entries=10)
    return path


def json_roundtrip_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_json.read_daily_json(spark, _saved_areas(spark, sf_dir), keys={"site_id": "bigint"})


def strict_json_load_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(daily_json.read_raw_json(spark, _saved_areas(spark, sf_dir)))


def _odd_json(spark: SparkSession, sf_dir: str) -> str:
    """Days of all sites as lines, of which most sites' are broken or odd in one way."""
    path = scratch_path(spark, "odd-json")
    days = sinks.day_arrays(adapters.fleet_readings(spark, sf_dir).withColumn("date", F.col("date").cast("date")), SITE)
    text = F.col("value")
    odd = _spelled(F.col("site_id") % 8, {
        0: text,
        1: F.substring(text, F.lit(1), F.length(text) - 1),
        2: F.substring(text, F.lit(2), F.length(text) - 2),
        3: F.concat(F.lit('[1,"x",null,[2],"{}",'), F.substring(text, F.lit(2), F.length(text))),
        4: F.concat(text, F.lit(" x")),
        5: F.regexp_replace(text, r'"(-?\d+\.\d+)"', "$1"),
        6: F.replace(text, F.lit('"hour":"'), F.lit('"hour":"x')),
        7: F.regexp_replace(text, r'"solar":[^,]*', '"solar":true'),
    })
    days.select(odd.alias("value")).write.text(path)
    return path


def tolerant_json_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_json.read_daily_json(spark, _odd_json(spark, sf_dir), "part-*", "lines", {"site_id": "bigint"})


def loaded_beside_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = daily_json.read_with_rejects(spark, _odd_json(spark, sf_dir), "part-*", "lines", {"site_id": "bigint"})
    return kept.drop("source_file", "array", "position")


def rejected_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many texts and entries the tolerant load skips, by reason and place in the array."""
    _, rejects = daily_json.read_with_rejects(spark, _odd_json(spark, sf_dir), "part-*", "lines", {"site_id": "bigint"})
    return rejects.groupBy("reason", "position").agg(F.count("*").alias("rejected"))


def strict_json_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(daily_json.read_raw_json(spark, _saved_json(spark, sf_dir)))


def files_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_json.present_dates(spark, _saved_json(spark, sf_dir))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "readings-csv")
    sinks.write_csv(_parsed_site(spark, sf_dir), path)
    return spark.read.schema(PARSED_READINGS).option("header", True).csv(path)


def csv_text_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "fleet-csv")
    sinks.write_csv(parsed(adapters.fleet_readings(spark, sf_dir), SITE), path, SITE)
    return spark.read.schema("site_id long, date date, hour string, grid double, solar double, battery double, home double").option("header", True).csv(path)


def parquet_roundtrip_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "readings-parquet")
    sinks.write_parquet(parsed(adapters.fleet_readings(spark, sf_dir), SITE), path, SITE)
    return spark.read.parquet(path)


def _raw_table(spark: SparkSession) -> tuple[str, str]:
    path = scratch_path(spark, "raw")
    return f"raw_{path.rsplit('-', 1)[1]}", path


def raw_table_loaded_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _raw_table(spark)
    for _ in range(2):
        sinks.create_raw_table(_parsed_site(spark, sf_dir), name, path)
    return spark.table(name)


def raw_table_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the days first, then all of them, each hour twice: the second load adds the other half once."""
    name, path = _raw_table(spark)
    site = _parsed_site(spark, sf_dir)
    sinks.create_raw_table(site.filter(F.day("date") <= 15), name, path)
    sinks.append_new_readings(site.unionByName(site), name)
    return spark.table(name)


def raw_table_corrected_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days of two sites first; then the 7th and 21st of one come again, with fewer hours and other values, and replace the stored ones."""
    name, path = _raw_table(spark)
    hour = F.substring("hour", 1, 2).cast("bigint")
    sites = _parsed_site(spark, sf_dir).withColumn("site_id", hour % 2)
    sinks.create_raw_table(sites, name, path, ["date"])
    corrected = sites.filter(F.day("date").isin(7, 21) & (F.col("site_id") == 0) & (hour < 12)).withColumn("solar", F.lit(0.5))
    for _ in range(2):
        sinks.replace_days(corrected, name, SITE)
    return spark.table(name).select(*SITE, "date", "hour", *READING_VALUES)


def _bucketed(spark: SparkSession, sf_dir: str, mart: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A mart of the fleet from a raw table that is stored in buckets by site."""
    name, path = _raw_table(spark)
    fleet = Fleet(spark, sf_dir)
    sinks.create_raw_table(fleet.raw, name, path, bucket_by=SITE, buckets=8)
    readings = models.typed_readings(spark.table(name), SITE)
    return mart(cleaning.solar_cleaned(readings, fleet.tariffs, fleet.exclusions, SITE))


def ingest_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the days in one load and the rest in another; the stamps that the staging view shows, as numbers of loads."""
    name, path = _raw_table(spark)
    site = _parsed_site(spark, sf_dir)
    sinks.create_raw_table(site.filter(F.day("date") <= 15), name, path, ["date"], stamp=True)
    sinks.append_new_readings(site, name)
    staged = models.stg_readings(spark.table(name))
    stamps = sorted(row[0] for row in staged.select("ingested_at").distinct().collect())
    load = _spelled(F.col("ingested_at"), {stamp: F.lit(str(number)) for number, stamp in enumerate(stamps, 1)})
    return staged.select("date", "hour", load.alias("load"))


def seed_tariffs_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tariffs")
    raw = adapters.fleet_tariffs(spark, sf_dir)
    raw.write.option("header", True).csv(path)
    return seeds.read_tariffs(spark, path, raw.select(*SITE).schema)


def seed_exclusions_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "exclusions")
    raw = adapters.fleet_exclusions(spark, sf_dir)
    raw.write.option("header", True).csv(path)
    return seeds.read_exclusions(spark, path, raw.select(*SITE).schema)


def streamed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = ingest.stream_daily_json(spark, _saved_json(spark, sf_dir))
    target = scratch_path(spark, "streamed")
    ingest.append_readings(stream, target, scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.schema(PARSED_READINGS).parquet(target)


def streamed_first_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty days, then all from the eleventh on in other files, in two runs of the stream."""
    folder, target, state = (scratch_path(spark, label) for label in ("deliveries", "streamed-once", "stream-state"))
    site = _parsed_site(spark, sf_dir)
    for number, part in enumerate((site.filter(F.day("date") <= 20), site.filter(F.day("date") > 10))):
        sinks.save_daily_json(part, f"{folder}/{number}")
        stream = ingest.first_deliveries(ingest.stream_daily_json(spark, folder))
        ingest.append_readings(stream, target, state).awaitTermination()
    return spark.read.schema(PARSED_READINGS).parquet(target)


def streamed_daily_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    tariffs, exclusions = adapters.one_tariff(spark), adapters.one_exclusion(spark)
    stream = ingest.stream_daily_json(spark, _saved_json(spark, sf_dir))
    target = scratch_path(spark, "partial-sums")
    stream_rollup.write_partial_sums(
        stream,
        lambda batch: models.cost_savings(batch, tariffs, exclusions),
        target,
        scratch_path(spark, "stream-state"),
        exact=True,
    ).awaitTermination()
    return rollups.daily_savings(stream_rollup.rollup_from_partials(spark, target, exact=True))


def _tooltips(raw: DataFrame) -> DataFrame:
    """Chart tooltips that show these readings; a failed reading has none."""
    shown = [text for name, label in zip(READING_VALUES, ("Grd", "Sol", "Bat", "Hom")) for text in (F.lit(f"{label} : "), F.col(name))]
    tokens = F.when(F.col("solar").isNotNull(), F.array("hour", *shown))
    return raw.withColumn("tokens", tokens).withColumn("date", F.col("date").cast("date")).drop(*READING_VALUES)


def readings_from_tooltips_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = collection.readings_from_tooltips(_tooltips(adapters.area_readings(spark, sf_dir)), SITE)
    return parsed(read, SITE)


def _bounds(days: DataFrame) -> tuple[dt.date, dt.date, dt.date]:
    first, last = days.agg(F.min(F.col("date").cast("date")), F.max(F.col("date").cast("date"))).first()
    return first, first + (last - first) // 2, last


def collected_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collect the first half of the days, then whatever is missing."""
    folder = scratch_path(spark, "collected")
    tooltips = _tooltips(adapters.site_readings(spark, sf_dir))
    first, *ends = _bounds(tooltips)
    for last in ends:
        collection.collect(tooltips, folder, first, last)
    return daily_json.read_daily_json(spark, folder)


def collected_days_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site 1 collects the first half alone; then both sites collect, though site 2 has shown nothing in that half."""
    folder = scratch_path(spark, "collected-by-site")
    tooltips = _tooltips(adapters.site_readings(spark, sf_dir))
    first, middle, last = _bounds(tooltips)
    one = tooltips.withColumn("site_id", F.lit(1).cast("bigint"))
    two = tooltips.filter(F.col("date") > middle).withColumn("site_id", F.lit(2).cast("bigint"))
    collection.collect(one, folder, first, middle, SITE)
    collection.collect(one.unionByName(two), folder, first, last, SITE)
    return daily_json.read_daily_json(spark, folder, keys={"site_id": "bigint"})


def consolidated_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "consolidated")
    collection.consolidate_csv(spark, _saved_json(spark, sf_dir), path)
    return spark.read.schema(PARSED_READINGS).option("header", True).csv(path)


def consolidated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _raw_table(spark)
    collection.consolidate_table(spark, _saved_json(spark, sf_dir), name, path)
    return parsed(spark.table(name))


# ------------------------------------------------------------------ stored marts

_BUILT: dict[tuple[str, str], str] = {}


def built_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Marts of the fleet, built once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        location = scratch_path(spark, "marts")
        fleet = Fleet(spark, sf_dir)
        warehouse.build(fleet.raw, fleet.raw_tariffs, fleet.raw_exclusions, location, SITE, exact=True)
        _BUILT[key] = location
    return _BUILT[key]


def live_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build from half of the days, then add the rest beyond the span seen so far, then read the view."""
    name, path = _raw_table(spark)
    raw = adapters.site_readings(spark, sf_dir)
    middle = F.lit(_bounds(raw)[1]).cast("string")
    sinks.create_raw_table(raw.filter(F.col("date") <= middle), name, path)
    endless = adapters.one_tariff(spark).withColumn("end_date", F.lit("9999-12-31"))
    warehouse.build(spark.table(name), endless, adapters.one_exclusion(spark), scratch_path(spark, "live-marts"))
    sinks.append_new_readings(raw, name)
    return spark.table("int_finance_cost_savings").drop("ingested_at")


def _refreshed(spark: SparkSession, sf_dir: str, mart) -> DataFrame:
    """Build from all days but two in the middle, add those, and refresh what they change."""
    name, path = _raw_table(spark)
    site = OneSite(spark, sf_dir)
    raw = site.raw.withColumn("date", F.col("date").cast("date"))
    location, late = scratch_path(spark, "refreshed"), F.day("date").isin(13, 14)
    sinks.create_raw_table(raw.filter(~late), name, path, ["date"])
    refresh.refresh(spark.table(name), site.raw_tariffs, site.raw_exclusions, location, exact=True)
    sinks.append_new_readings(raw.filter(late), name)
    refresh.refresh(spark.table(name), site.raw_tariffs, site.raw_exclusions, location, exact=True)
    return mart(spark, location)


def dense_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All exclusions in one calendar, half an hour each, so that a month has very many."""
    fleet = Fleet(spark, sf_dir)
    half = F.col("start_datetime") + F.make_dt_interval(mins=F.lit(30))
    return cleaning.drop_excluded(fleet.readings, fleet.exclusions.withColumn("end_datetime", half), broadcast_bytes=0)


def tariffs_in_force_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a tariff of up to a year and a half in one calendar, so that thousands overlap in a month."""
    day = F.to_date("o_orderdate")
    rates = {"off_peak_rate": F.col("o_orderkey") % 97, "peak_rate": F.col("o_orderkey") % 101, "export_rate": F.col("o_custkey") % 103}
    many = table(spark, sf_dir, "orders").select(
        day.alias("start_date"),
        F.date_add(day, (F.col("o_custkey") % 540).cast("int")).alias("end_date"),
        F.lit(0).alias("off_peak_start_hour"),
        F.lit(4).alias("off_peak_end_hour"),
        *[value.cast("double").alias(name) for name, value in rates.items()],
    )
    days = table(spark, sf_dir, "lineitem").groupBy(F.to_timestamp_ntz(F.to_date("l_shipdate")).alias("reading_datetime")).agg(F.count("*").alias("lines"))
    held = cleaning.attach_tariff(days, many)
    sums = [F.sum(name).cast("long").alias(name) for name in rates]
    return held.groupBy("reading_datetime", "lines").agg(F.count("*").alias("tariffs"), *sums)


def _served(read) -> Query:
    return lambda spark, sf_dir: read(spark, built_warehouse(spark, sf_dir), SITE)


# ------------------------------------------------------------------ calendars, checks, parsers


def missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a week before the first order through a month after the last."""
    present = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    first, _, last = _bounds(present)
    return coverage.missing_dates(present, first - dt.timedelta(7), last + dt.timedelta(30))


def missing_dates_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a week before the first delivery of any site through a month after the last."""
    present = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("site_id"), F.to_date("l_shipdate").alias("date"))
    first, _, last = _bounds(present)
    return coverage.missing_dates(present, first - dt.timedelta(7), last + dt.timedelta(30), SITE)


def dates_to_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates without an order up to yesterday, the newest first."""
    present = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    return ordering.numbered(coverage.newest_first(coverage.missing_dates(present, _bounds(present)[0])))


def hour_skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.hour_skeleton(_parsed_site(spark, sf_dir))


def hour_skeleton_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.hour_skeleton(parsed(adapters.area_readings(spark, sf_dir), SITE), SITE)


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    fleet = Fleet(spark, sf_dir)
    # The hours are joined once; what the checks ask of them is one column.
    path = scratch_path(spark, "checked-hours")
    _costs(fleet).select(*SITE, "reading_datetime").write.parquet(path)
    hours = spark.read.parquet(path)
    relations = {
        "raw_solar_data": fleet.raw,
        "raw_tariffs": fleet.raw_tariffs,
        "raw_exclusions": fleet.raw_exclusions,
        "int_admin_tariffs": fleet.tariffs,
        "int_admin_exclusions": fleet.exclusions,
        "int_finance_cost_savings": hours,
        "data_date": rollups.data_date(hours, SITE),
    }
    return quality.check_all(relations).filter("test = 'not_null'").drop("passed")


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(adapters.fleet_tariffs(spark, sf_dir), "raw_tariffs", ["start_date"])


def dq_unique_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(adapters.fleet_tariffs(spark, sf_dir), "raw_tariffs", ["start_date"], SITE)


def _spelled(choice, spellings) -> Column:
    """The spelling whose place equals ``choice``; NULL past the last."""
    text = F.lit(None).cast("string")
    for place, spelling in spellings.items():
        text = F.when(choice == place, spelling).otherwise(text)
    return text


def tolerant_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    number, key = F.col("l_linenumber"), F.col("l_orderkey")
    quantity, tax = (F.col(name).cast("decimal(18,2)").cast("string") for name in ("l_quantity", "l_tax"))
    text = _spelled(number, {
        1: quantity, 2: F.concat(F.lit(" "), tax, F.lit(" ")), 3: F.when(key % 2 == 0, "").otherwise("  "),
        4: F.concat(F.lit("x"), tax), 5: F.concat(quantity, F.lit("d")), 6: F.concat(F.lit("1_"), quantity, F.lit("e1")),
    })
    rows = table(spark, sf_dir, "lineitem").select(key, number, text.alias("text"))
    return rows.withColumn("value", parsing.tolerant_float(F.col("text")))


def tolerant_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    hour = (key % 24).cast("string")
    text = _spelled(key % 6, {
        0: F.concat(F.lpad(hour, 2, "0"), F.lit(":00")), 1: F.concat(hour, F.lit(":5")),
        2: F.concat((key % 9 + 24).cast("string"), F.lit(":00")), 3: F.col("o_orderpriority"),
        4: F.concat(F.lit("07:"), (key % 90).cast("string")),
    })
    rows = table(spark, sf_dir, "orders").select(key, text.alias("text"))
    return rows.withColumn("hour", parsing.clock_text(F.col("text")))


def _order_dates(spark: SparkSession, sf_dir: str, spellings) -> DataFrame:
    choice = F.col("o_orderkey") % (6 if len(spellings) < 6 else 8)
    return table(spark, sf_dir, "orders").select("o_orderkey", _spelled(choice, spellings).alias("text"))


def _dated(*pattern: str) -> Column:
    return F.date_format("o_orderdate", *pattern)


def iso_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    # The Thursday of the same week lies in the year the week is counted in.
    week_year = F.year(F.date_add(day, F.lit(3) - F.weekday(day)))
    week = F.concat_ws("-", week_year, F.concat(F.lit("W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0")), F.weekday(day) + 1)
    texts = _order_dates(spark, sf_dir, {
        0: _dated("yyyy-MM-dd"), 1: _dated("yyyyMMdd"), 2: week,
        3: F.concat(_dated("yyyy-MM"), F.lit("-31")), 4: _dated("dd/MM/yyyy"),
    })
    return texts.withColumn("date", parsing.iso_date(F.col("text")))


def multi_format_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _order_dates(spark, sf_dir, {
        0: _dated("dd | MM yyyy"), 1: _dated("dd| MM yyyy"), 2: _dated("dd|MM yyyy"), 3: _dated("dd |MM yyyy"),
        4: _dated("dd/MM yyyy"), 5: _dated("dd MM yyyy"), 6: F.concat(F.lit("31 | "), _dated("MM yyyy")), 7: _dated("yyyy-MM-dd"),
    })
    return texts.withColumn("date", parsing.spaced_date(F.col("text")))


def label_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    variant = F.col("site_id") % 4
    battery = F.when(variant == 3, "BATTERY : ").otherwise("Bat : ")
    tokens = F.array_compact(F.array(
        "hour", F.lit("Grd : "), "grid", F.lit("Sol : "), "solar", F.when(variant == 1, "Wnd : "), F.when(variant == 1, "7.70"),
        battery, "battery", F.lit("Hom : "), "home", F.when(variant == 2, "Grd : "), F.when(variant == 2, "9.99"),
    ))
    rows = adapters.fleet_readings(spark, sf_dir).select(*SITE, "date", labels.tooltip_fields(tokens).alias("fields"))
    return rows.select(*SITE, "date", "fields.*")


def _rounded(frame: DataFrame) -> DataFrame:
    """Sums of doubles to six places, past which their order tells; adding 0 takes the sign off a zero."""
    doubles = {name: F.round(name, 6) + 0.0 for name, kind in frame.dtypes if kind == "double"}
    return frame.withColumns(doubles)


def _flag(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(*SITE, "reading_datetime", "is_off_peak")


def _in_order(frame: DataFrame, *columns: str) -> DataFrame:
    """Sorted rows with their place."""
    return ordering.numbered(frame).select(F.col("place").cast("int").alias("place"), *columns)


def queries() -> dict[str, Query]:
    found = {**_models(OneSite), **_models(Fleet, "_by_site")}
    found |= {
        "stg_readings": lambda s, d: models.stg_readings(OneSite(s, d).raw).drop("ingested_at"),
        "typed_readings": lambda s, d: OneSite(s, d).readings,
        "off_peak_flag": lambda s, d: _cleaned(OneSite(s, d)).select("reading_datetime", "is_off_peak"),
        "stg_readings_by_site": lambda s, d: models.stg_readings(Fleet(s, d).raw, SITE).drop("ingested_at"),
        "stg_tariffs_by_site": lambda s, d: models.stg_tariffs(Fleet(s, d).raw_tariffs, SITE),
        "stg_exclusions_by_site": lambda s, d: models.stg_exclusions(Fleet(s, d).raw_exclusions, SITE),
        "int_tariffs_by_site": lambda s, d: Fleet(s, d).tariffs,
        "int_exclusions_by_site": lambda s, d: Fleet(s, d).exclusions,
        # A broadcast limit of zero forces the plan used when the reference tables are large.
        "solar_cleaned_by_site_shuffled": lambda s, d: _cleaned(Fleet(s, d), broadcast_bytes=0, split_above=None),
        "solar_cleaned_by_site_split": lambda s, d: _cleaned(Fleet(s, d), broadcast_bytes=0, split_above=5),
        "monthly_from_daily_by_site": lambda s, d: rollups.monthly_from_daily(_rollup(Fleet(s, d)), SITE, exact=True),
        "total_from_daily_by_site": lambda s, d: rollups.total_from_daily(_rollup(Fleet(s, d)), SITE, exact=True),
        "generation_from_daily_by_site": lambda s, d: rollups.generation_from_daily(_rollup(Fleet(s, d)), SITE, exact=True),
        "newest_missing_date_by_site": lambda s, d: coverage.newest_missing_date(missing_dates_by_site(s, d), SITE),
        "daily_savings_default_by_site": lambda s, d: _rounded(rollups.daily_savings(rollups.daily_rollup(_costs(Fleet(s, d)), SITE), SITE)),
        "monthly_savings_default_by_site": lambda s, d: _rounded(rollups.monthly_savings(_costs(Fleet(s, d)), SITE)),
        "total_savings_default_by_site": lambda s, d: _rounded(rollups.total_savings(_costs(Fleet(s, d)), SITE)),
        "hourly_generation_by_month_default_by_site": lambda s, d: _rounded(rollups.hourly_generation_by_month(_cleaned(Fleet(s, d)), SITE)),
        "savings_by_level_by_site": lambda s, d: rollups.savings_by_level(_costs(Fleet(s, d)), SITE, exact=True),
        "savings_by_level": lambda s, d: rollups.savings_by_level(_costs(OneSite(s, d)), exact=True),
        "tariff_open_ended_by_site": lambda s, d: cleaning.attach_tariff(Fleet(s, d).readings, Fleet(s, d).tariffs, SITE, open_ended=True),
        "off_peak_wrapped_by_site": lambda s, d: _flag(_cleaned(Fleet(s, d), wrap_midnight=True)),
        "off_peak_end_exclusive_by_site": lambda s, d: _flag(_cleaned(Fleet(s, d), end_inclusive=False)),
        "payback_remaining_by_site": lambda s, d: payback.payback_forecast_current(_rollup(Fleet(s, d)), SITE, exact=True, basis="remaining"),
        "generation_per_day_by_site": lambda s, d: rollups.generation_from_daily(_rollup(Fleet(s, d)), SITE, exact=True, per_day=True),
        "served_daily_savings_in_order": lambda s, d: _in_order(marts.daily_savings(s, built_warehouse(s, d), SITE), *SITE, "reading_date"),
        "payback_development_in_order": lambda s, d: _in_order(payback.payback_forecast_development(_rollup(OneSite(s, d)), exact=True), "reading_date", "day_number"),
        "payback_development_in_order_by_site": lambda s, d: _in_order(
            payback.payback_forecast_development(_rollup(Fleet(s, d)), SITE, exact=True, ordered=True), *SITE, "reading_date", "day_number"
        ),
        "readings_in_file_order": lambda s, d: _in_order(collection.in_file_order(s, _saved_json(s, d)), "date", "hour"),
        "refreshed_forecast_development": lambda s, d: _refreshed(s, d, marts.payback_forecast_development),
        "refreshed_monthly_savings": lambda s, d: _refreshed(s, d, marts.monthly_savings),
        "bucketed_generation_by_site": lambda s, d: _bucketed(s, d, lambda cleaned: rollups.total_solar_generation(cleaned, SITE, exact=True)),
        "bucketed_daily_savings_by_site": lambda s, d: _bucketed(
            s, d, lambda cleaned: rollups.daily_savings(rollups.daily_rollup(finance.cost_savings(cleaned, SITE), SITE, exact=True), SITE)
        ),
        "served_data_date": _served(marts.data_date),
        "served_daily_savings": _served(marts.daily_savings),
        "served_monthly_savings": _served(marts.monthly_savings),
        "served_total_savings": _served(marts.total_savings),
        "served_payback_forecast": _served(marts.payback_forecast),
        "served_payback_forecast_development": _served(lambda *at: _epoch_day(marts.payback_forecast_development(*at))),
    }
    for query in (
        json_roundtrip, json_roundtrip_small_arrays, json_roundtrip_by_site, strict_json_load_by_site, collected_days_by_site, live_views,
        dense_exclusions, tariffs_in_force_by_day, tolerant_json_load, loaded_beside_rejects, rejected_entries, strict_json_load, files_present, csv_roundtrip, csv_text_by_site, parquet_roundtrip_by_site,
        raw_table_loaded_twice, raw_table_appended, raw_table_corrected_by_site, ingest_stamps, seed_tariffs_csv, seed_exclusions_csv, streamed_readings,
        streamed_first_deliveries, streamed_daily_savings, readings_from_tooltips_by_site, collected_days, consolidated_csv, consolidated_table, missing_dates, missing_dates_by_site, dates_to_collect, hour_skeleton, hour_skeleton_by_site,
        dq_not_null, dq_unique, dq_unique_by_site, tolerant_float, tolerant_hour, iso_date, multi_format_date, label_tokens,
    ):
        found[query.__name__] = query
    return found
