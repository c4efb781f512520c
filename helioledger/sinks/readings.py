"""Sinks for readings as they are collected and consolidated."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helioledger.functions.numbers import float_text
from helioledger.operators.hot_groups import SLICE, find_hot_groups, slice_rows
from helioledger.schemas import READING_VALUES
from helioledger.session import scratch_path
from helioledger.sources.daily_json import present_dates, present_days

# Entries per JSON array; a day of more readings goes on in further arrays.
ARRAY_ENTRIES = 10_000


def save_daily_json(
    readings: DataFrame,
    path: str,
    keys: Sequence[str] = (),
    existing: str = "error",
    array_entries: int = ARRAY_ENTRIES,
) -> None:
    """JSON arrays of each key's day, one on a line, in partition folders of year, month and day.

    A key's day that is already below ``path``, under either kind of file name, is an
    error, or left alone with ``existing="skip"``.  The readings are evaluated once.
    """
    if existing not in ("error", "skip"):
        raise ValueError(f"existing must be 'error' or 'skip', not {existing!r}")
    spark = readings.sparkSession
    landed = scratch_path(spark, "days-to-save")
    readings.write.parquet(landed)
    readings = spark.read.parquet(landed)
    first, last = readings.agg(F.min("date"), F.max("date")).first()
    stored = stored_days(spark, path, {key: readings.schema[key].dataType.simpleString() for key in keys}, first, last)
    if stored is not None:
        group = [*keys, "date"]
        if existing == "error" and not readings.select(*group).distinct().join(stored, group, "left_semi").isEmpty():
            raise FileExistsError(f"some of these days are already below {path}")
        readings = readings.join(stored, group, "left_anti")
    arrays = day_arrays(readings, keys, array_entries)
    patterns = {"year": "yyyy", "month": "MM", "day": "dd"}
    columns = [F.date_format("date", pattern).alias(name) for name, pattern in patterns.items()]
    # Rebalancing gathers a day in few files and still splits a day that is too large.
    packed = arrays.select("value", *columns).hint("rebalance", *patterns)
    packed.write.partitionBy(*patterns).mode("append").text(path)


def stored_days(
    spark: SparkSession, path: str, keys: dict[str, str], first: dt.date | Column, last: dt.date | Column
) -> DataFrame | None:
    """Days already below ``path``; None if there is no such folder.

    Without keys the names tell.  With keys the files of those days are read, as a
    file of one site says nothing about another.
    """
    try:
        return present_days(spark, path, keys, first, last) if keys else present_dates(spark, path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise


def day_arrays(readings: DataFrame, keys: Sequence[str] = (), array_entries: int = ARRAY_ENTRIES) -> DataFrame:
    """JSON text of each key's day, hours in order and missing values kept as null.

    Days are counted first.  Normal days (24 rows) make one array; one of more than
    ``array_entries`` rows is cut into several before any of it is collected.
    """
    group = [*keys, "date"]
    entry = F.struct("hour", *keys, F.date_format("date", "yyyy-MM-dd").alias("date"), *READING_VALUES)
    hot = find_hot_groups(readings, group, max(1, array_entries // 2))
    if hot is None:
        parts, entries = readings.withColumn(SLICE, F.lit(0)), F.collect_list(entry)
    else:
        parts = slice_rows(_batches_of_copies(readings, max(1, array_entries // 10)), group, hot)
        entries = F.flatten(F.collect_list(F.array_repeat(entry, F.col("_copies"))))
    shown = F.transform(
        F.sort_array(entries),
        lambda e: F.struct(*[e[name].alias(name) for name in (*keys, "date", "hour", *READING_VALUES)]),
    )
    text = F.to_json(shown, {"ignoreNullFields": "false"})
    return parts.groupBy(*group, SLICE).agg(text.alias("value")).select(*group, "value")


def _batches_of_copies(readings: DataFrame, batch: int) -> DataFrame:
    """Equal rows as one row per ``batch`` of them: copies have nothing else to be told apart by."""
    counted = readings.groupBy(*readings.columns).count()
    last = F.floor((F.col("count") - 1) / batch)
    pieces = counted.withColumn("_piece", F.explode(F.sequence(F.lit(0), last)))
    copies = F.least(F.lit(batch), F.col("count") - F.col("_piece") * batch).cast("int")
    return pieces.withColumn("_copies", copies).drop("count")


def write_csv(readings: DataFrame, path: str, keys: Sequence[str] = ()) -> bool:
    """CSV with header, ISO dates and empty text for NULL; overwrites.

    Without readings nothing is written, and the answer is False.
    """
    if readings.isEmpty():
        return False
    columns = [*keys, F.date_format("date", "yyyy-MM-dd").alias("date"), "hour"]
    columns += [float_text(F.col(name)).alias(name) for name in READING_VALUES]
    text = readings.select(*columns)
    text.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)
    return True


def write_parquet(readings: DataFrame, path: str, keys: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
    """Typed parquet: DATE, the hour as a time on 1 January 1970, four doubles."""
    hour = F.concat(F.lit("1970-01-01 "), F.col("hour")).cast("timestamp_ntz")
    typed = readings.select(*keys, F.col("date").cast("date").alias("date"), hour.alias("hour"), *READING_VALUES)
    if partition_by:
        typed = typed.hint("rebalance", *partition_by)
    typed.write.mode("overwrite").option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def create_raw_table(
    readings: DataFrame, table: str, path: str | None = None, partition_by: Sequence[str] = (), stamp: bool = False,
    bucket_by: Sequence[str] = (), buckets: int = 0,
) -> None:
    """Create the raw table if there is none; a second run loads nothing.

    Partitioned by date, later filters on the date and ``append_new_readings`` open
    only the days they need.  With ``stamp`` the rows keep the time of their load in ``ingested_at``,
    which later loads then fill, too, and the staging view passes on.  Dealt into so many ``buckets`` by the keys of
    its sites, sums by site and joins with small tables of tariffs and exclusions move no readings.  A bucket is one
    task of such a sum, so a site with far more readings than a bucket should hold is better left unbucketed.
    """
    if bool(bucket_by) != (buckets > 0):
        raise ValueError("bucket_by and buckets go together")
    if stamp:
        readings = _stamped(readings)
    if bucket_by:
        # One file a bucket: every task writes whole buckets.
        readings = readings.repartition(buckets, *bucket_by)
    elif partition_by:
        readings = readings.hint("rebalance", *partition_by)
    writer = readings.write.mode("ignore").format("parquet").partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def append_new_readings(readings: DataFrame, table: str, keys: Sequence[str] = ()) -> None:
    """Add the readings whose key, date and hour the raw table does not hold yet, one for each.

    Only the table's dates within the span of the new readings are compared.
    """
    identity = [*keys, "date", "hour"]
    readings = _as_stored(readings, table)
    first, last = readings.agg(F.min("date"), F.max("date")).first()
    stored = readings.sparkSession.table(table)
    held = stored.filter(F.col("date").between(F.lit(first), F.lit(last)) | F.col("date").isNull())
    known = held.select(*[F.col(name).alias(f"_held_{name}") for name in identity]).distinct()
    same = [F.col(name).eqNullSafe(F.col(f"_held_{name}")) for name in identity]
    rest = [name for name in stored.columns if name not in identity]
    # Of several new rows for one hour the largest counts, column by column; a value beats a missing one.
    single = readings.groupBy(*identity).agg(F.max(F.struct(*rest)).alias("_rest")).select(*identity, "_rest.*")
    fresh = single.join(known, same, "left_anti")
    fresh.select(*stored.columns).write.mode("append").insertInto(table)


def replace_days(readings: DataFrame, table: str, keys: Sequence[str] = ()) -> list[dt.date | None]:
    """Put the key's days that the readings bring in place of those stored; all other days keep their files.

    The table must be partitioned by date.  A day is replaced whole, so hours that are not brought again go; other
    keys' rows of the same dates are carried over.  A second run does the same again.  What comes to the driver is
    the dates brought, which are returned.
    """
    spark = readings.sparkSession
    stored = spark.table(table)
    if "date" not in [c.name for c in spark.catalog.listColumns(table) if c.isPartition]:
        raise ValueError(f"{table} must be partitioned by date")
    identity = [*keys, "date", "hour"]
    readings = _as_stored(readings, table)
    rest = [name for name in stored.columns if name not in identity]
    # Of several rows for one hour the largest counts, column by column, as when they are appended.
    single = readings.groupBy(*identity).agg(F.max(F.struct(*rest)).alias("_rest")).select(*identity, "_rest.*")
    brought = _landed(single.select(*stored.columns), "days-brought")
    dates = [row[0] for row in brought.select("date").distinct().collect()]
    new = brought
    if keys and dates:
        touched = F.col("date").isin([day for day in dates if day is not None])
        held = stored.filter(touched | F.col("date").isNull() if None in dates else touched)
        known = brought.select(*[F.col(name).alias(f"_new_{name}") for name in (*keys, "date")]).distinct()
        same = [F.col(name).eqNullSafe(F.col(f"_new_{name}")) for name in (*keys, "date")]
        new = _landed(brought.unionByName(held.join(known, same, "left_anti")), "days-replaced")
    if dates:
        with _dynamic_overwrite(spark):
            new.hint("rebalance", "date").select(*stored.columns).write.insertInto(table, overwrite=True)
    return dates


def _stamped(readings: DataFrame) -> DataFrame:
    """With the time of the load: one for all rows of a job, also for tasks that run again."""
    return readings.withColumn("ingested_at", F.current_timestamp())


def _as_stored(readings: DataFrame, table: str) -> DataFrame:
    """Stamped, if the table keeps stamps."""
    return _stamped(readings) if "ingested_at" in readings.sparkSession.table(table).columns else readings


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Within, overwriting a table replaces the partitions written; a table takes this from the session alone."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _landed(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
