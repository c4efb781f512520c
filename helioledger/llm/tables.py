"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import helioledger
from helioledger.session import scratch_path

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """The named columns of a table, so that whatever else it holds can't clash."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def land(frame: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage and fixes row numbers for every later reader."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that tasks can import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(helioledger.__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="helioledger-code-"), "helioledger_code.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def running(rows: DataFrame, group: Sequence[str], order: Sequence[str], value: Column | None = None) -> DataFrame:
    """Add ``_slot``, the rank from 0 in the group, and ``_before``, the sum of ``value`` over the ranks below.

    No group has to fit a task: rows are dealt by range of (group, order, number of the row), each range
    counts its own rows, and the totals of the ranges before it are added.  The rows are written twice: first
    with their number, so that the ranges are cut in the same rows that are dealt, then sorted.
    """
    numbered = land(rows.withColumn("_tie", F.monotonically_increasing_id()), "numbered")
    keys = [*group, *order, "_tie"]
    dealt = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    value = F.lit(0).cast("long") if value is None else value
    placed = dealt.withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id(), "_value": value})
    ranges = land(placed.drop("_tie"), "ranges")
    here = ranges.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"), F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    here = here.select(
        *[F.col(name).alias(f"_g_{name}") for name in group],
        F.col("_part").alias("_g_part"),
        (F.coalesce(F.sum("_n").over(earlier), zero) - F.col("_first")).alias("_shift"),
        F.coalesce(F.sum("_sum").over(earlier), zero).alias("_base"),
    )
    match = [F.col(name).eqNullSafe(F.col(f"_g_{name}")) for name in group] + [F.col("_part") == F.col("_g_part")]
    within = Window.partitionBy(*group, "_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    summed = ranges.withColumn("_inner", F.coalesce(F.sum("_value").over(within), zero))
    return summed.join(here, match).select(
        *rows.columns, (F.col("_pos") + F.col("_shift")).alias("_slot"), (F.col("_inner") + F.col("_base")).alias("_before")
    )
