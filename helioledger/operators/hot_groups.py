"""Split groups that are too large for one task.

A group of more than ``split_above`` rows is cut into slices of about that size.
There are at most (rows / split_above) such groups; their list is written to the
shared folder, which fixes it for every later reader and tells the optimizer its
true size, so that only a list below the broadcast threshold is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from helioledger.session import scratch_path

SLICE = "_slice"


def find_hot_groups(rows: DataFrame, group: Sequence[str], split_above: int, seen: Observation | None = None) -> DataFrame | None:
    """Hot groups with their number of slices, or None.  Counting combines within the map tasks.

    ``seen`` is told the number of all ``rows`` on the way.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "hot-groups")
    renamed = [F.col(name).alias(f"_hot_{name}") for name in group]
    slices = F.ceil(F.col("count") / split_above).cast("int").alias("_slices")
    counts = rows.groupBy(*group).count()
    if seen is not None:
        counts = counts.observe(seen, F.coalesce(F.sum("count"), F.lit(0)).alias("rows"))
    counts.filter(F.col("count") > split_above).select(*renamed, slices).write.parquet(path)
    hot = spark.read.parquet(path)
    return None if hot.isEmpty() else hot


def _same(group: dict[str, Column]) -> list[Column]:
    return [column.eqNullSafe(F.col(f"_hot_{name}")) for name, column in group.items()]


def slice_rows(rows: DataFrame, group: Sequence[str], hot: DataFrame) -> DataFrame:
    """Give each row of a hot group one of its slices; all other rows have slice 0.

    The row's hash spreads different rows and the partition id spreads copies.  Both
    are the same again when a lost task reruns, unlike a random number.
    """
    spot = F.xxhash64(F.spark_partition_id(), *[F.col(name) for name in rows.columns])
    joined = rows.withColumn("_spot", spot).join(hot, _same({name: F.col(name) for name in group}), "left")
    place = F.coalesce(F.pmod(F.col("_spot"), F.col("_slices")), F.lit(0)).cast("int")
    return joined.select(*rows.columns, place.alias(SLICE))


def repeat_for_slices(side: DataFrame, group: dict[str, str], hot: DataFrame, name: str) -> DataFrame:
    """Repeat each row once per slice of its group; ``group`` maps group names to the side's columns."""
    match = _same({key: F.col(column) for key, column in group.items()})
    slices = F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)
    return side.join(hot, match, "left").select(*side.columns, F.explode(slices).alias(name))
