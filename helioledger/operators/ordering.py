"""Places of rows in the order of a whole table, without a task that sees all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioledger.session import scratch_path


def numbered(rows: DataFrame, place: str = "place") -> DataFrame:
    """Rows with their place from 1, in the order in which they come, partition after partition.

    After ``orderBy`` that is the global order: Spark deals the rows by range and sorts each range.  The rows are
    written with their place in the partition; what comes to the driver is one row per partition, with its first place.
    A column named like the place is replaced.
    """
    spark = rows.sparkSession
    landed = scratch_path(spark, "numbered")
    kept = [name for name in rows.columns if name != place]
    marks = {"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}
    rows.select(F.struct(*kept).alias("row"), *[mark.alias(name) for name, mark in marks.items()]).write.parquet(landed)
    marked = spark.read.parquet(landed)
    sizes = marked.groupBy("part").agg(F.min("at").alias("first"), F.count("*").alias("size")).collect()
    starts, before = [], 0
    for part, first, size in sorted(sizes):
        starts.append((part, before - first + 1))
        before += size
    shifts = F.broadcast(spark.createDataFrame(starts, "part int, shift long"))
    return marked.join(shifts, "part").select("row.*", (F.col("at") + F.col("shift")).alias(place))
