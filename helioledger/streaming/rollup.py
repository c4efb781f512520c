"""Daily sums kept up to date from a stream of valued hours.

Sums can be summed, so each micro-batch writes its own daily sums and the mart adds
them up.  No state is held between batches, and a late reading counts whenever it
comes: there is no watermark behind which rows would be dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from helioledger.functions.numbers import total_of_totals
from helioledger.operators.rollups import daily_rollup
from helioledger.schemas import MEASURES


def write_partial_sums(
    readings: DataFrame,
    value_hours: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    exact: bool = False,
) -> StreamingQuery:
    """Write the daily sums of each micro-batch; ``value_hours`` turns readings into valued hours.

    A batch that runs again overwrites its own folder, so it is never counted twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        sums = daily_rollup(value_hours(batch), keys, exact)
        sums.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    writer = readings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def rollup_from_partials(spark: SparkSession, target: str, keys: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """The daily rollup over all batches so far."""
    sums = [total_of_totals(F.col(name), exact).alias(name) for name in MEASURES]
    partials = spark.read.parquet(target)
    return partials.groupBy(*keys, "reading_date").agg(*sums, F.sum("readings").alias("readings"))
