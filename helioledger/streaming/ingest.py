"""Take in reading files as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from helioledger.sources.daily_json import DAILY_FILES, flatten_arrays, text_reader


def stream_daily_json(
    spark: SparkSession, path: str, glob: str = DAILY_FILES, layout: str = "auto", keys: dict[str, str] | None = None
) -> DataFrame:
    """The tolerant load as a stream: each file is taken once."""
    return flatten_arrays(text_reader(spark.readStream, glob, layout).load(path), keys, layout=layout)


def first_deliveries(readings: DataFrame, keys: Sequence[str] = (), remember: str = "30 days") -> DataFrame:
    """A stream of readings without the hours that came before, in whatever file.

    Keys, date and hour of what has come are held as state, for at least so long after they *arrived*.  The watermark
    follows the arrival and not the reading's own time, so late hours are never dropped, and the state is bounded by
    what arrives in that time.  An hour that comes again later passes; ``append_new_readings`` compares with all that
    is stored.  Readings without a date or an hour are told apart by their values.
    """
    unknown = F.col("date").isNull() | F.col("hour").isNull()
    values = [name for name in readings.columns if name not in (*keys, "date", "hour")]
    told = F.when(unknown, F.to_json(F.struct(*values)))
    arrived = readings.withColumns({"_told": told, "_arrived": F.current_timestamp()}).withWatermark("_arrived", remember)
    return arrived.dropDuplicatesWithinWatermark([*keys, "date", "hour", "_told"]).select(*readings.columns)


def append_readings(readings: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived to the raw table, then stop.

    The checkpoint remembers the files taken, so running it again adds only new days.
    """
    writer = readings.writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
