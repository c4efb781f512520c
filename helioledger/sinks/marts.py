"""Sinks for views and marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Publish lazy DataFrames under their names; they run when they are queried."""
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)


def write_mart(
    frame: DataFrame,
    name: str,
    location: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Replace a mart: a catalog table, or parquet below ``location``."""
    writer = frame.write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    if location:
        writer.save(f"{location}/{name}")
    else:
        writer.saveAsTable(name)
