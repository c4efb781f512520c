"""Tariff and exclusion tables as CSV files with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from helioledger.schemas import RAW_EXCLUSIONS, RAW_TARIFFS


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_tariffs(spark: SparkSession, path: str, keys: T.StructType | None = None) -> DataFrame:
    """``keys`` are the leading columns of a file for many sites."""
    return _read_csv(spark, path, T.StructType([*(keys or []), *RAW_TARIFFS]))


def read_exclusions(spark: SparkSession, path: str, keys: T.StructType | None = None) -> DataFrame:
    return _read_csv(spark, path, T.StructType([*(keys or []), *RAW_EXCLUSIONS]))
