"""Rendezvous hashing of stable record keys over weighted shards, with DataFrame functions only.

Every shard draws a number for every key; the largest wins.  A draw depends on the key and that shard alone,
so a shard that is added only takes the records whose largest draw is its own, and no other record moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioledger.llm.tables import read, running

SHARDS = 16


def draw(key: Column, shard: Column) -> Column:
    """A number between 0 and 1 from 53 bits of a hash of key and shard; a null key is a key of its own."""
    return (F.shiftrightunsigned(F.xxhash64(key, shard), 11).cast("double") + 0.5) / float(1 << 53)


def _scores(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    shards = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights, first)])
    return F.transform(shards, lambda s: F.struct((-s.weight / F.ln(draw(key, s.shard))).alias("score"), s.shard.alias("shard")))


def rendezvous(rows: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float] = ()) -> DataFrame:
    """Add ``shard`` and, with the shards of ``grown`` added, ``grown_shard``.

    Shards take records in proportion to their weights, which must be above 0.  Rows with equal keys share a
    shard, however many they are; null keys count as equal.  Columns with these names are replaced.
    """
    if not weights or min(*weights, *grown, 1.0) <= 0:
        raise ValueError("every shard needs a weight above 0")
    best = rows.withColumn("_best", F.array_max(_scores(F.col(key), weights)))
    out = best.withColumn("shard", F.col("_best.shard"))
    if grown:
        more = F.array_max(_scores(F.col(key), grown, len(weights)))
        out = out.withColumn("grown_shard", F.greatest(F.col("_best"), more)["shard"])
    return out.drop("_best")


def number_slots(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``slot``: gapless from 0 in each shard, in the given order; rows equal in it come in any order."""
    return running(rows, ["shard"], order).withColumnRenamed("_slot", "slot").drop("_before")


def op4_rendezvous_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 equal shards, law ``key``; slots by doc_id.  A null text has no bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long").alias("size")
    narrow = read(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", size, F.crc32(text.cast("binary")).alias("text_crc32"))
    dealt = rendezvous(narrow, "doc_id", [1.0] * SHARDS, grown=[1.0])
    return number_slots(dealt, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )

