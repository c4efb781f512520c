"""Rendezvous hashing against plain hashing of every key and shard."""

import math
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from helioledger.llm import sharding
from tests.llm.data import frame


def best(key, weights):
    seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
    draws = [((xxhash.xxh64_intdigest(struct.pack("<i", i), seed=seed) >> 11) + 0.5) / 2**53 for i in range(len(weights))]
    return max((-w / math.log(u), i) for i, (w, u) in enumerate(zip(weights, draws, strict=True)))[1]


def test_shards_and_slots(spark):
    docs = frame(spark)
    dealt = sharding.rendezvous(docs, "doc_id", [1.0, 2.0, 1.0], grown=[1.5])
    assert dealt.columns == [*docs.columns, "grown_shard"]
    got = sharding.number_slots(dealt.select("doc_id", "shard", "grown_shard"), ["doc_id"]).collect()
    assert len(got) == docs.count()
    for row in got:
        assert (row.shard, row.grown_shard) == (best(row.doc_id, [1, 2, 1]), best(row.doc_id, [1, 2, 1, 1.5]))
        assert row.grown_shard in (row.shard, 3)
    for shard in range(3):
        own = sorted((r.slot, r.doc_id if r.doc_id is not None else -1) for r in got if r.shard == shard)
        assert [slot for slot, _ in own] == list(range(len(own)))
        assert [i for _, i in own] == sorted(i for _, i in own)


def test_weights_hold_and_few_rows_move(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    dealt = sharding.rendezvous(rows, "doc_id", [1.0, 1.0, 2.0], grown=[1.0])
    counts = {r.shard: r["count"] for r in dealt.groupBy("shard").count().collect()}
    assert abs(counts[2] / 20_000 - 0.5) < 0.02 and abs(counts[0] / 20_000 - 0.25) < 0.02
    assert abs(dealt.filter("shard <> grown_shard").count() / 20_000 - 0.2) < 0.02


def test_empty_and_bad(spark):
    none = spark.range(0).withColumnRenamed("id", "doc_id")
    assert sharding.number_slots(sharding.rendezvous(none, "doc_id", [1.0]), ["doc_id"]).count() == 0
    with pytest.raises(ValueError, match="weight"):
        sharding.rendezvous(none, "doc_id", [1.0, 0.0])


def test_a_hot_key_is_numbered_without_gaps(spark):
    rows = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"))
    got = sharding.number_slots(sharding.rendezvous(rows, "doc_id", [1.0] * 4), ["doc_id"])
    bounds = got.groupBy("shard").agg(F.min("slot"), F.max("slot"), F.count("*"), F.countDistinct("slot")).collect()
    assert all((low, high + 1, n) == (0, n, distinct) for _, low, high, n, distinct in bounds)
