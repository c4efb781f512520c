"""Near duplicates by SimHash, found by meeting in the middle.

Two fingerprints at most r bits apart meet: some value is within r/2 of both, rounded up for one and down for the
other.  Every different fingerprint emits all values within half the radius and the rows meet on the value.  All
that meet at a value within the smaller half are linked with each other through it, so one of them is linked with
the rest instead of all pairs; a value can be near 1 + 64 fingerprints at most for a radius of 2, however many copies
there are, as copies share a fingerprint.  Links are verified by their distance.  Groups are found by letting every
fingerprint link to the least that it knows, until no link changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helioledger.llm.tables import land, read, ship

SHINGLE, RADIUS, SEED = 3, 2, 42
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, signed; a bit is set if it is in more than half of the hashes of the shingles.  No words: 0."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False)) if len(words) > shingle else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded steps for very long texts
        counts += np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """All columns and ``_fingerprint``."""
    ship(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t, shingle) for t in batch.column(at).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "_fingerprint"])

    return docs.mapInArrow(run, docs.select("*", F.lit(0).cast("long").alias("_fingerprint")).schema)


def _flip(value: Column, bit: Column) -> Column:
    return value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))


def _ball(prints: DataFrame, radius: int) -> DataFrame:
    """Every fingerprint with all values within half the radius; ``outer`` marks those beyond the smaller half."""
    ring = prints.select("fp", F.col("fp").alias("value"), F.lit(-1).alias("bit"))
    rings = [ring.select("fp", "value", F.lit(False).alias("outer"))]
    for distance in range(1, radius - radius // 2 + 1):
        bits = F.explode(F.sequence(F.col("bit") + 1, F.lit(63))).alias("next")  # ascending, so that no value comes twice
        ring = ring.filter("bit < 63").select("fp", "value", bits).select("fp", _flip(F.col("value"), F.col("next")).alias("value"), F.col("next").alias("bit"))
        rings.append(ring.select("fp", "value", F.lit(distance > radius // 2).alias("outer")))
    out = rings[0]
    for more in rings[1:]:
        out = out.unionByName(more)
    return out


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of different fingerprints at most ``radius`` bits apart that connect all such pairs."""
    meet = Window.partitionBy("value")
    met = _ball(prints, radius).withColumn("a", F.min(F.when(~F.col("outer"), F.col("fp"))).over(meet))
    near = met.filter("a <> fp").select("a", F.col("fp").alias("b")).distinct()
    return near.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) for every fingerprint with a link; the root is the least of its group.

    Large and small stars take turns: every node's larger neighbours are linked to the least node it knows, then
    its smaller ones.  Each turn is written, so that a lost executor costs one turn; turns grow with the logarithm
    of the longest chain.  Nothing but a count and a sum comes to the driver.
    """

    def least(pairs: DataFrame, own: bool) -> DataFrame:
        found = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return found.select("u", F.least("u", "m").alias("m") if own else "m")

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    pairs = land(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = state(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(least(both, True), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        small = least(large, False)
        moved = large.join(small, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = land(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = state(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("u").alias("fp"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct()
    )


def groups(printed: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) for every different fingerprint of a written table with ``_fingerprint``; alone, it is its own root."""
    prints = land(printed.select(F.col("_fingerprint").alias("fp")).distinct(), "prints")
    linked = components(links(prints, radius))
    return prints.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, ``fingerprint`` and ``component_id`` of every document.

    The component's id is the smallest doc_id that links reach.  Texts without words, null or empty, share
    fingerprint 0 and are linked like any other.  Null ids count only where a component has no other; repeated rows
    stay.  Only doc_id and text are read.
    """
    printed = land(with_fingerprints(docs.select("doc_id", "text"), shingle).drop("text"), "fingerprints")
    roots = groups(printed, radius)
    first = printed.groupBy("_fingerprint").agg(F.min("doc_id").alias("first"))
    known = first.join(roots, F.col("_fingerprint") == F.col("fp"))
    ids = known.groupBy("root").agg(F.min("first").alias("component_id"))
    named = known.join(ids, "root").select("fp", "component_id")
    hexed = F.lpad(F.lower(F.hex("_fingerprint")), 16, "0").alias("fingerprint")
    return printed.join(named, F.col("_fingerprint") == F.col("fp")).select("doc_id", hexed, "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each group, with all its columns: that of the smallest doc_id, of equal rows just one.

    Columns of any name come back as they were.
    """
    # Columns go by place, so that none of their names can meet those added here.
    places = [f"_{n}" for n in range(len(docs.columns))]
    doc_id, text = (places[docs.columns.index(name)] for name in ("doc_id", "text"))
    numbered = docs.toDF(*places).withColumn("_row", F.monotonically_increasing_id())
    printed = land(with_fingerprints(numbered, shingle, text), "fingerprints")
    first = F.min(F.struct(F.col(doc_id).isNull(), doc_id, "_row")).alias("_first")
    copies = printed.groupBy("_fingerprint").agg(first)  # of copies one each, before groups meet
    rooted = copies.join(groups(printed, radius), F.col("_fingerprint") == F.col("fp"))
    kept = rooted.groupBy("root").agg(F.min("_first").alias("_kept"))
    return printed.join(kept.select(F.col("_kept._row").alias("_row")), "_row", "left_semi").select(*places).toDF(*docs.columns)


def op7_meet_in_the_middle_simhash(spark, sf_dir: str) -> DataFrame:
    """Every whole document, with its fingerprint and component."""
    return near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
