"""Clustering around integer centroids, the nearest found by equal-average equal-variance search.

Centroids stand in order of their component sums.  A vector starts at its own sum and looks outward, nearer sums first.
With ``d`` components, ``d`` times the squared distance is at least the squared difference of the sums: once that passes
what is best so far, everything farther out is out, too.  It is also at least that plus the squared difference of the
deviations from the mean (as lengths, times ``d``): a centroid beyond that is passed over.  What remains is measured in
exact integers.  Bounds that need roots are rounded to the safe side.

Vectors are quantised once and written; every round is one pass over them.  A task sends sums and counts of its vectors
by centroid, so what meets is as many rows as there are tasks, centroids and components.  The centroids themselves are
bounded by two parameters and go to the tasks with the code.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioledger.llm.tables import land, read, ship

CENTROIDS, ROUNDS, COMPONENTS, SCALE, SEED = 16, 3, 64, 64, 1
#: Squares and products below this stay exact in 64 bits.
SAFE = 1 << 62
MOST = (1 << 63) - 1


def quantise(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Written: ``id`` and ``data``, the components x as packed integers floor(scale * x), of 32 bits where a batch allows.

    Left out are vectors that are null, of another length, or with a null or non-finite component.  Null and repeated ids
    stay.  A component of 63 bits or more is an error.
    """
    ship(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = np.array(lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False), np.int64)
            fit = np.flatnonzero(sizes == components)
            taken = lists.take(pa.array(fit))
            values = taken.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(fit), components)  # null becomes nan
            kept = np.isfinite(values).all(axis=1)
            with np.errstate(over="ignore"):
                found = np.floor(values[kept] * scale)
            most = np.abs(found).max(initial=0)
            if most >= MOST:
                raise OverflowError("a component needs more than 63 bits")
            packed = found.astype("<i4" if most < 1 << 31 else "<i8")
            ids = batch.column(0).take(pa.array(fit[kept]))
            yield pa.RecordBatch.from_arrays([ids, pa.array([row.tobytes() for row in packed], pa.binary())], ["id", "data"])

    rows = vectors.select(F.col("id").cast("long"), F.col("vector").cast("array<double>"))
    return land(rows.mapInArrow(run, "id long, data binary"), "vectors")


def unpack(data: list[bytes], components: int) -> np.ndarray:
    if all(len(d) == 4 * components for d in data):
        return np.frombuffer(b"".join(data), "<i4").reshape(len(data), components).astype(np.int64)
    return np.array([np.frombuffer(d, f"<i{len(d) // components}") for d in data], np.int64).reshape(len(data), components)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector (the smaller number of equals), the squared distance, and how many were measured."""
    count, d = vectors.shape
    reach = int(np.abs(vectors).max(initial=0)) + int(np.abs(centroids).max(initial=0)) + 1
    if reach * reach * d * d >= SAFE:  # Python's integers
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    kind = vectors.dtype
    sums, squares = vectors.sum(axis=1, dtype=kind), (vectors * vectors).sum(axis=1, dtype=kind)
    spread = np.sqrt((d * squares - sums * sums).astype(np.float64))
    order = np.argsort(centroids.sum(axis=1, dtype=kind), kind="stable")
    ordered = centroids[order]
    middles = ordered.sum(axis=1, dtype=kind)
    spreads = np.sqrt((d * (ordered * ordered).sum(axis=1, dtype=kind) - middles * middles).astype(np.float64))
    right = np.searchsorted(middles, sums).astype(np.int64)
    left = right - 1
    best, cluster = np.full(count, -1, kind), np.full(count, len(centroids), np.int64)
    open_, measured = np.arange(count), 0
    while len(open_):
        more_left, more_right = left[open_] >= 0, right[open_] < len(ordered)
        open_ = open_[more_left | more_right]
        lo, hi = left[open_], right[open_]
        to_left, to_right = sums[open_] - middles[np.maximum(lo, 0)], middles[np.minimum(hi, len(ordered) - 1)] - sums[open_]
        goes_left = (hi >= len(ordered)) | ((lo >= 0) & (to_left <= to_right).astype(bool))
        at, apart = np.where(goes_left, lo, hi), np.where(goes_left, to_left, to_right)
        left[open_] -= goes_left
        right[open_] += ~goes_left
        # Farther out the sums differ by more: nothing there can be as near.
        near = (best[open_] < 0).astype(bool) | (apart * apart <= d * best[open_]).astype(bool)
        open_, at, apart = open_[near], at[near], apart[near]
        gap = np.abs(spread[open_] - spreads[at]) - 1e-12 * (spread[open_] + spreads[at])
        least = (apart.astype(np.float64) ** 2 + np.maximum(gap, 0) ** 2) * (1 - 1e-12)
        look = (best[open_] < 0).astype(bool) | (least <= d * best[open_].astype(np.float64) * (1 + 1e-12))
        who, which = open_[look], at[look]
        measured += len(who)
        differences = vectors[who] - ordered[which]
        distances, number = (differences * differences).sum(axis=1, dtype=kind), order[which]
        better = (best[who] < 0) | (distances < best[who]) | ((distances == best[who]) & (number < cluster[who]))
        better = better.astype(bool)
        best[who[better]], cluster[who[better]] = distances[better], number[better]
    return cluster, best, measured


def first_centroids(packed: DataFrame, count: int = CENTROIDS, components: int = COMPONENTS, seed: int = SEED) -> np.ndarray:
    """The ``count`` vectors with the smallest SHA-256 of ``seed:id``, or all if fewer; ids that are null come last.

    Rows of one id stand in the order of their packed components.
    """
    hashed = packed.withColumn("_hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256))
    rows = hashed.orderBy(F.asc_nulls_last("_hash"), "data").select("data").limit(count).collect()
    return unpack([bytes(r.data) for r in rows], components)


def moved(packed: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid at the floor of its vectors' mean; one without vectors stays.  One row per centroid and component comes back."""
    number, components = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((number, components), object), np.zeros(number, np.int64)
        for batch in batches:
            vectors = unpack(batch.column(0).to_pylist(), components)
            cluster = nearest(vectors, centroids)[0]
            counts += np.bincount(cluster, minlength=number)
            wide = int(np.abs(vectors).max(initial=0)) * max(1, len(vectors)) >= SAFE
            for one in np.unique(cluster):
                sums[one] += vectors[cluster == one].astype(object if wide else np.int64).sum(axis=0)
        held = np.flatnonzero(counts)
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": pa.array(np.repeat(held, components).astype(np.int32)),
                "at": pa.array(np.tile(np.arange(components, dtype=np.int32), len(held))),
                "total": pa.array([int(x) for x in sums[held].ravel()], kind),
                "n": pa.array(np.repeat(counts[held], components)),
            }
        )

    parts = packed.select("data").mapInArrow(run, "cluster int, at int, total decimal(38,0), n long")
    found = centroids.copy()
    for row in parts.groupBy("cluster", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        found[row.cluster, row["at"]] = int(row.total) // row.n
    return found


def assigned(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Written: ``id``, ``cluster`` and squared ``distance`` of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance, _ = nearest(unpack(batch.column(1).to_pylist(), centroids.shape[1]), centroids)
            if distance.max(initial=0) > MOST:
                raise OverflowError("a squared distance needs more than 63 bits")
            distance = distance.astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])

    return land(packed.mapInArrow(run, "id long, cluster int, distance long"), "assigned")


def clusters(
    vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE, seed: int = SEED
) -> tuple[DataFrame, np.ndarray]:
    """``id``, ``cluster`` and ``distance`` of every kept vector of ``id`` and ``vector``, and the final centroids.

    See ``quantise`` for what is kept.  Null and repeated ids are vectors each; fewer vectors than ``count`` start fewer
    centroids; without vectors there is no row and no centroid.  Other columns are not read.
    """
    if count < 1 or components < 1:
        raise ValueError("one centroid and one component at least")
    packed = quantise(vectors, components, scale)
    centroids = first_centroids(packed, count, components, seed)
    for _ in range(rounds):
        centroids = moved(packed, centroids)
    return assigned(packed, centroids), centroids


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Add ``cluster_inertia``, ``inertia`` and ``centroid_sha256``, each one value per centroid; sums beyond 63 bits are an error."""
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(sums.values())
    if total > MOST:
        raise OverflowError("the inertia needs more than 63 bits")
    digests = [hashlib.sha256(",".join(str(x) for x in c.tolist()).encode()).hexdigest() for c in centroids]
    table = [(n, sums.get(n, 0), total, digest) for n, digest in enumerate(digests)]
    known = found.sparkSession.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster")  # as many rows as centroids


def op12_equal_average_clusters(spark, sf_dir: str) -> DataFrame:
    """All vectors of 64 components in 16 clusters after three rounds."""
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding").toDF("id", "vector")
    found = with_inertia(*clusters(vectors))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """Rounds as one statement; distances are exact in doubles below 2 ** 53."""
    steps = [
        f"""v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, q AS c
  FROM (SELECT sha256('{SEED}:' || vec_id) AS h, q FROM v ORDER BY h LIMIT {CENTROIDS}))""",
    ]
    for n in range(ROUNDS + 1):
        steps.append(f"""a{n} AS (
  SELECT vec_id, q, cluster, distance FROM (
    SELECT vec_id, q, cluster, list_inner_product(q, q) - 2 * list_inner_product(q, c) + list_inner_product(c, c) AS distance,
      row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS place
    FROM v CROSS JOIN c{n}) WHERE place = 1)""")
        if n < ROUNDS:
            steps.append(f"""c{n + 1} AS (
  SELECT o.cluster, coalesce(m.c, o.c) AS c FROM c{n} o LEFT JOIN (
    SELECT cluster, list(x ORDER BY i) AS c FROM (
      SELECT cluster, i, floor(sum(q[i]) / count(*)) AS x FROM a{n}, range(1, {COMPONENTS + 1}) t(i) GROUP BY cluster, i)
    GROUP BY cluster) m ON o.cluster = m.cluster)""")
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, a.cluster::INTEGER AS cluster, distance::BIGINT AS distance,
  (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(c, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} k ON a.cluster = k.cluster
"""


OP12_SQL = _sql()
