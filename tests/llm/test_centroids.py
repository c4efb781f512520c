"""Clusters against measuring every centroid with Python's integers."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from helioledger.llm import centroids
from tests.llm.data import found


def plain_nearest(v, cs):
    return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cs))


@pytest.mark.parametrize("size", [1, 5, 1000, 1 << 30, 1 << 45])
def test_search_finds_the_nearest(size):
    rng = np.random.default_rng(size)
    for shape in ((200, 7, 16), (50, 1, 3), (30, 64, 1), (100, 3, 40)):
        vectors = rng.integers(-size, size + 1, shape[:2])
        cs = np.concatenate([rng.integers(-size, size + 1, (shape[2], shape[1])), vectors[:2], vectors[:1]])
        cs = np.concatenate([cs, np.flip(cs[:1], axis=1)])  # same sum and deviation, another place
        cluster, distance, measured = centroids.nearest(vectors, cs)
        want = [plain_nearest(v.tolist(), cs.tolist()) for v in vectors]
        assert [(int(d), int(c)) for d, c in zip(distance, cluster, strict=True)] == want
        assert measured <= len(vectors) * len(cs)


def test_search_passes_over_most_centroids():
    rng = np.random.default_rng(1)
    middles = rng.integers(-1000, 1000, (64, 1)) + rng.integers(-5, 6, (64, 16))
    vectors = middles[rng.integers(0, 64, 500)] + rng.integers(-3, 4, (500, 16))
    assert centroids.nearest(vectors, middles)[2] < 500 * 64 / 8


def plain(vectors, count, rounds, components):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    def key(row):
        id_, v = row
        return id_ is None, "" if id_ is None else hashlib.sha256(f"1:{id_}".encode()).hexdigest(), np.array(v, "<i4").tobytes()
    cs = [v for _, v in sorted(kept, key=key)[:count]]
    for _ in range(rounds):
        own = [plain_nearest(v, cs)[1] for _, v in kept]
        for n in range(len(cs)):
            mine = [v for (_, v), c in zip(kept, own, strict=True) if c == n]
            if mine:
                cs[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = [(i, *reversed(plain_nearest(v, cs))) for i, v in kept]
    return sorted(out, key=repr), cs


def test_against_plain_rounds(spark):
    rng = random.Random(4)
    vectors = [(i, [rng.gauss(i % 5, 1) for _ in range(6)]) for i in range(300)]
    vectors += [(1000 + i, [0.25] * 6) for i in range(150)]  # a common vector
    vectors += [(7, [0.5] * 6), (7, [0.5] * 6), (7, [-0.5] * 6), (None, [0.1] * 6), (None, None), (2000, None), (2001, []), (2002, [1.0] * 5)]
    vectors += [(2003, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2004, [math.nan] * 6), (2005, [math.inf] + [0.0] * 5)]
    table = spark.createDataFrame([(i, v, "x", 9) for i, v in vectors], "id long, vector array<double>, data string, cluster int").repartition(5)
    for rounds in (0, 3):
        rows, cs = centroids.clusters(table, 16, rounds, 6)
        want, want_cs = plain(vectors, 16, rounds, 6)
        assert (found(rows), cs.tolist()) == (want, want_cs)
    sums = {}
    for _, c, d in want:
        sums[c] = sums.get(c, 0) + d
    for r in centroids.with_inertia(rows, cs).collect():
        assert (r.cluster_inertia, r.inertia) == (sums[r.cluster], sum(sums.values()))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, want_cs[r.cluster])).encode()).hexdigest()


def test_few_none_and_too_large(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-9.0, 1e7])], "id long, vector array<double>")
    rows, cs = centroids.clusters(table, 16, 3, 2)
    assert (found(rows), cs.tolist()) == plain([tuple(r) for r in table.collect()], 16, 3, 2)
    empty, none = centroids.clusters(table.limit(0), 16, 3, 2)
    assert found(centroids.with_inertia(empty, none)) == [] and none.shape == (0, 2)
    with pytest.raises(Exception, match="63 bits"):
        centroids.clusters(spark.createDataFrame([(1, [1e300, 0.0])], "id long, vector array<double>"), 2, 1, 2)
    far = spark.createDataFrame([(1, [1e15, 0.0]), (2, [-1e15, 0.0])], "id long, vector array<double>")
    with pytest.raises(Exception, match="63 bits"):
        centroids.clusters(far, 1, 0, 2)
    with pytest.raises(ValueError, match="one centroid"):
        centroids.clusters(table, 0)


def test_query_against_sql(spark, small):
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
        want = db.sql(centroids.OP12_SQL)
        names = [c for c in want.columns]
        query = centroids.op12_equal_average_clusters(spark, small).select(*names)
        assert found(query) == sorted(want.fetchall(), key=repr)
