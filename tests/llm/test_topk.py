"""Top k against sorting all scores."""

import random

import pytest

from helioledger.llm import topk
from tests.llm.data import found


def plain(vectors, queries, k):
    def clean(v):
        return None if v is None or any(x is None or x != x or abs(x) == float("inf") for x in v) else [int((256 * x) // 1) for x in v]

    out = []
    for q, v in queries:
        if q is None or (v := clean(v)) is None:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), i is None, i or 0) for i, x in vectors if i != q and (w := clean(x)) is not None and len(w) == len(v)]
        out += [(q, rank + 1, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("bins", [2, 16, 2048])
def test_against_sorting(spark, monkeypatch, bins):
    for name, value in (("BINS", bins), ("BLOCK", 37), ("QUERY_BLOCK", 5), ("SLICE", 2)):
        monkeypatch.setattr(topk, name, value)
    rng = random.Random(bins)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(150)]
    vectors += [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(60)]  # a common vector: many ties
    vectors += [(7, [1.0, 0.0, 0.0, 0.0]), (7, [1.0, 0.0, 0.0, 0.0]), (None, [0.5] * 4), (None, [0.9] * 4)]
    vectors += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan")] * 4), (303, [float("inf"), 0.0, 0.0, 0.0]), (304, [1.0]), (305, []), (310, []), (306, [1.0, 2.0])]
    queries = [v for v in vectors if v[0] is not None and v[0] % 10 == 0] + [(7, [1.0, 0.0, 0.0, 0.0])] * 2
    table = spark.createDataFrame([(*v, "x") for v in vectors], "id long, vector array<double>, rank string")
    asked = spark.createDataFrame([(*v, "x") for v in queries], "id long, vector array<double>, rank string")
    assert found(topk.top_k(table, asked, 5)) == plain(vectors, queries, 5)


def test_large_components_and_empty_tables(spark):
    # The product of the first with itself is beyond 62 bits, but no row is its own candidate; others come near that.
    vectors = [(0, [6e9, -3.0]), (1, [1e4, 1.0]), (2, [9e3, 2.0]), (4, [-0.001, 0.0]), (5, [-1.1e4, 0.0])]
    table = spark.createDataFrame(vectors, "id long, vector array<double>")
    assert found(topk.top_k(table, table, 2)) == plain(vectors, vectors, 2)
    assert topk.top_k(table.limit(0), table, 2).collect() == [] == topk.top_k(table, table.limit(0), 2).collect()
    assert max(r.score for r in topk.top_k(table, table, 2).collect()) > 1 << 61
    for odd, message in (([1e300, 0.0], "beyond 62 bits"), ([1e307, 0.0], "beyond a double")):
        with pytest.raises(Exception, match=message):
            topk.top_k(spark.createDataFrame([*vectors, (9, odd)], table.schema), table, 2).collect()
    with pytest.raises(ValueError, match="k must"):
        topk.top_k(table, table, 0)
