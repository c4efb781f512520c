"""Weights, limits of repetition and the order of what is read."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helioledger.llm import mixing, simhash
from helioledger.llm.tables import land
from tests.llm.data import frame, rows

SIZES = {"a": 900, "b": 300, "c": 100, None: 50}


@pytest.fixture(scope="module")
def records(spark):
    data = [(n, s, 10 + n % 7, 5, "x") for s, size in SIZES.items() for n in range(size)]
    data += [(9000, "empty", 0, 5, "x"), (9001, "empty", None, 5, "x"), (1, "a", 11, 5, "x"), (None, "a", 3, 5, "x"), (9002, "", 40, 5, "x")]
    return land(spark.createDataFrame(data, "key long, src string, n long, epoch int, weight string"), "records")


def test_every_record_is_read_and_none_too_often(spark, records):
    mixed = mixing.mixture(records, "key", "src", "n", 3.0).collect()
    asked = Counter((r.key, r.src, r.n) for r in records.collect())
    times = Counter((r.key, r.src, r.n) for r in mixed)
    assert set(times) == set(asked)
    assert all(asked[k] <= n <= 3 * asked[k] for k, n in times.items())
    weights = {r.src: r.weight for r in mixed}
    assert abs(sum(weights.values()) - 1) < 1e-9 and weights["empty"] == 0
    tokens = defaultdict(int)
    for r in records.collect():
        tokens[r.src] += r.n or 0
    smallest, largest = (f((t, s) for s, t in tokens.items() if t) for f in (min, max))
    assert abs((weights[smallest[1]] / smallest[0]) / (weights[largest[1]] / largest[0]) - 3) < 1e-6
    read = defaultdict(int)
    for r in mixed:
        read[r.src] += r.n or 0
    budget = largest[0] / weights[largest[1]]
    for source, weight in weights.items():
        assert -1e-6 <= budget * weight - read[source] <= 60 or source == "empty"
    for place in {(r.src, r.epoch) for r in mixed}:
        assert sorted(r.position for r in mixed if (r.src, r.epoch) == place) == list(range(sum((r.src, r.epoch) == place for r in mixed)))


def test_passes_are_different_permutations(spark, records):
    mixed = [r for r in mixing.mixture(records, "key", "src", "n", 20.0).collect() if r.src == "c"]
    orders = [[r.key for r in sorted(mixed, key=lambda r: r.position) if r.epoch == e] for e in (0, 1)]
    assert sorted(orders[0]) == sorted(orders[1]) and orders[0] != orders[1]


def test_blocks_stay_together(spark, records, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 500)
    mixed = [r for r in mixing.mixture(records, "key", "src", "n", 2.0).collect() if r.src == "a" and r.epoch == 0]
    blocks = [r.block for r in sorted(mixed, key=lambda r: r.position)]
    changes = sum(a != b for a, b in zip(blocks, blocks[1:], strict=False))
    assert len(set(blocks)) > 10 and changes == len(set(blocks)) - 1


def test_entropy_and_budget(spark, records):
    few = records.filter("src IN ('a', 'b', 'c')")
    sources = mixing.source_totals(few.selectExpr("src AS _source", "n AS _n"))
    power = mixing.exponent_for_entropy(sources, 0.9)
    totals = [r._tokens for r in sources.collect()]
    powers = [t**power for t in totals]
    shares = [p / sum(powers) for p in powers]
    assert abs(-sum(s * math.log(s) for s in shares) - 0.9 * math.log(3)) < 1e-6
    mixed = mixing.mixture(few, "key", "src", "n", entropy=0.9, budget=2_000).collect()
    read = Counter()
    for r in mixed:
        read[r.src] += r.n
    assert all(0 <= 2_000 * w - read[s] <= 20 for s, w in {r.src: r.weight for r in mixed}.items())
    assert mixing.exponent_for_entropy(sources, 1.0) < 1e-9 and mixing.exponent_for_repeats(sources, 1.0) > 1 - 1e-9
    with pytest.raises(ValueError, match="less than once"):
        mixing.exponent_for_repeats(sources, 0.5)


def test_documents(spark):
    docs = frame(spark)
    mixed = mixing.mixed_documents(docs, 2.0)
    assert mixed.columns == docs.columns
    asked, got = Counter((r.doc_id, r.text) for r in docs.collect()), Counter((r.doc_id, r.text) for r in mixed.collect())
    assert set(asked) == set(got) and all(asked[k] <= got[k] <= 2 * asked[k] for k in got)
    assert sum(got.values()) > len(rows())
    assert mixing.mixed_documents(frame(spark, [])).count() == 0
    assert mixing.mixed_documents(frame(spark, [(1, None)])).count() == 1


CLASHING = ("_row", "_times", "_time", "_fingerprint", "_source", "_n", "_key", "_record", "_document", "_slot", "_0", "quota", "passes", "blocks", "weight_", "fp", "root")


def test_clashing_names_keep_their_values(spark):
    """Columns named as what is added on the way come back with their values."""
    docs = frame(spark).drop("_row")
    for n, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.concat(F.lit(f"{n}:"), F.coalesce(F.col("text"), F.lit("none")).substr(1, 5)))
    asked = Counter(tuple(r) for r in docs.collect())
    mixed = mixing.mixed_documents(docs, 2.0)
    got = Counter(tuple(r) for r in mixed.collect())
    assert mixed.columns == docs.columns and set(got) == set(asked) and all(asked[k] <= n <= 2 * asked[k] for k, n in got.items())
    single = simhash.keep_one(docs)
    kept = Counter(tuple(r) for r in single.collect())
    assert single.columns == docs.columns and kept and all(n == 1 and k in asked for k, n in kept.items())
    records = land(docs.withColumn("n", F.lit(3)), "records")
    read = mixing.mixture(records, "doc_id", "source", "n", 2.0)
    own = [c for c in records.columns if c != "epoch"]  # which is one of the added
    assert {tuple(r) for r in read.select(*own).collect()} == {tuple(r) for r in records.select(*own).collect()}
