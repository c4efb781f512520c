"""Places of rows over many partitions."""

import random

from pyspark.sql import functions as F

from helioledger.operators import ordering
from tests.conftest import rows


def test_places_follow_a_global_sort(spark):
    values = [random.Random(4).choice([None, *range(40)]) for _ in range(600)]
    table = spark.createDataFrame([(v, n, "x") for n, v in enumerate(values)], "v int, n int, part string").repartition(7)
    found = ordering.numbered(table.orderBy(F.desc("v"), "n"))
    assert found.columns == ["v", "n", "part", "place"]
    want = sorted(((v, n) for n, v in enumerate(values)), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [tuple(r) for r in found.orderBy("place").select("v", "n", "place").collect()] == [(v, n, i) for i, (v, n) in enumerate(want, 1)]


def test_no_task_numbers_all_rows(spark):
    found = ordering.numbered(spark.range(0, 1000, 1, 5).orderBy(F.desc("id")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_empty_tables_repeated_rows_and_a_place_of_its_own(spark):
    table = spark.createDataFrame([(1, "a")] * 5, "v int, place string")
    assert rows(ordering.numbered(table.repartition(3))) == [(1, n) for n in range(1, 6)]
    assert ordering.numbered(table.limit(0)).collect() == []
