"""UI3 over a stored order: pages as a whole sort gives them, from few files, stored once per version."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import stored_order as so

BY = [("data", True), ("nome", False)]


@pytest.fixture
def report(spark):
    r = random.Random(2)
    rows = [(f"{i:05d}", r.choice(["b", "a", None]), r.choice(["2024", "2023", "", None])) for i in range(3000)]
    return spark.createDataFrame(rows, "documento string, nome string, data string").repartition(7)


def test_pages_equal_a_whole_sort_and_read_few_files(spark, report, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = so.stored(spark, lambda: report, str(tmp_path), "1", BY)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = [tuple(r) for r in report.orderBy(F.desc("data"), F.asc("nome"), F.asc("documento")).collect()]
    for size in (7, 50, 1000):
        last = -(-len(whole) // size)
        for number in {1, 2, last // 2 + 1, last, last + 1}:
            got = [tuple(r) for r in so.page(spark, path, number, size).collect()]
            assert got == whole[size * (number - 1):size * number], (size, number)
    parts = spark.read.parquet(f"{path}/parts").count()
    deep = so.page(spark, path, 200, 7)
    assert parts > 2
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_part" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    with pytest.raises(ValueError, match="start at 1"):
        so.page(spark, path, 0)


def test_an_order_is_stored_once_per_version(spark, report, tmp_path):
    built = []

    def build():
        built.append(1)
        return report.limit(10 * len(built))

    paths = [so.stored(spark, build, str(tmp_path), v, by) for v, by in (("1", BY), ("1", BY), ("2", BY), ("2", [("nome", True)]))]
    assert len(built) == 3 and paths[0] == paths[1] and len(set(paths)) == 3
    assert so.page(spark, paths[2], 1, 1000).count() == 20
    empty = so.stored(spark, lambda: report.limit(0), str(tmp_path), "empty", BY)
    assert so.page(spark, empty, 1).count() == 0
