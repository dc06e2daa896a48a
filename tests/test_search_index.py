"""UI1 over a trigram index: rows as a scan of what stands gives them, from few files."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import search_index as si
from ledgerspark.operators import stored_order as so

SCHEMA = "documento string, nome string, status string"
TEXTS = ["erro", "ana maria", "<b>", "ção", "😀😀x", "bo", "a", "", '"maria jo" ERRO', "zzz", "7 mar", "erro baixado", "0012 ana", "x\U00020000y"]


def some_rows(r, keys):
    names = ["Ana", "MARIA", "João", "<b>Bo</b>", "Conceição", "x😀😀x", None, "", "  ", "x\U00020000y", "a<i>n</i>a"]
    return [(k, None if r.random() < 0.05 else " ".join(n for n in r.choices(names, k=r.randint(1, 3)) if n is not None),
             r.choice(["ERRO", "BAIXADO", "NEGATIVADO"])) for k in keys]


def by_force(rows, text):
    terms = [t.strip('"').lower() for t in re.findall(r'"[^"]+"|[^ ]+', text) if t.strip('"')]
    shown = lambda row: " ".join(re.sub("<[^>]*>", "", c or "") for c in row).lower()
    return [row for row in rows if all(t in shown(row) for t in terms)]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    """A whole report and two sets of changes, and the rows that stand after them."""
    r = random.Random(8)
    path = str(tmp_path_factory.mktemp("search"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        standing = {}
        for segment, keys in enumerate((range(4000), [*range(100, 400), *range(4000, 4100)], [*range(300, 500), 4050])):
            rows = some_rows(r, [f"{k:06d}" for k in keys])
            standing |= {row[0]: row for row in rows}
            si.add(spark, path, spark.createDataFrame(rows, SCHEMA), segment, whole=segment == 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return path, list(standing.values())


@pytest.mark.parametrize("text", TEXTS)
def test_search_by_force(spark, index, text):
    path, rows = index
    got = si.search(spark, path, text)
    assert got.columns == ["documento", "nome", "status"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(by_force(rows, text), key=str)


def test_a_rare_term_reads_few_blocks_and_files(spark, index):
    path, rows = index
    live, _ = si.segments(spark, path)
    found = si.candidates(spark, path, "003777", live)
    blocks = spark.read.parquet(f"{path}/grams").where("segment = 0").select("part", "block").distinct().count()
    assert 0 < found.count() <= 3 < blocks
    plan = si.search(spark, path, "003777")._jdf.queryExecution().executedPlan().toString()
    parts = so.partitions(spark, f"{path}/report/segment=0").count()
    named = re.findall(r"PartitionFilters: \[[^]]*_part#\d+ (?:= \d+|IN \(([\d,]+)\))", plan)
    assert parts > 4 and named and all((n or "").count(",") + 1 < parts for n in named)


def test_compaction_and_a_replayed_batch_change_nothing(spark, index, tmp_path):
    _, rows = index
    path = str(tmp_path)
    si.add(spark, path, spark.createDataFrame(rows, SCHEMA), 0, whole=True)
    for _ in range(2):
        si.add(spark, path, spark.createDataFrame([("000001", "Nova", "ERRO")], SCHEMA), 1)
    after = [row for row in rows if row[0] != "000001"] + [("000001", "Nova", "ERRO")]
    for text in ("erro", "nova", "ana"):
        assert sorted(map(tuple, si.search(spark, path, text).collect()), key=str) == sorted(by_force(after, text), key=str)
    assert si.compact(spark, path) == 2 and si.segments(spark, path)[0] == [2]
    for text in ("erro", "nova", "ana"):
        assert sorted(map(tuple, si.search(spark, path, text).collect()), key=str) == sorted(by_force(after, text), key=str)


def test_empty_report_repeated_rows_and_null_keys(spark, tmp_path):
    path = str(tmp_path)
    si.add(spark, path, spark.createDataFrame([], SCHEMA), 0, whole=True)
    assert si.search(spark, path, "erro").count() == si.search(spark, path, "").count() == 0
    si.add(spark, path, spark.createDataFrame([("1", "Ana", "ERRO")] * 2 + [(None, "Ana", "ERRO")], SCHEMA), 1)
    si.add(spark, path, spark.createDataFrame([(None, "Ana", "ERRO")], SCHEMA), 2)
    assert si.search(spark, path, "ana").where(F.col("documento").isNull()).count() == 2
    assert si.search(spark, path, "ana").count() == 4
