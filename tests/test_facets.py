"""UI4 and UI5 over bitmaps: counts and rows as a pass over the report gives them."""

import random
import re
from collections import Counter

import pytest

from ledgerspark.operators import facet_bitmaps as fb
from ledgerspark.operators import stored_order as so

FACETS = ("data", "tipo", "status")
ORDER = [(c, False) for c in FACETS]


@pytest.fixture(scope="module")
def held(spark, tmp_path_factory):
    r = random.Random(4)
    rows = [(f"{i:06d}", r.choice([f"d{r.randrange(300)}", None, ""]), r.choice(["A", "a", "<b>B</b>", " b ", "C'", None]),
             r.choice(["ERRO", "ERRO", "ERRO", "BAIXADO"])) for i in range(70_000)]  # three runs of positions
    report = spark.createDataFrame(rows, "documento string, data string, tipo string, status string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = so.stored(spark, lambda: report, str(tmp_path_factory.mktemp("facets")), "1", ORDER)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    fb.store_index(spark, order, f"{order}/facets", FACETS)
    return rows, order, fb.read_index(spark, f"{order}/facets")


def shown(value):
    return (value or "").replace("<b>", "").replace("</b>", "").lower()


def fits(row, choices):
    return all(shown(row[1 + FACETS.index(f)]) == v.lower() for f, v in choices.items() if v)


CHOICES = [{}, {"status": "erro"}, {"tipo": "b"}, {"tipo": "A", "status": "baixado"}, {"data": "D7", "tipo": "c'", "status": "ERRO"},
           {"status": None, "tipo": ""}, {"status": "none such", "tipo": "a"}]


@pytest.mark.parametrize("choices", CHOICES)
def test_counts_by_force(held, choices):
    rows, _, index = held
    expected = Counter()
    for row in rows:
        for k, f in enumerate(FACETS, 1):
            if row[k] and fits(row, {c: v for c, v in choices.items() if c != f}):
                expected[f, row[k]] += 1
    got = {(r.facet, r.value): r.n for r in fb.facet_counts(index, FACETS, choices).collect()}
    assert got == dict(expected)


@pytest.mark.parametrize("choices", CHOICES)
def test_rows_by_force(spark, held, choices):
    rows, order, index = held
    got = fb.filtered_rows(spark, order, index, choices)
    assert got.columns == ["documento", "data", "tipo", "status"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(r for r in rows if fits(r, choices))


def test_one_value_reads_few_partitions_and_few_bitmaps(spark, held):
    rows, order, index = held
    parts = spark.read.parquet(f"{order}/parts").count()
    plan = fb.filtered_rows(spark, order, index, {"data": "d7"})._jdf.queryExecution().executedPlan().toString()
    named = re.search(r"PartitionFilters: \[[^]]*_part#\d+ (?:= \d+|IN \(([\d,]+)\))", plan)
    assert parts > 4 and named and (named[1] or "").count(",") + 1 < parts
    # dates follow the order: hardly more bitmaps than values
    assert index.where("facet = 'data'").count() <= len({r[1] for r in rows if r[1]}) + 3


def test_empty_report(spark, held, tmp_path):
    order = so.stored(spark, lambda: spark.createDataFrame([], "documento string, data string, tipo string, status string"),
                      str(tmp_path), "1", ORDER)
    fb.store_index(spark, order, f"{order}/facets", FACETS)
    index = fb.read_index(spark, f"{order}/facets")
    assert fb.facet_counts(index, FACETS, {"status": "erro"}).count() == 0
    assert fb.filtered_rows(spark, order, index, {"status": "erro"}).count() == 0
