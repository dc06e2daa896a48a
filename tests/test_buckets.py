"""Reports from the bucketed table: no exchange, equal to the reports over the ledgers themselves, no hot bucket."""

import datetime as dt
import uuid

import pytest

from ledgerspark.plans import buckets, reports
from tests.test_reports import MV, RG, SE

T0 = dt.datetime(2024, 1, 1, 8, 0)


@pytest.fixture
def ledgers(spark):
    mv = [(i, None if i % 3 else str(i % 50), "INCLUSAO" if i % 2 else " exclusao", T0, 5000 - i) for i in range(4000)]
    rg = [(str(k), f"n{k}", k) for k in range(0, 80, 3)] + [("", "blank", 500)]
    se = [(str(k % 70), f"d{k}", None if k % 5 else f"U{k}", "x", *(("Ativas", 1) if k % 4 else ("Erros", 5)), 900 - k) for k in range(600)]
    return [spark.createDataFrame(r, s) for r, s in ((mv, MV), (rg, RG), (se, SE))]


@pytest.fixture
def table(spark, ledgers):
    name = f"ledgers_{uuid.uuid4().hex}"
    buckets.write_ledgers(*ledgers, name, 4)
    yield name
    spark.sql(f"drop table {name}")


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(str, map(tuple, df.select(cols).collect())))


def test_reports_equal_those_over_the_ledgers(spark, ledgers, table):
    mv, rg, se = ledgers
    active = se.where("fonte = 'Ativas'")
    pairs = [(buckets.unified_report(spark, table, with_sources=True), reports.unified_report(mv, rg, se, with_sources=True)),
             (buckets.unified_presence_report(spark, table, ("Ativas",)), reports.unified_presence_report(mv, rg, active)),
             (buckets.cnm_registry_report(spark, table), reports.cnm_registry_report(mv, rg)),
             (buckets.soa_registry_report(spark, table, ("Ativas",)), reports.soa_registry_report(active, rg))]
    for mine, whole in pairs:
        assert rows(mine) == rows(whole)
        assert "Exchange" not in mine._jdf.queryExecution().executedPlan().toString()


def test_a_hot_document_is_few_rows_of_the_table(spark, ledgers, table):
    stored = spark.table(table)
    assert stored.groupBy("documento", "_ledger", "_file").count().where("count > 1").count() == 0
    assert stored.where("documento = ''").count() <= 1 + 1 + 5
    files = stored.select("_metadata.file_name", "_ledger").distinct()
    assert files.count() <= 3 * 4  # one file per ledger and bucket
