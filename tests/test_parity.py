"""Layer 1: every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from ledgerspark.plans.catalog import catalog
from tests.conftest import SF_ORACLE
from tools.parity import compare

NAMES = sorted(catalog())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    result = compare(spark, SF_ORACLE, [name], verbose=False)[name]
    if result[0] == "rows-only":
        assert result[1] >= 0
    else:
        ok, n_spark, n_duck = result
        assert ok, f"{name}: spark={n_spark} duck={n_duck}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "documento", "nome", "data", "tipo", "local", "status"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert all(text is not None for _, text in catalog().values())
