"""Every registered query against its DuckDB oracle on the smallest test tables
(the driver's correctness gate, run locally), plus the smoke entry."""

import pytest
from conftest import SMALL_SF

import __spark_entry__ as entry_module
from dimforge import queries as library
from oracle_compare import compare, duck

QUERIES = {k: v for k, v in entry_module.queries().items() if k in library.QUERIES}
ORACLE = {k: v for k, v in entry_module.oracle_sql().items() if k in library.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL_SF)


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    result = compare(QUERIES[name](spark, SMALL_SF), con, ORACLE[name])
    assert result["ok"], result


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns[:4] == ["ID_DOMAIN", "ID_ORIGEM_DB", "ID_PLANEJAMENTO_AGRICOLA", "ORIGEM_DB"]
    assert len(df.columns) == 30
    assert df.count() >= 0
