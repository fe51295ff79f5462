"""Every catalogue query against its DuckDB oracle at sf0.01, plus the driver smoke entry."""

import pytest

import __spark_entry__ as entry
from kempt.plans.catalogue import QUERIES
from oracle_compare import compare, duck
from paths import SF01

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    s, d = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF01)
    assert s[0] == d[0], "column names differ"
    assert s[1] == d[1], "row counts differ"
    assert s[2] == d[2], "values differ"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["target_id", "n_rows"] and len(rows) > 0
