"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from ledgerline.plans import catalog
from tests.oracle_compare import compare, duck

from .conftest import SF_SMALL

catalog.load_all()
NAMES = sorted(catalog.QUERIES)  # the optional package tests its own queries


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert sorted(set(NAMES) - set(E.oracle_sql())) == []
    assert set(NAMES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"order_key", "net_value", "value_per_unit"} <= set(df.columns)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, name, SF_SMALL, con, verbose=True)
