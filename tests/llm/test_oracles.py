"""Queries that SQL can express, against their SQL on whole tables."""

import pytest

from ledgerline.llm.queries import ORACLES

from ..conftest import SF_SMALL
from ..oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(sp, name):
    assert compare(sp, name, SF_SMALL, duck(SF_SMALL))
