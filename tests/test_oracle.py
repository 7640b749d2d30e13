"""Every registered query against its own SQL on another engine."""

import pytest
from tests.conftest import DATA

from tideline.plans import catalog
from tools.check_oracle import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    result = compare(spark, con, catalog.QUERIES[name], catalog.ORACLES.get(name), DATA)
    assert result.startswith(("ok", "rows-only")), result


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
