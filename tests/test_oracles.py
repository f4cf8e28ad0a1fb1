"""Every registered query against its SQL oracle on the small tables."""

import os

import pytest
from compare import compare, connect
from conftest import SF

from skyledger.plans import all_queries

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, duck, name):
    assert compare(spark, duck, SF, all_queries()[name]) == ""


def test_entry_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 150
