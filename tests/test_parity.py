"""Every registered query gives the rows of its SQL."""

import os

import pytest

from navlake.plans.oracles import ORACLES
from navlake.plans.queries import QUERIES
from parity import differences, oracle_connection

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    return oracle_connection(SF_DIR)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    assert differences(spark, database, name, SF_DIR) is None
