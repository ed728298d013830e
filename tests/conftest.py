import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from navlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("navlake-tests", cpus="4", partitions=4)


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    changed = {}

    def put(key, value):
        changed[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield put
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def nav_of(spark):
    """NAV rows from (code, 'yyyy-mm-dd', nav) tuples."""
    import datetime as dt

    def build(*rows):
        return spark.createDataFrame(
            [(c, dt.date.fromisoformat(d), float(n)) for c, d, n in rows],
            "scheme_code string, nav_date date, nav double",
        )

    return build


@pytest.fixture
def master_of(spark):
    """Master rows from (code, house, category, name) tuples."""

    def build(*rows):
        return spark.createDataFrame(
            list(rows),
            "scheme_code string, fund_house string, category string, scheme_name string",
        )

    return build
