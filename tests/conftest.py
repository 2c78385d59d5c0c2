import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattlane.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=8, **{"spark.sql.shuffle.partitions": "3"})
    yield session
    session.stop()


@pytest.fixture()
def rows(spark):
    """Rows of a query result as tuples, ordered by the given columns."""

    def collect(df, *order):
        return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]

    return collect
