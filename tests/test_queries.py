"""Every registered query against its SQL on the smallest tables; the others must give rows."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 5 and "mae" in df.columns


def test_every_operator_is_covered():
    covered = {c for q in entry.CATALOG.values() for c in q.covers}
    groups = {"SRC": 11, "SNK": 6, "FLT": 11, "JN": 8, "AGG": 32, "WIN": 24, "TOP": 5, "SET": 3, "DT": 7, "MTH": 8,
              "CAT": 4, "CND": 3, "PL": 13, "MDL": 17, "STM": 7}
    for group, n in groups.items():
        assert sum(c.rstrip("0123456789") == group for c in covered) == n, group


@pytest.mark.parametrize("name", sorted(entry.CATALOG))
def test_query(spark, con, name):
    run = entry.queries()[name]
    if name in ORACLES:
        assert compare(spark, con, FOLDER, run, ORACLES[name], slack=True) is None
    else:
        assert run(spark, FOLDER).count() > 0
