"""Every driver query next to its SQL on the smallest tables."""

from pathlib import Path

import pytest

from driver_queries import ORACLES, QUERIES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def db():
    pytest.importorskip("duckdb")
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert difference(QUERIES[name](spark, SF), db, ORACLES[name]) == ""


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
