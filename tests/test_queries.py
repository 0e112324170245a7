"""Every registered query on the smallest tables, beside its SQL where it has one."""

import pytest

import __spark_entry__ as entry
from checks.compare import difference, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(got) > 0 or name == "remainder_batch"
    if name in ORACLES:
        assert difference(got, connection.execute(ORACLES[name]).df()) is None
