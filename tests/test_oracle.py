"""Every registered query, against its SQL where there is one."""

import pytest

from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF_DIR), db, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_and_queries(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 43
    assert set(contract.oracle_sql()) <= set(contract.queries())
