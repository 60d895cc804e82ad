"""Every registered query against its SQL check, on the smallest data."""

import pytest

import __spark_entry__ as contract
from crawlsight.plans import catalog
from tests.compare import connect, differences

CHECKS = contract.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    return connect(small)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, small, db, name):
    frame = contract.queries()[name](spark, small)
    if name in CHECKS:
        assert differences(frame, db, CHECKS[name]) == []
    else:
        assert frame.columns and frame.count() >= 0


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["run_id", "continuation", "error_type", "n"]
