"""Every registered query against its SQL twin, at the smallest scale; the larger ones run with tests/oracle.py."""

import pytest

import __spark_entry__ as contract
from oracle import connect, differences

TWINS = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sample):
    return connect(sample)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, sample, duck, name):
    assert differences(contract.queries()[name](spark, sample), duck, TWINS[name]) == []


def test_every_twin_has_a_query_and_the_flagship_runs(spark):
    assert set(TWINS) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
