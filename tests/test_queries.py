"""Every registered query against its SQL, or for rows where there is none."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    with connect(sf_dir) as connection:
        yield connection


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf_dir, name):
    found, _ = difference(spark, duck, name, sf_dir)
    assert not found
