"""Every registered query against its SQL, on the smallest tables."""

import pytest

import check
from __spark_entry__ import entry, oracle_sql
from stowage.plans.oracles import ORACLES
from stowage.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() == 500


@pytest.mark.parametrize("name", oracle_sql())
def test_query(spark, name):
    assert check.compare(spark, SF, name) is None
