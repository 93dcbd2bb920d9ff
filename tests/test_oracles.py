"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle_check import compare, duck

from unirec.plans.registry import oracle_sql, queries


@pytest.fixture(scope="module")
def con():
    return duck("/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, "/root/testdata/sf0.001", queries()[name], oracle_sql()[name]) is None
