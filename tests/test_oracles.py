"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, differences
from tidewatch.plans.oracles import oracles
from tidewatch.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(oracles())
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_matches_sql(spark, sql, name):
    result = queries()[name](spark, SF_DIR).toArrow()
    assert differences(result, sql.sql(oracle_sql()[name]).to_arrow_table()) == []
