"""Every registered query against its SQL counterpart on the given tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from stateloom.plans.oracles import ORACLES
from stateloom.plans.register import QUERIES

from .compare import connect, difference

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    with connect(SMALL) as con:
        yield con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert not contract.entry(spark).isEmpty()


@pytest.mark.parametrize("name", ["mart_model", "stringify_cells", "local_date_literal", "retention_top_n"])
def test_session_zone_does_not_matter(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert difference(QUERIES[name](spark, SMALL), duck, ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
