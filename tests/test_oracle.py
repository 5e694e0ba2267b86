"""Every registered query against its SQL twin; CROPMOSAIC_SF picks another scale."""

import os

import pytest

import __spark_entry__ as entry_point
from check_oracle import compare, duck
from cropmosaic.plans.catalog import QUERIES
from cropmosaic.plans.oracle import ORACLE

SF_DIR = os.environ.get("CROPMOSAIC_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE) == set()
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], ORACLE[name]) is None


def test_registered():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
