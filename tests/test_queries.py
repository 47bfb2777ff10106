"""Every registered query beside its SQL, at the smallest scale."""

import os

import pytest

from oracle import compare, connect
from sluice.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_DIR) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
