"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from suite import ORACLES, QUERIES
from suite.compare import check, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    verdict, note = check(spark, con, SF_DIR, name)
    assert verdict == "ok", note


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
