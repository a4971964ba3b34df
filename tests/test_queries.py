"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registry
from compare import assert_same, connect

FOLDERS = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001 /root/testdata/sf0.01").split()
QUERIES, SQL = registry.queries(), registry.oracle_sql()
PLANNED = list(registry.PLANS)


@pytest.fixture(scope="module", params=FOLDERS)
def folder(request):
    return request.param


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", PLANNED)
def test_query_matches_sql(spark, folder, con, name):
    assert_same(QUERIES[name](spark, folder), con, SQL[name])


def test_entry_runs(spark):
    assert registry.entry(spark).count() > 0
