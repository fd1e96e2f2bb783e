"""Every registered query against its SQL on another engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from workload.oracle import ORACLE

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) == []


def test_every_query_has_sql():
    from workload.queries import QUERIES

    assert set(QUERIES) == set(ORACLE) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
