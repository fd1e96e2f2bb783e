"""Registered queries against their SQL, on the smallest tables."""

import pytest
from compare import connect, differences

from plumbline.llm.oracle import ORACLE
from plumbline.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) == []
