from __future__ import annotations

import pytest

from checks.compare import connect, difference
from corpuscope.llm.oracle import ORACLE
from corpuscope.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None
