"""Every registered query with SQL agrees with a second engine at the smallest scale.

``python -m checks.compare`` does the same at larger scales.
"""

from __future__ import annotations

import pytest

from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Rows of a model on real texts; ``baseline_optimum`` and the marked texts say whether the same fit is right.
NO_SQL = {"baseline_predictions", "baseline_report"}
# At the smallest scale one label has 50 rows, too few for the default thresholds' model.
NEEDS_MORE_ROWS = ("baseline_optimum", "marked_predictions", "marked_report")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql_but_the_model():
    assert set(QUERIES) - set(ORACLE) == NO_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", ["baseline_optimum", "marked_report"])
def test_fit_agrees_at_the_next_scale(spark, name):
    larger = SF_DIR.replace("sf0.001", "sf0.01")
    assert difference(QUERIES[name](spark, larger), connect(larger), ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(ORACLE) - set(NEEDS_MORE_ROWS)))
def test_query_agrees(spark, con, name):
    result = QUERIES[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert difference(result, con, ORACLE[name]) is None
