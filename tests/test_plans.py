"""Plan guards: no registered query may plan a cartesian product or a
nested-loop join (no cross joins, no all-pairs)."""

import re

import pytest

from tessera.plans.catalog import ORACLE_SQL, QUERIES
from tests.conftest import SMALL

FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not FORBIDDEN.search(plan), name
