"""Every SQL-checkable registered query against its DuckDB oracle (sf0.001)."""

import pytest

from tessera.plans.catalog import ORACLE_SQL, QUERIES
from tessera.plans.compare import compare

from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    rep = compare(spark, QUERIES[name], ORACLE_SQL[name], SMALL, duck)
    assert rep["cols_ok"], rep
    assert rep["rows_ok"], rep
    assert rep["values_ok"], {k: rep[k] for k in ("only_spark", "only_sql")}
    assert not rep["types"], rep["types"]


def test_every_query_key_names_an_operator():
    import re

    for name in QUERIES:
        assert re.match(r"^([a-z]\d\d|flagship)_[a-z0-9_]+$", name), name
