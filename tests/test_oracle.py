"""Every registered query with SQL gives the rows DuckDB gives."""

import pytest

from compare import difference, oracle
from conftest import SF

from alertloom.plans.oracle import ORACLE
from alertloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    rows = e.entry(spark).collect()
    assert len(rows) == 4 and sum(r["fired_count"] for r in rows) == 570
    assert set(e.oracle_sql()) <= set(e.queries())
