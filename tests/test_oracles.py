"""Every core query with SQL against that SQL, over the smallest tables."""

import pytest

from corpusloom.queries import core_oracles, core_queries

SQL = core_oracles()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, same_as_sql):
    same_as_sql(core_queries()[name], SQL[name])


def test_registry_is_consistent():
    assert set(SQL) <= set(core_queries())
    assert len(core_queries()) > 100
