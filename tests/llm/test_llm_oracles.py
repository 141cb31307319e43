"""Training-data queries against their SQL, over the smallest tables."""

import pytest

from corpusloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, same_as_sql):
    same_as_sql(QUERIES[name], ORACLES[name])
