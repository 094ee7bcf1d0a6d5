"""The corpus queries that SQL can express at small tables."""

import pytest
from compare import compare, duck

from serpscope.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data, name):
    assert compare(spark, duck(data), QUERIES[name], ORACLES[name], data) == []


def test_names_of_queries():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
