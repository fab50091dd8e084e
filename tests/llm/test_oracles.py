"""Every query with SQL against DuckDB, on the whole smallest tables."""

import compare
import pytest

from docloom.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf, duck, name):
    assert not compare.differences(queries()[name](spark, sf), duck, oracle_sql()[name])
