"""Queries that SQL expresses agree with DuckDB."""

import pytest

from compare import mismatch
from rasterloom.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name, sf):
    assert mismatch(spark, f"/root/testdata/sf{sf}", QUERIES[name], ORACLE_SQL[name]) is None
