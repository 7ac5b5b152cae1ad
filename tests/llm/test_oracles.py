"""Queries of the operators that have a DuckDB statement, against it."""

import pytest

from tallylake.llm import oracles, queries
from tests.compare import differences

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_matches_its_statement(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), oracles.ORACLES[name], SF_DIR) == ""
