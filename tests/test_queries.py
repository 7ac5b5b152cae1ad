import pytest

import __spark_entry__ as entries
import sample_oracles
from tests.compare import differences

SF_DIR = "/root/testdata/sf0.01"


def test_every_retail_query_has_an_oracle():
    assert set(entries._QUERIES) == set(sample_oracles.oracle_sql())
    assert set(entries._QUERIES) <= set(entries.queries())


@pytest.mark.parametrize("name", sorted(entries._QUERIES))
def test_query_matches_oracle(spark, name):
    assert differences(entries.queries()[name](spark, SF_DIR), entries.oracle_sql()[name], SF_DIR) == ""


def test_entry(spark):
    assert entries.entry(spark).count() > 0
