"""Driver contract: every registered query equals its DuckDB oracle (sf0.001)."""

import os

import pytest

import __spark_entry__ as entry_mod
from tests.compare import compare

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "relevant" in df.columns


@pytest.mark.parametrize("name", sorted(entry_mod.queries()))
def test_query_matches_oracle(spark, name):
    sql = entry_mod.oracle_sql().get(name)
    assert compare(spark, name, entry_mod.queries()[name], sql, SF)
