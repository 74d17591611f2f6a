"""Plan checks: no Python in the report path, filters and
column pruning reach the scans, the dictionary filter is pushed down."""

import os

import pytest

from termscope.plans import catalog

SF = "/root/testdata/sf0.001"
# The extractor hook parses files in Python.
PYTHON_QUERIES = {"extract_with_errors", "csv_cells", "folder_scan", "request_sheet"}
PY_NODES = ("MapInArrow", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if n not in PYTHON_QUERIES))
def test_no_python_in_query_plans(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF))
    assert not any(p in plan for p in PY_NODES), name
    assert "CartesianProduct" not in plan and "NestedLoopJoin Inner" not in plan.replace("BroadcastNestedLoopJoin BuildRight, Cross", ""), name


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_scan_pruned_and_filtered(spark):
    from termscope.sources.testbed import room_segments
    plan = _plan(room_segments(spark, SF))
    assert "PushedFilters: [IsNotNull(n_chars), GreaterThanOrEqual(n_chars,40)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string,n_chars:bigint>" in plan


def test_dictionary_team_filter_pushed(spark, tmp_path):
    from termscope.sources.dictionary import from_table
    p = str(tmp_path / "dict")
    spark.createDataFrame([("t1", "c", "LAN", 1), ("t2", "c", "WAN", 2)],
                          "team string, category string, keyword string, row_ord int").write.parquet(p)
    d = from_table(spark.read.parquet(p), team="t1")
    assert "EqualTo(team,t1)" in _plan(d)
    assert [r.keyword for r in d.collect()] == ["LAN"]
