"""Plans: no nested loops, no Python workers, pruned scans; entry contract; checkpoint folder."""

from __future__ import annotations

import pathlib

import pytest

SF = "/root/testdata/sf0.001"
CHEAP = ["neighbours", "observed_edges", "edge_analysis", "branch_summary", "alias_resolve", "precedence_union", "bilateral_relations",
         "longest_prefix_join", "name_match_or", "mentions", "line_sessions", "integrity_audit", "run_audit", "secondary_match"]

pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHEAP)
def test_no_nested_loops_or_python(spark, name):
    from silsila.plans.catalog import QUERIES
    text = plan(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert word not in text


def test_scans_are_pruned(spark):
    from silsila.plans.catalog import QUERIES
    text = plan(QUERIES["neighbours"](spark, SF))
    assert "l_extendedprice" not in text and "l_shipdate" not in text
    text = plan(QUERIES["unresolved_anti"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in text


def test_entry_contract(spark):
    import __spark_entry__ as e
    from silsila.plans.catalog import QUERIES
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_checkpoint_folder_of_the_session_wins(spark):
    from silsila.plans.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    before = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext._jsc.sc().getCheckpointDir().get() == before
