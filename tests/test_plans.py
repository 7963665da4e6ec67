"""Plan-shape guards for the scale properties (no Python nodes, pruned scans
and rules)."""

import __spark_entry__ as E
from hirescope.plans import registry
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_execution_nodes(spark):
    for name, fn in registry.QUERIES.items():
        p = _plan(fn(spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
            assert node not in p, (name, node)


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned(spark):
    p = _executed(E.queries()["segment_value_counts"](spark, SF_SMALL))
    assert "ReadSchema: struct<c_mktsegment:string>" in p
    p = _executed(E.queries()["distinct_counts"](spark, SF_SMALL))
    assert "comment" not in p


def test_rules_nobody_reads_are_pruned(spark):
    """A count per city runs no skill, category, level or company rule."""
    p = _plan(E.queries()["postings_by_city"](spark, SF_SMALL))
    assert "scikit-learn" not in p and "Stakeout" not in p and p.count("Contains(") <= 40 and len(p) < 100_000


def test_chi_square_reads_each_table_once(spark):
    import re
    p = _executed(E.queries()["brand_priority_chi_square"](spark, SF_SMALL))
    for name in ("lineitem", "orders", "part"):
        assert len(set(re.findall(rf"Location: [^\n]*/{name}\.parquet", p))) <= 1
