"""Every core query with SQL agrees with it on the small tables; every other one runs."""

import pytest
from tests.compare import same

from millrace.plans import build_queries, graph_queries, record_queries, training_core

MODULES = (graph_queries, build_queries, record_queries, training_core)
CHECKED = [(m, n) for m in MODULES for n in m.SQL]
OTHERS = [(m, n) for m in MODULES for n in m.QUERIES if n not in m.SQL]


@pytest.mark.parametrize(("module", "name"), CHECKED, ids=[n for _, n in CHECKED])
def test_sql(spark, small, module, name):
    same(spark, small, module.QUERIES[name], module.SQL[name])


@pytest.mark.parametrize(("module", "name"), OTHERS, ids=[n for _, n in OTHERS])
def test_runs(spark, small, module, name):
    rows = module.QUERIES[name](spark, small)
    assert rows.columns and rows.count() >= 0


def test_entry(spark, small):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["a", "b", "weight"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
