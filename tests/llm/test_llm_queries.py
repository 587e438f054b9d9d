import pytest

from millrace.llm import queries
from tests.compare import same


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, small, name):
    same(spark, small, queries.QUERIES[name], queries.SQL[name])


COLUMNS = {
    "p2_found": ["rec_id", "pii_type", "pii_text"],
    "p4_found": ["field", "row_id", "restored_md5"],
    "p7_found": ["entity_id_a", "entity_id_b"],
    "p9_found": ["doc_id", "item_id"],
    "p10_found": ["doc_id_a", "doc_id_b"],
}


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.SQL])
def test_runs_without_repeats(spark, small, name):
    rows = queries.QUERIES[name](spark, small)
    assert rows.columns == COLUMNS.get(name, rows.columns)
    got = rows.collect()
    if name in COLUMNS:
        assert got and len(set(got)) == len(got)
