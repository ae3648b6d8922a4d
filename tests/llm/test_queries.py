import pytest

from quernstone.llm import queries

COLUMNS = {
    "p1_found": ["id_a", "id_b"], "p2_found": ["file_a", "file_b"], "p3_found": ["question_id", "field_name", "canonical_id"],
    "p4_found": ["source_table", "row_key", "line_no", "defect"], "p5_found": ["source_table", "key_a", "key_b"], "p6_found": ["question_id", "defect"],
    "p7_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "reading_level"],
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, root, name):
    got = queries.queries()[name](spark, root)
    assert name not in COLUMNS or got.columns == COLUMNS[name]
    rows = got.collect()
    assert rows and len({str(r) for r in rows}) == len(rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in plan for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"))
