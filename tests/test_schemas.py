import os

import pytest
from pyspark.sql import types as T

from quernstone.sources import schemas

ROOT = "/root/testdata/sf0.001"
TABLES = {
    "random_sources_preview": schemas.BANK, "mineru_preview_10_questions": schemas.BLOCK, "curriculum_scan": schemas.LESSON, "canonical_topics": schemas.TOPIC,
    "canonical_subtopics": schemas.SUBTOPIC, "standard_exam_sets": schemas.EXAM_SET, "standard_exam_links": schemas.EXAM_LINK, "standard_exam_questions": schemas.EXAM_QUESTION,
}


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(TABLES))
def test_schema_is_that_of_the_table(spark, name):
    there = {f.name: f.dataType.simpleString() for f in spark.read.parquet(f"{ROOT}/{name}.parquet").schema}
    assert {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(TABLES[name])} == there
