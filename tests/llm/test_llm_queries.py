"""The queries of the subpackage against their SQL, and the pipeline's stages."""

import pytest
from llm_corpus import SCHEMA

import corpus_pipeline
from checks.compare import compare, connect
from skylattice.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE_SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_query_has_a_row_per_document(spark, name):
    found = queries.QUERIES[name](spark, SF)
    assert found.select("doc_id").distinct().count() == 200


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_keeps_columns_and_takes_any_rows(spark, docs, clashing, empty, tmp_path, name, stage):
    for table in (docs, empty, clashing, spark.createDataFrame([(None,) * 5] * 2, SCHEMA)):
        found = stage(spark, table, SF)
        if name != "pack":
            assert found.columns == table.columns and found.dtypes == table.dtypes
        found.write.mode("overwrite").parquet(f"file://{tmp_path}/{name}")


def test_pipeline(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.count() > 200
    assert found.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0
