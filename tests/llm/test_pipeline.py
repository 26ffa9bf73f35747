"""The corpus pipeline against its operators, and its registration."""

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.001"


def test_registered():
    names = queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert {"op5_winnowing_decontamination", "op8_line_templates"} <= set(oracle_sql())


def test_stages_keep_columns_and_decisions_hold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == columns, name
        docs = corpus_pipeline.cut(after, name)
    ids = sorted(r["doc_id"] for r in docs.collect())
    assert len(ids) == len(set(ids)) > 100
    final = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in final) == ids
