"""Every pipeline stage on odd documents and on none."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardwarden.llm.common import DOC_COLUMNS

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_odd_documents(spark, odd_docs, no_docs, name, stage):
    docs = odd_docs.withColumn("__score", F.lit(1)).withColumn("size", F.lit("clash")).withColumn("__hit", F.lit(2))
    out = stage(spark, docs, FOLDER)
    rows = out.collect()
    assert set(DOC_COLUMNS) <= set(out.columns)
    ids = {r["doc_id"] for r in rows}
    known = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert ids <= known
    if name != "mixing":
        assert tuple(out.columns) == DOC_COLUMNS
    if name == "near_duplicates":
        # One of the copies and of the repeated rows; texts without words and rows without id stay.
        assert len([i for i in ids if i is not None and 100 <= i < 225]) == 1
        assert {300, 301, 302, None} <= ids and 310 not in ids and [r["doc_id"] for r in rows].count(5) == 1
        assert [r["doc_id"] for r in rows].count(None) == 3
    if name == "secrets":
        assert len(rows) == docs.count() and not any("AKIA" in (r["text"] or "") for r in rows)
    if name == "decontamination":
        assert len(rows) == docs.count()
    assert stage(spark, no_docs, FOLDER).count() == 0
