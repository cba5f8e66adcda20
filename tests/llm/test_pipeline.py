"""Every stage on all that the one before it kept, and the registered queries."""

import __spark_entry__ as entry_points
import corpus_pipeline
from basketry.llm import queries as llm
from basketry.llm.scratch import stored


def test_stages_on_odd_rows(spark, docs):
    for rows in (docs(), docs([])):
        frame, columns = rows, rows.columns
        for number, (name, stage) in enumerate(corpus_pipeline.STAGES, 1):
            frame = stored(stage(spark, frame, ""), f"test-{name}")
            assert number == len(corpus_pipeline.STAGES) or frame.columns == columns
        assert frame.count() >= 0


def test_run_packs_what_the_stages_keep(spark, sf):
    result = corpus_pipeline.run(spark, sf)
    rows = result.collect()
    assert rows and all(r.length <= 4096 for r in rows)
    ids = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} <= ids


def test_registered_queries():
    names = entry_points.queries().keys()
    assert "pipeline" in names and set(llm.queries()) <= names
    assert sorted(int(n[2:].split("_")[0]) for n in llm.queries()) == list(range(1, 14))
