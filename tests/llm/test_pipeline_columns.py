"""Every pipeline stage on tables with clashing column names, null and repeated ids, and without rows."""

import pytest

import corpus_pipeline
from basketry.llm.common import table
from conftest import SF001


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stage_keeps_clashing_columns(spark, stage):
    name, fn = corpus_pipeline.STAGES[stage]
    docs = table(spark, SF001, "documents").limit(40)
    clash = docs.selectExpr("1 as score", "text", "2 as n_words", "doc_id", "3 as items", "4 as spans", "5 as `a.b`", "6 as x", "'l' as label", "7 as row")
    clash = clash.unionByName(spark.createDataFrame([(1, None, 2, None, 3, 4, 5, 6, "l", 7), (1, "", 2, 10**7, 3, 4, 5, 6, "l", 7)], clash.schema))
    got = fn(spark, clash, SF001)
    rows = got.collect()
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert got.columns == clash.columns
        assert all((r["score"], r["n_words"], r["items"], r["spans"], r["a.b"], r["x"], r["label"], r["row"]) == (1, 2, 3, 4, 5, 6, "l", 7) for r in rows)
    assert rows
    other = clash.withColumnRenamed("score", "Score").limit(0)
    assert fn(spark, other, SF001).count() == 0


def test_near_duplicates_go_by_row(spark):
    clean = "one two three four five six seven eight nine ten"
    copy = " ".join(f"w{i}" for i in range(60))
    near = copy + " more"
    rows = [(1, copy), (2, near), (2, clean), (None, copy), (None, copy + " less"), (3, near), (None, ""), (None, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, corpus_pipeline.near_duplicates(spark, docs, SF001).collect()), key=repr)
    assert got == sorted([(1, copy), (2, clean), (None, ""), (None, None), (2, "")], key=repr)
    unique = spark.createDataFrame([(5, near), (4, copy), (6, clean)], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, unique, SF001).collect()} == {4, 6}
    named = spark.createDataFrame([("b", near), ("a", copy), ("c", clean)], "doc_id string, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, named, SF001).collect()} == {"a", "c"}
