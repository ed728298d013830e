import os

import pytest

import corpus_pipeline
from llm_odd import SF_DIR


def test_stages_keep_the_columns_and_take_effect(spark, given, tmp_path):
    docs, counts = given, [given.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == given.columns and docs.dtypes == given.dtypes
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
    assert counts[0] > counts[1] == counts[2] > counts[3]
    assert docs.where("n_chars != length(text)").isEmpty()
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    rows = encoded.collect()
    assert len(rows) == counts[-1] and all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    again = corpus_pipeline.run(spark, SF_DIR).collect()
    key = lambda found: sorted((r["doc_id"], r["ids_sha256"]) for r in found)
    assert key(rows) == key(again)


@pytest.mark.parametrize("make", ["odd", "empty"])
def test_odd_and_empty_documents(spark, make, request, tmp_path):
    frame = request.getfixturevalue(make).select("doc_id", "text", "lang", "source", "n_chars")
    root = tmp_path / "tables"
    frame.write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    rows = corpus_pipeline.run(spark, str(root)).collect()
    assert (rows == []) == (make == "empty")


def test_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert "pipeline" in names and len([n for n in names if n.startswith("op")]) == 13
    assert set(__spark_entry__.oracle_sql()) <= set(names)
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"
