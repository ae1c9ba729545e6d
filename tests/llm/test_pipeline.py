"""The pipeline, stage by stage."""

import corpus_pipeline


def test_stages_hand_on_whole_documents(spark, small, tmp_path):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    docs, counts = documents, []
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if place < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == documents.columns
        counts.append(docs.count())
    texts = spark.read.parquet(str(tmp_path / "exact_dedup"))
    assert texts.count() == texts.select("text").distinct().count() == documents.select("text").distinct().count()
    assert counts[0] == documents.count()
    assert counts[2] <= counts[1]
    assert docs.select("doc_id").distinct().count() == spark.read.parquet(str(tmp_path / "source_mixing")).select("doc_id").distinct().count()


def test_odd_rows(spark, odd, none, small):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, small)
        assert docs.columns == odd.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, small).count()
