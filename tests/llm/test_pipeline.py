import corpus_pipeline


def test_stages_keep_columns_and_their_decisions(spark, folder, documents):
    docs = documents
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder).cache()
        assert out.columns == documents.columns, name
        kept = [r["doc_id"] for r in out.select("doc_id").collect()]
        assert len(kept) == len(set(kept)) and set(kept) <= ids, name
        assert name != "line dedup" or set(kept) == ids
        ids, docs = set(kept), out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r["doc_id"] for r in pieces.select("doc_id").collect()} == ids


def test_run_returns_the_last_stage(spark, folder):
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(corpus_pipeline.run(spark, folder).columns)
