from __future__ import annotations

import corpus_pipeline
from ledgerline.llm.queries import documents
from ledgerline.workspace import freeze


def test_stages(spark, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    docs = documents(spark, sf_dir)
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = freeze(stage(spark, docs, sf_dir))
        assert after.columns == columns and after.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
        assert after.count() <= docs.count() and after.count() == after.select("doc_id").distinct().count()
        for row in after.collect():
            assert row.text == texts[row.doc_id] or name == "line_dedup"
            assert row.n_chars == len(row.text)
        texts = {r.doc_id: r.text for r in after.collect()}
        docs = after
    packed = corpus_pipeline.pack(spark, docs, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(texts)


def test_empty_and_odd_documents(spark, sf_dir):
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (None, "no id here at all", "en", "s", 17), (2, "", "en", "s", 0), (2, "", "en", "s", 0)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).count() == docs.count()
        assert corpus_pipeline.pack(spark, docs, sf_dir).count() == docs.count()
