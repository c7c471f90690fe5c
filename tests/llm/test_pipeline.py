from sparkloom.llm import mixing, ngram_join, packing, quality, toxicity

from . import cases
from .test_models import toxic_corpus
from .test_similarity import near_copies


def test_pipeline_equals_its_stages_one_by_one(spark, tmp_path):
    import corpus_pipeline

    docs, labels, _ = toxic_corpus(spark)
    copies = spark.createDataFrame([(5000 + i, t, "en", "src2", 1, "", "", "", "", "") for i, t in enumerate(near_copies(5, 12, 150, 1))], docs.schema)
    docs = docs.unionByName(copies)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    keep = {r.doc_id for r in quality.judge_quality(at).collect() if r.kept}
    good = at.where(at.doc_id.isin([k for k in keep if k is not None]) | at.doc_id.isNull()) if None in keep else at.where(at.doc_id.isin(list(keep)))
    toxic = {r.doc_id for r in toxicity.score_documents(good, labels).collect() if r.predicted}
    clean = good.where(~good.doc_id.isin(list(toxic)) | good.doc_id.isNull())
    assert 0 < len(toxic) and clean.count() < good.count()
    one = ngram_join.one_of_each(clean)
    kept = {r.doc_id for r in one.collect()}
    assert len([d for d in kept if d is not None and 5000 <= d < 5012]) == 1
    copies_by_doc = {r.doc_id: r.copies for r in mixing.mix(one).collect()}
    pieces = got.collect()
    whole = {}
    for r in pieces:
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length / r.doc_tokens
    assert {d: round(v) for d, v in whole.items()} == {d: n for d, n in copies_by_doc.items() if n}
    assert packing.pack(mixing.mixed_documents(one)).count() == got.count()


def test_stages_take_empty_tables_and_keep_columns(spark, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "n-gram Jaccard join", "mixing", "packing"]
    empty = cases.empty(spark)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0
        if n < 4:
            assert out.schema.simpleString() == empty.schema.simpleString()
