import corpus_pipeline
from smeltwork.llm.common import table
from smeltwork.llm.simhash import near_duplicates
from tests.llm.conftest import SF


def test_stages_run_on_the_given_tables(spark, tmp_path):
    docs, before = table(spark, SF, "documents"), None
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        if i < 3:
            assert docs.columns == columns
            assert docs.join(before.select("doc_id"), "doc_id", "left_anti").count() == 0
            assert docs.count() <= before.count()
        if name == "simhash_near_dedup":
            assert near_duplicates(docs).select("group").distinct().count() == docs.count()
    assert docs.columns == ["doc_id", "piece", "n_tokens", "bucket_len", "batch", "slot"]
    words = {r["doc_id"]: len(r["text"].split()) for r in before.collect()}
    assert docs.selectExpr("sum(n_tokens)").first()[0] == sum(len(r["text"].split()) for r in before.collect())
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == set(words)


def test_reruns_agree(spark):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()), key=repr) == sorted(
        map(tuple, corpus_pipeline.run(spark, SF).collect()), key=repr)


def test_stages_take_odd_documents(spark, make_docs, odd_rows):
    for rows in (odd_rows, []):
        docs = make_docs(rows) if rows else make_docs(odd_rows).limit(0)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            out.count()
            if name != "length_bucket_packing":
                assert out.columns == docs.columns
