import corpus_pipeline as P
from .conftest import SMALL


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing",
                                        "sharding"]


def test_each_stage_keeps_columns_and_only_drops_rows(spark, small_docs, tmp_path):
    docs = small_docs
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SMALL)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "sharding":
            assert out.columns == docs.columns
            assert out.exceptAll(docs).count() == 0 and 0 < out.count() <= docs.count()
        else:
            assert out.count() == docs.count()
        docs = out


def test_run_equals_the_operators(spark, small_docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    docs = P.without_toxic(small_docs, labels)
    docs = P.decontaminate(P.one_per_class(docs), bench)
    assert ids(P.run(spark, SMALL)) == ids(P.mix(docs))


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in P.STAGES:
            out = stage(spark, docs, SMALL)
            if name != "sharding":
                assert out.columns == docs.columns
            assert out.count() <= docs.count()
