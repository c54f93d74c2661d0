import zlib

import pytest

from cdrmill.llm import toxicity as T
from .conftest import SMALL

BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    return T.score_documents(docs, labels).join(labels, "doc_id", "left").toPandas()


def test_held_out_accuracy(scored):
    assert len(scored) == 10_000 and scored["score"].between(0, 1).all()
    held = scored[scored["held_out"] & scored["toxic"].notna()]
    toxic = held["toxic"] == 1
    assert held["predicted"][toxic].mean() > 0.9  # a few labels have no sign of toxicity in the text
    assert held["predicted"][~toxic].mean() < 0.01
    assert ((scored["score"] >= 0.5) == (scored["predicted"] == 1)).all()


def test_scores_are_calibrated(scored):
    held = scored[scored["held_out"] & scored["toxic"].notna()]
    assert ((held["score"] - held["toxic"]) ** 2).mean() < 0.02


def test_held_out_rows(scored):
    want = [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored["doc_id"]]
    assert scored["held_out"].tolist() == want


def test_held_out_labels_are_never_read(spark, small_docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    turned = labels.withColumn("toxic", T.F.when(T.fold_of("doc_id") == 0, 1 - T.F.col("toxic"))
                               .otherwise(T.F.col("toxic")))
    a = T.score_documents(small_docs, labels).orderBy("doc_id").collect()
    assert a == T.score_documents(small_docs, turned).orderBy("doc_id").collect()


def test_features():
    f = dict(zip(T.FEATURES, T.features("YOU are an 1d10t, you id1ot! stupid!!", {"^stup": 4.0})))
    assert f["insult_density"] == pytest.approx(1 / 7) and f["near_you_share"] == 1
    assert f["disguised"] > 0 and f["disguised_insults"] >= 1 and f["mark_runs"] > 0
    assert f["shouted_words"] == pytest.approx(1 / 7) and f["strongest_term"] == 4.0
    assert T.features(None, {}) == T.features("", {}) == [0.0] * len(T.FEATURES)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    odd = odd_docs.withColumn("doc_id", T.F.col("doc_id") + 10**9)
    docs = odd.select("doc_id", "text").unionByName(
        spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"))
    out = T.score_documents(docs, labels).toPandas()
    assert len(out) == docs.count() and out["score"].notna().all()
    assert T.score_documents(no_docs, labels).count() == 0
    nothing = labels.where("false")
    assert [r["score"] for r in T.score_documents(odd_docs, nothing).collect()] == [0.0] * 14
    kept = T.without_toxic(odd_docs, nothing)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    odd_labels = spark.createDataFrame([(None, 1), (5, None), (5, 1), (6, 0)],
                                       "doc_id long, toxic int")
    assert T.without_toxic(odd_docs, odd_labels).count() <= odd_docs.count()
