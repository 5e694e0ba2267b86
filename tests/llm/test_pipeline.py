"""The pipeline, stage by stage, with planted cases."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from cropmosaic.llm import quality
from cropmosaic.llm.common import stored
from llm_fixtures import make_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF))
        assert out.columns == docs.columns, name
        if name != "source mixing":
            assert 0.5 * before < out.count() <= before
            assert out.join(docs, docs.columns, "left_anti").count() == 0
        docs, before = out, out.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() and last.filter("shard < 0 OR shard > 39").count() == 0


def test_quality_stage_keeps_good_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = corpus_pipeline.quality_filter(spark, docs, SF).join(labels, "doc_id").groupBy("quality").count()
    all_ = dict(docs.join(labels, "doc_id").groupBy("quality").count().collect())
    kept = dict(kept.collect())
    assert kept[1] >= 0.97 * all_[1] and kept.get(0, 0) <= 0.3 * all_[0]


def test_leaks_and_copies_go(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 100").first()["text"]
    rng = np.random.default_rng(0)
    words = [f"t{i}" for i in range(2000)]
    clean = " ".join(rng.choice(words, 120))
    rows = [(1, clean), (2, clean), (3, "intro " + item.upper() + " end"), (4, " ".join(rng.choice(words, 50))), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r[0] for r in corpus_pipeline.near_dedup(spark, docs, SF).select("doc_id").collect()} == {1, 3, 4, 5}
    assert {r[0] for r in corpus_pipeline.decontaminate(spark, docs, SF).select("doc_id").collect()} == {1, 2, 4, 5, 6}


def test_odd_and_empty(spark, odd_docs):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        stored(stage(spark, docs.limit(0), SF))
        docs = stored(stage(spark, docs, SF))
    assert docs.filter(F.col("slot") < 0).count() == 0


def test_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    for name in ("score", "_score", "matches", "_matches", "_id", "_label", "MATCHES_1", "_doc", "_body", "component_id", "position"):
        docs = docs.withColumn(name, F.col("doc_id"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(docs)
        out = stored(stage(spark, docs, SF))
        assert out.columns == docs.columns and out.filter("_score <> doc_id OR MATCHES_1 <> doc_id").count() == 0, name
        docs = out


def test_model_is_stable(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    a, b = quality.train(docs, labels), quality.train(docs.repartition(7), labels.repartition(3))
    assert np.allclose(a.weights, b.weights)
