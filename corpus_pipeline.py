"""A training corpus from raw documents, stage by stage."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropmosaic.llm import decontamination, mixing, quality, sharding, simhash
from cropmosaic.llm.common import stored, unused


#: Documents of a lower score are rejected.
GOOD = 0.3


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality is at least GOOD; empty ones are judged like any other."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused(docs, "score")
    return docs.withColumn(score, quality.quality(F.col("text"), model)).filter(F.col(score) >= GOOD).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies: fingerprints of 3-word shingles at most 3 bits apart, in chains."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no phrase of the benchmark stands."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    matches = unused(docs, "matches")
    found = decontamination.find_phrases(docs, items, out=matches)
    return found.filter(F.size(matches) == 0).drop(matches)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source at its target share; documents repeat, are cut or left out as the budget asks."""
    return mixing.materialize(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and grown_shard of every document kept."""
    return sharding.shard_documents(docs, shards=40)


STAGES = [
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix_sources),
    ("sharding", shard),
]
ORACLE_SQL = None  # the learned stages have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
