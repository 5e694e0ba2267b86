"""The registered queries of this package and their SQL twins."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropmosaic.llm import (
    ann,
    decontamination,
    divergence,
    importance,
    language_id,
    licenses,
    lm_scoring,
    mixing,
    quality,
    sharding,
    simhash,
    url_filter,
    warc,
)
from cropmosaic.llm.common import fold
from cropmosaic.llm.sql import ORACLE  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table by its name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under the unigram base and the mixed bit model; remainder 2 of 7 is held out."""
    return lm_scoring.score(table(spark, sf_dir, "documents"), held_out=(7, 2))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, and the smallest id that links of at most 3 bits reach."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.hex("bits")).alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, its source at weight 1, 2 or 3."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by the rules, else by its host's trust on the link graph."""
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the fewest phrases of a cross-parse; remainder 2 of 4 is held out."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, held_out=(4, 2))
    told = docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), language_id.predict(F.col("text"), model).alias("p"))
    return told.select("doc_id", "held_out", F.col("p")["lang"].alias("lang_pred"), F.col("p")["score"].alias("score"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from the marginals of its lines; remainder 0 of 5 is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), held_out=(5, 0))
    scored = docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), quality.quality(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives through the capture index."""
    read = warc.archive_and_read(table(spark, sf_dir, "pages"), least_bytes=0)
    return read.select(
        F.col("page_id").try_cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").try_cast("long").alias("refers_to"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot, and shard if there were one more, of every document under the law `key`."""
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside a benchmark window of 10 words, and the items found."""
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 largest inner products of every vector whose id is divisible by 20."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), queries=F.col("id") % 20 == 0, k=20)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn towards the benchmark's words: 25 in 100 of those with 20 words or more."""
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases, notices and texts of every document."""
    found = licenses.license_scan(table(spark, sf_dir, "documents"))
    names = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *names, "score")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and the terms that set them apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_simhash": op2_simhash,
    "op3_mixing": op3_mixing,
    "op4_url_filter": op4_url_filter,
    "op5_language": op5_language,
    "op6_quality": op6_quality,
    "op7_warc": op7_warc,
    "op8_sharding": op8_sharding,
    "op9_decontamination": op9_decontamination,
    "op10_nearest": op10_nearest,
    "op11_importance": op11_importance,
    "op12_licenses": op12_licenses,
    "op13_divergence": op13_divergence,
}
