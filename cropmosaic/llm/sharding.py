"""Rendezvous hashing of record keys over weighted shards."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropmosaic.llm.common import bucket_count, id_text, running_before, stored, unit_hash

ROWS_PER_BUCKET = 100_000


def rendezvous(key: Column, weights: Sequence[float], seed: str = "shard") -> Column:
    """The shard (position in `weights`) with the highest score -weight / ln(u), u a hash of key and shard.

    A shard's share of the keys is its share of the weights. A further shard, or a heavier one,
    only takes keys to itself; one that goes only gives its own away. A weight of 0 takes none.
    Key and weights decide alone: equal keys share a shard, NULL is the key ''. Equal scores go
    to the smaller shard.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must hold a positive number and none below zero")
    table = F.array(*[F.struct(F.lit(-i).alias("nid"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights) if w > 0])
    name = id_text(key)

    def score(shard: Column) -> Column:
        u = unit_hash(F.lit(seed), name, (-shard["nid"]).cast("string")) + F.lit(2.0**-49)
        return F.struct((-shard["w"] / F.log(u)).alias("score"), shard["nid"].alias("nid"))

    return -F.array_max(F.transform(table, score))["nid"]


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", overhead: int = 16) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, grown_shard.

    size: bytes of the text (NULL: 0) plus `overhead`; text_crc32 of NULL is that of ''.
    slot: 0, 1, ... within the shard, in the order of a hash of the key. grown_shard: the shard
    if there were one more. Repeated rows each get a slot of their own; an empty table gives none.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.col(key).alias("doc_id"),
            (F.octet_length(body) + F.lit(overhead)).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            rendezvous(F.col(key), [1.0] * shards).cast("int").alias("shard"),
            rendezvous(F.col(key), [1.0] * (shards + 1)).cast("int").alias("grown_shard"),
            unit_hash(F.lit("slot"), id_text(F.col(key))).alias("_at"),
            F.lit(1).cast("long").alias("_one"),
        )
    )
    buckets = bucket_count(rows.count() // shards, ROWS_PER_BUCKET)
    placed = running_before(rows, ["shard"], "_at", ["doc_id", "size", "text_crc32"], "_one", F.lit(buckets), "slot")
    return placed.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
