"""Small helpers that several operators of this package share."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropmosaic.session import shared_folder, stored

__all__ = ["shared_folder", "stored", "id_text", "fold", "unit_hash", "unused", "running_before", "with_size_hint", "BROADCAST_BYTES"]

#: A side is broadcast only when its measured size is at most this.
BROADCAST_BYTES = 64 << 20


def id_text(key: Column) -> Column:
    """An id as text; NULL becomes the empty text."""
    return F.coalesce(key.cast("string"), F.lit(""))


def fold(key: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts."""
    return F.crc32(id_text(key)) % F.lit(parts)


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from 48 bits of the md5 of the parts joined by a bar; the same in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def unused(df: DataFrame, name: str) -> str:
    """The name, or the first of name_1, name_2, ... that no column of df has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(1, len(taken) + 2))) if n.lower() not in taken)


def bucket_count(rows: int, rows_per_bucket: int) -> int:
    return max(1, math.ceil(rows / rows_per_bucket))


def running_before(df: DataFrame, group: list[str], at: str, order: list[str], amount: str, buckets: Column, out: str) -> DataFrame:
    """df with `out`: the sum of `amount` over the rows of the same group that come before, by (at, order).

    `at` is a uniform hash in [0, 1): it cuts each group into `buckets` ranges of about equal
    size, so a group of any size is spread over many tasks. Sums per range are accumulated
    over the small table of ranges and added to the running sum within the range. NULL is an
    ordinary group. Rows equal in all of (at, order) are interchangeable.
    """
    df = df.withColumn("_range", F.floor(F.col(at) * buckets).cast("long"))
    key = [*group, "_range"]
    ranges = df.groupBy(*key).agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        *[F.col(c).alias(f"_r_{i}") for i, c in enumerate(key)],
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"),
    )
    within = Window.partitionBy(*key).orderBy(at, *order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_within", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    match = [F.col(c).eqNullSafe(F.col(f"_r_{i}")) for i, c in enumerate(key)]
    joined = df.join(ranges, match, "inner").withColumn(out, F.col("_within") + F.col("_offset"))
    return joined.drop("_range", "_within", "_offset", *[f"_r_{i}" for i in range(len(key))])


def with_size_hint(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """The frame marked for broadcast if rows x row_bytes is within the bound, else as it is (Spark then shuffles)."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
