"""Joins that hold when one key carries a large part of the rows, and checked broadcasts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, row_bytes: Column | int = 256, limit: int = BROADCAST_BYTES) -> bool:
    """Measure the frame with one aggregate and tell whether it may be broadcast.

    The aggregate returns a single number; the rows stay where they are.
    """
    size = df.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes).alias("b")).first()["b"]
    return (size or 0) <= limit


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "left",
    shares: int = 1000,
    condition: Column | None = None,
) -> DataFrame:
    """Equi-join in which a hot key of the left side is spread over many tasks.

    A key is hot when it holds more than 1/shares of the left rows, so there are fewer than
    `shares` hot keys whatever the data and their list can be broadcast. Left rows of a hot
    key are dealt out by a hash of `spread_by`, and only the right rows of hot keys are
    repeated, once per salt. Left rows with a NULL key match nothing and are dealt out too.
    """
    if how not in ("left", "inner"):
        raise ValueError("salted_join spreads the left side, so only left and inner joins")
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    share = counts.agg(F.ceil(F.sum("_rows") / shares).alias("s")).scalar()
    hot = (
        counts.filter(F.col("_rows") > share)
        .select(*on, F.ceil(F.col("_rows") / share).cast("int").alias("_salts"))
    )
    hot = F.broadcast(hot)
    null_key = F.lit(False)
    for key in on:
        null_key = null_key | F.col(key).isNull()
    salts = F.when(null_key, F.lit(shares)).otherwise(F.coalesce("_salts", F.lit(1)))
    dealt = (
        left.join(hot, on, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts).cast("int"))
        .drop("_salts")
    )
    repeated = (
        right.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return keyed_join(dealt, repeated, [*on, "_salt"], how, condition).drop("_salt")


def keyed_join(left: DataFrame, right: DataFrame, on: list[str], how: str, condition: Column | None) -> DataFrame:
    """Join on equal columns and a further condition, keeping the left key columns."""
    if condition is None:
        return left.join(right, on, how)
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in on})
    for k in on:
        condition = condition & (F.col(k) == F.col(f"_right_{k}"))
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in on])


def sized_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "left",
    row_bytes: Column | int = 256,
    limit: int = BROADCAST_BYTES,
    condition: Column | None = None,
) -> DataFrame:
    """Broadcast the right side when its measured size allows, else join with salted hot keys."""
    if fits_broadcast(right, row_bytes, limit):
        return keyed_join(left, F.broadcast(right), on, how, condition)
    return salted_join(left, right, on, spread_by, how, condition=condition)
