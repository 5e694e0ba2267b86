"""Frequency tables, reconciliation and geometry checks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropmosaic.functions import geometry as G
from cropmosaic.functions.aggregates import strict_sum


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, NULL left out, ordered by value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(column)
    )


def area_check(parcels: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Computed against declared area in square metres, in total or per delivery.

    A single missing area leaves its sum unknown.
    """
    return (
        parcels.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("parcels"),
            strict_sum(F.col("area_m2")).alias("computed_m2"),
            (strict_sum(F.col("surf_parc_ha")) * 10000).alias("declared_m2"),
        )
        .withColumn("difference_m2", F.col("computed_m2") - F.col("declared_m2"))
    )


def flag_invalid(df: DataFrame, key: list[str], rings: str = "rings") -> DataFrame:
    """What is wrong with each geometry, judged row by row without moving any.

    open_rings, repeated_points and small_rings (fewer than three distinct points) are
    counts; misoriented tells that cleaning turned a ring, crossing that the boundary meets
    itself. Column `valid` is true where nothing was found.
    """
    repeats = (
        f"aggregate({rings}, 0, (t, r) -> t + size(filter(r, (p, i) -> i > 0 AND get(r, i - 1) = p)))"
    )
    cleaned = f"({G.clean_rings(rings)})"
    found = df.select(
        *key,
        F.expr(f"size(filter({rings}, r -> size(r) > 0 AND get(r, 0) != get(r, size(r) - 1)))").alias("open_rings"),
        F.expr(repeats).alias("repeated_points"),
        F.expr(f"size(filter({rings}, r -> size(array_distinct(r)) < 3))").alias("small_rings"),
        F.expr(
            f"aggregate({rings}, 0, (t, r) -> t + CASE WHEN {G.signed_ring_area('r')} < 0 THEN 1 ELSE 0 END) != "
            f"aggregate({cleaned}, 0, (t, r) -> t + CASE WHEN {G.signed_ring_area('r')} < 0 THEN 1 ELSE 0 END)"
        ).alias("misoriented"),
        F.expr(G.self_crossing(rings)).alias("crossing"),
    )
    return found.withColumn(
        "valid",
        (F.col("open_rings") == 0)
        & (F.col("repeated_points") == 0)
        & (F.col("small_rings") == 0)
        & ~F.col("misoriented")
        & ~F.col("crossing"),
    )


def clean_geometry(df: DataFrame, rings: str = "rings") -> DataFrame:
    """The same rows with closed, de-duplicated and correctly oriented rings."""
    return df.withColumn(rings, F.expr(G.clean_rings(rings)))
