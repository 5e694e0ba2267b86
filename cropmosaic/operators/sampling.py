"""Random samples of exact size that come out the same on every run."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropmosaic.operators.prepare import PARCEL_KEY

# A sample this small is sorted out by Spark's top-k; a larger one is cut at a hash value.
TOP_K = 10_000
PREFIX = 4


def sample_rows(
    df: DataFrame,
    key: str | list[str],
    fraction: float | None = None,
    n: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """n rows, or the given fraction of all rows rounded half to even, without replacement.

    Rows are ranked by md5 of the key columns and the seed, rows of one key by a hash of all
    their columns: name the columns that tell rows apart, or rows of a key stay together. A large sample is not sorted: histograms over
    hash prefixes (65,536 buckets each, whatever the table) tell at which prefix the n-th
    row lies. All rows below it are taken and only the rest of that one bucket is ranked.
    """
    if (fraction is None) == (n is None):
        raise ValueError("give either fraction or n")
    if n is None:
        n = df.agg(F.bround(F.lit(fraction) * F.count(F.lit(1)), 0).cast("long").alias("n")).first()["n"]
    names = [key] if isinstance(key, str) else key
    ranked = df.withColumn("_h", F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in names], F.lit(str(seed)))))
    done, prefix, missing = F.lit(False), "", n
    while missing > TOP_K and len(prefix) < 8:
        width = len(prefix) + PREFIX
        buckets = (
            ranked.filter(F.col("_h").startswith(prefix))
            .groupBy(F.substring("_h", 1, width).alias("p"))
            .agg(F.count(F.lit(1)).alias("c"))
            .orderBy("p")
            .collect()  # at most 65,536 counts
        )
        crossing = None
        for bucket in buckets:
            if bucket["c"] > missing:
                crossing = bucket["p"]
                break
            missing -= bucket["c"]
        if crossing is None:
            return df
        done = F.substring("_h", 1, width) < crossing if prefix == "" else done | (
            F.col("_h").startswith(prefix) & (F.substring("_h", 1, width) < crossing)
        )
        prefix = crossing
    rest = ranked.filter(F.col("_h").startswith(prefix)).orderBy("_h", F.xxhash64(*df.columns)).limit(missing)
    if prefix == "":
        return rest.drop("_h")
    return ranked.filter(done).unionByName(rest).drop("_h")


def sample_layer(
    parcels: DataFrame, units: DataFrame, fraction: float, seed: int = 42, key: list[str] | None = None
) -> DataFrame:
    """Map layers of a sample: parcels by crop group over the outlines of their units.

    Parcels are told apart by PARCEL_KEY unless other columns are named.
    """
    sampled = sample_rows(parcels, key or PARCEL_KEY, fraction=fraction, seed=seed)
    return sampled.select(
        F.lit("parcel").alias("layer"), F.col("parcel_id").cast("string").alias("id"), "CODE_GROUP", "rings"
    ).unionByName(
        units.select(
            F.lit("unit").alias("layer"),
            F.col("geo_unit").alias("id"),
            F.lit(None).cast("string").alias("CODE_GROUP"),
            "rings",
        )
    )
