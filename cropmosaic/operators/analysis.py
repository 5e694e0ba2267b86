"""Shares, leading crops, richness and diversity."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cropmosaic.functions.aggregates import distinct_with_null, lenient_sum, shannon, simpson


def national_crop_share(compiled: DataFrame, year: int | None = None, denominator: str = "rows") -> DataFrame:
    """Area and parcels per crop label with their percentages of the grand totals.

    denominator='rows' adds up the commune totals once per crop row of the commune, so the
    percentages stay below 100 in sum; 'geo_unit' counts each commune once.
    """
    rows = compiled if year is None else compiled.filter(F.col("year") == year)
    labels = rows.groupBy("cult_label").agg(
        lenient_sum(F.col("surf_cult_m2")).alias("surf_cult_m2"),
        lenient_sum(F.col("parcel_cult_n")).alias("parcel_cult_n"),
        F.sum("surf_agri_geo_unit_m2").alias("_agri"),
        F.sum("N_Parcels").alias("_parcels"),
    )
    if denominator == "rows":
        base = labels
    elif denominator == "geo_unit":
        base = rows.groupBy("year", "geo_unit").agg(
            F.max("surf_agri_geo_unit_m2").alias("_agri"), F.max("N_Parcels").alias("_parcels")
        )
    else:
        raise ValueError(f"unknown denominator {denominator!r}")
    total_area = base.agg(F.sum("_agri")).scalar()
    total_parcels = base.agg(F.sum("_parcels")).scalar()
    return labels.select(
        "cult_label",
        "surf_cult_m2",
        (F.try_divide("surf_cult_m2", total_area) * 100).alias("surf_cult_perc"),
        "parcel_cult_n",
        (F.try_divide("parcel_cult_n", total_parcels) * 100).alias("parcel_cult_perc"),
    )


def top_crop(df: DataFrame, keys: list[str], by: str = "surf_cult_perc") -> DataFrame:
    """Rows holding the largest value of their group; ties are all kept, NULL and NaN never win.

    Groups that include geo_unit have at most one row per crop group (and delivery) and are
    ranked in a window. Any other key, such as a name shared by many communes, may hold a
    large part of the table: there the maxima are found with partial aggregation and joined
    back on key and value, so a hot group is spread by its values.
    """
    value = F.nanvl(F.col(by).cast("double"), F.lit(None).cast("double"))
    if "geo_unit" in keys:
        order = Window.partitionBy(*keys).orderBy(value.desc_nulls_last())
        ranked = df.withColumn("_rank", F.rank().over(order)).filter((F.col("_rank") == 1) & value.isNotNull())
        return ranked.drop("_rank")
    best = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(value).alias("_best"))
    match = value == F.col("_best")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(best, match, "left_semi")


def crop_richness(df: DataFrame, keys: list[str], value: str = "cult_label") -> DataFrame:
    """Number of different crops per group; a missing label counts as one more."""
    return df.groupBy(*keys).agg(distinct_with_null(F.col(value)).alias("crops"))


#: Registers of a richness sketch are 2^SKETCH_BITS; the standard error of an estimate is about 1.04 / 2^(SKETCH_BITS / 2).
SKETCH_BITS = 12


def richness_sketch(df: DataFrame, keys: list[str], value: str = "cult_label") -> DataFrame:
    """keys, sketch, unknown: the distinct values of each group in bounded size, to be kept and merged upward.

    `unknown` tells whether NULL is among them, as NULL counts as a value. A group of only NULLs has an empty sketch.
    """
    return df.groupBy(*keys).agg(
        F.hll_sketch_agg(F.col(value), SKETCH_BITS).alias("sketch"), F.max(F.col(value).isNull()).alias("unknown")
    )


def merge_richness(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """keys, sketch, unknown of coarser groups, from the sketches of finer ones; the finer rows are not read again."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"), F.max("unknown").alias("unknown"))


def estimated_richness(sketches: DataFrame) -> DataFrame:
    """The sketches replaced by `crops`, their estimated number of distinct values, NULL being one.

    The standard error is 1.6 % (see SKETCH_BITS); small groups are counted exactly.
    """
    crops = F.hll_sketch_estimate("sketch") + F.col("unknown").cast("long")
    return sketches.withColumn("crops", crops).drop("sketch", "unknown")


def diversity(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Shannon and Simpson index per group, from the shares of `value` in its group sum."""
    return df.groupBy(*keys).agg(
        shannon(F.col(value)).alias("shannon_diversity"),
        simpson(F.col(value)).alias("simpson_diversity"),
    )
