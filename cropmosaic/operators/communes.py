"""Crop tables per administrative unit."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropmosaic.functions.aggregates import lenient_sum, strict_sum
from cropmosaic.operators.prepare import add_labels
from cropmosaic.schemas import PREPARED_COLUMNS

DELIVERY = ["year", "region_code"]


def commune_crop(assigned: DataFrame, units: DataFrame, labels: DataFrame, regions: DataFrame) -> DataFrame:
    """The prepared table: one row per delivery (year, region), commune and crop group.

    `assigned` are parcels with year, region_code, data_type, geo_unit, CODE_GROUP, area_m2.
    Parcels are reduced once, with partial sums before the shuffle, so neither a large
    commune nor the parcels outside any commune end up in one task. Commune totals are sums
    of those sums, over at most one row per crop group. Names and labels depend on the key
    alone and are joined to the small result.
    """
    crops = assigned.groupBy(*DELIVERY, "geo_unit", "CODE_GROUP").agg(
        F.min("data_type").alias("data_type"),
        lenient_sum(F.col("area_m2")).alias("surf_cult_m2"),
        strict_sum(F.col("area_m2")).alias("_area"),
        F.count(F.lit(1)).alias("parcel_cult_n"),
    )
    unit = Window.partitionBy(*DELIVERY, "geo_unit")
    all_known = F.count("_area").over(unit) == F.count(F.lit(1)).over(unit)
    totals = crops.select(
        "*",
        F.when(all_known, F.sum("_area").over(unit)).alias("surf_agri_geo_unit_m2"),
        F.sum("parcel_cult_n").over(unit).alias("_parcels"),
    )
    named = add_labels(totals, labels, [*DELIVERY, "geo_unit"]).join(
        units.select("geo_unit", F.col("nom").alias("name"), (F.col("surf_ha") * 10000).alias("surf_tot_geo_unit_m2")),
        "geo_unit",
        "left",
    )
    named = named.join(regions.select("region_code", F.col("region_name").alias("region")), "region_code", "left")
    return (
        named.withColumn("surf_cult_perc", F.try_divide("surf_cult_m2", "surf_agri_geo_unit_m2"))
        .withColumn("parcel_cult_perc", F.try_divide("parcel_cult_n", "_parcels"))
        .select(*PREPARED_COLUMNS, "region_code")
    )


def department_crop(joined: DataFrame, unit: str = "geo_unit", mode: str = "parcels") -> DataFrame:
    """Crops per department from declared areas (hectares): area, share, parcels, share of parcels.

    `joined` has the unit, CODE_GROUP, surf_parc_ha and parcel_id. A parcel touching two
    departments counts in both. A department without parcels counts 0 of them, or with
    mode='rows' one, as its single row.
    """
    counted = {"parcels": F.count("parcel_id"), "rows": F.count(F.lit(1))}[mode]
    crops = joined.groupBy(unit, "CODE_GROUP").agg(
        lenient_sum(F.col("surf_parc_ha")).alias("surf_ha"),
        strict_sum(F.col("surf_parc_ha")).alias("_area"),
        counted.alias("n_parcels"),
    )
    whole = Window.partitionBy(unit)
    all_known = F.count("_area").over(whole) == F.count(F.lit(1)).over(whole)
    return crops.select(
        unit,
        "CODE_GROUP",
        "surf_ha",
        F.try_divide("surf_ha", F.when(all_known, F.sum("_area").over(whole))).alias("surf_perc"),
        "n_parcels",
        F.try_divide("n_parcels", F.sum("n_parcels").over(whole)).alias("perc_parcels"),
    )


def merge_border_communes(prepared: DataFrame, mode: str = "reference") -> DataFrame:
    """Repair communes whose parcels were delivered with two regions.

    mode='reference' adds up area and parcels per (year, commune, crop) and keeps only the
    rows of the delivery with the largest commune total: a crop present only on the smaller
    side is lost, and on a tie both sides stay. mode='complete' keeps every crop once and
    takes the attributes of the delivery with the largest total.

    A (year, commune) has at most one row per delivery and crop group, so its windows stay
    small, the one of the parcels outside all communes too; all share one shuffle.
    """
    unit = Window.partitionBy("year", "geo_unit")
    crop = Window.partitionBy("year", "geo_unit", "CODE_GROUP")
    placed = prepared.repartition("year", "geo_unit")

    def strict(column: str, window, total) -> Column:
        known = F.count(column).over(window) == F.count(F.lit(1)).over(window)
        return F.when(known, total(column).over(window))

    if mode == "reference":
        merged = (
            placed.withColumns(
                {
                    "surf_cult_m2": strict("surf_cult_m2", crop, F.sum),
                    "parcel_cult_n": F.sum("parcel_cult_n").over(crop),
                    "max_agri": strict("surf_agri_geo_unit_m2", unit, F.max),
                }
            )
            .filter(F.col("surf_agri_geo_unit_m2") == F.col("max_agri"))
        )
    elif mode == "complete":
        largest = F.struct(F.col("surf_agri_geo_unit_m2"), F.col("region_code"))
        attributes = ["cult_label", "data_type", "region", "name", "surf_tot_geo_unit_m2", "region_code"]
        merged = (
            placed.withColumn("max_agri", strict("surf_agri_geo_unit_m2", unit, F.max))
            .groupBy("year", "geo_unit", "CODE_GROUP")
            .agg(
                *[F.max_by(c, largest).alias(c) for c in attributes],
                strict_sum(F.col("surf_cult_m2")).alias("surf_cult_m2"),
                F.sum("parcel_cult_n").alias("parcel_cult_n"),
                F.max("max_agri").alias("max_agri"),
            )
        )
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return (
        merged.withColumns(
            {
                "surf_agri_geo_unit_m2": strict("surf_cult_m2", unit, F.sum),
                "N_Parcels": F.sum("parcel_cult_n").over(unit),
            }
        )
        .withColumns(
            {
                "surf_cult_perc": F.try_divide("surf_cult_m2", "surf_agri_geo_unit_m2"),
                "parcel_cult_perc": F.try_divide("parcel_cult_n", "N_Parcels"),
            }
        )
        .select(*PREPARED_COLUMNS, "max_agri", "N_Parcels", "region_code")
    )


def attach_geometry(df: DataFrame, units: DataFrame) -> DataFrame:
    """Inner join with the outlines; rows outside any unit drop out. Spark picks the join by size."""
    return df.join(units.select("geo_unit", "rings"), "geo_unit", "inner")
