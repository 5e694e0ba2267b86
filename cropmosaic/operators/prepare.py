"""From delivered parcel layers to one uniform parcel table, and the label dimension."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropmosaic.functions import geometry as G
from cropmosaic.functions.text import strip_leading_zero
from cropmosaic.operators.skew import sized_join
from cropmosaic.schemas import extra_labels

#: A parcel is a feature of a file. Its id alone may be repeated, by other years, regions, or within a file.
PARCEL_KEY = ["year", "region_code", "parcel_id", "feature"]


def _optional(df: DataFrame, names: list[str], kind: str) -> Column:
    """First non-NULL of the columns that exist; deliveries differ in their names by year."""
    present = {c.lower() for c in df.columns}
    found = [F.col(n).cast(kind) for n in names if n.lower() in present]
    return F.coalesce(*found) if found else F.lit(None).cast(kind)


def normalize_parcels(df: DataFrame, kind: str, region_code: Column | None = None, year: Column | None = None) -> DataFrame:
    """Parcels (kind 'pg') or blocks ('ia') as one layout.

    parcel_id, feature, CODE_GROUP, data_type, region_code, year, area_m2, surf_parc_ha, rings.
    `feature` tells features apart that share an id: the place in the file (source_path,
    record), a column of that name, or else NULL. Outlines are brought to Lambert-93; an
    unknown or NULL srid is an error, a frame without a srid column is taken to be in metres.
    The area is that of the outline in metres. Blocks carry the group code in CODE_CULTU and no
    declared area. Features without an id are left out.
    """
    ids, codes = {
        "pg": (["ID_PARCEL"], ["CODE_GROUP"]),
        "ia": (["NUM_ILOT", "ID_ILOT"], ["CODE_CULTU"]),
    }[kind]
    if {"source_path", "record"} <= set(df.columns):
        feature = F.concat_ws("#", "source_path", F.col("record").cast("string"))
    else:
        feature = _optional(df, ["feature"], "string")
    if "srid" in df.columns:
        df = df.withColumn("rings", F.expr(G.to_lambert93("rings", "srid")))
    return df.select(
        _optional(df, ids, "string").alias("parcel_id"),
        feature.alias("feature"),
        strip_leading_zero(_optional(df, codes, "string")).alias("CODE_GROUP"),
        F.lit(kind).alias("data_type"),
        (F.col("region_code") if region_code is None else region_code).cast("string").alias("region_code"),
        (F.col("year") if year is None else year).cast("int").alias("year"),
        F.expr(G.polygon_area("rings")).alias("area_m2"),
        _optional(df, ["SURF_PARC"], "double").alias("surf_parc_ha"),
        "rings",
    ).filter(F.col("parcel_id").isNotNull())


def normalize_communes(df: DataFrame) -> DataFrame:
    """Commune outlines in metres with their key: geo_unit, nom, surf_ha, rings."""
    return df.select(
        F.col("insee").alias("geo_unit"),
        "nom",
        "surf_ha",
        F.expr(G.to_lambert93("rings", "srid")).alias("rings"),
    )


def normalize_departments(df: DataFrame) -> DataFrame:
    """Department outlines in metres: geo_unit, rings. Both key names found in deliveries are known."""
    return df.select(
        _optional(df, ["code_insee", "insee_dep"], "string").alias("geo_unit"),
        F.expr(G.to_lambert93("rings", "srid")).alias("rings"),
    )


def units_of_region(units: DataFrame, codes: list[str], unit: str = "geo_unit") -> DataFrame:
    """The units whose code is in the list."""
    return units.filter(F.col(unit).isin(codes))


def first_per_group(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """One row per key: the value of the row that comes first in the given order."""
    return df.groupBy(*keys).agg(F.min_by(value, order).alias(value))


def crop_label_dim(crop_groups: DataFrame) -> DataFrame:
    """CODE_GROUP -> cult_label, one row per group, completed by the four unpublished groups."""
    published = first_per_group(
        crop_groups.select(
            F.col("CODE_GROUPE_CULTURE").cast("string").alias("CODE_GROUP"),
            F.col("LIBELLE_GROUPE_CULTURE").alias("cult_label"),
            "CODE_CULTURE",
        ),
        ["CODE_GROUP"],
        "cult_label",
        "CODE_CULTURE",
    )
    return published.unionByName(extra_labels(crop_groups.sparkSession))


def add_labels(df: DataFrame, labels: DataFrame, spread_by: list[str] | None = None) -> DataFrame:
    """Left join on the group code.

    The labels are broadcast when their measured size allows. Otherwise rows of a frequent
    code are spread by the columns in `spread_by` (all, unless named).
    """
    return sized_join(df, labels.select("CODE_GROUP", "cult_label"), ["CODE_GROUP"], spread_by or df.columns)
