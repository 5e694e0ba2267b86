"""Deliveries staged from the test tables as files, so that the whole job can run as it does on real ones."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropmosaic.functions import geometry as G
from cropmosaic.plans import surrogates as data
from cropmosaic.schemas import DEPARTMENTS_CORSE, DEPARTMENTS_ILE_DE_FRANCE
from cropmosaic.session import stored
from cropmosaic.sinks.tables import write_features

#: Corner of the surrogates' square kilometre on the map, in metres.
EAST, NORTH = 700_000, 6_600_000
#: Region whose files are drawn in degrees.
IN_DEGREES = "R27"
FILES_PER_DELIVERY = 2


def placed(rings: str) -> str:
    """Rings moved to their place on the map."""
    return f"transform({rings}, r -> transform(r, p -> struct(p.x + {EAST} AS x, p.y + {NORTH} AS y)))"


def _write(df: DataFrame, path: str, degrees: bool, layer: str) -> None:
    if degrees:
        df = df.withColumn("rings", F.expr(G.to_lonlat("rings", str(G.LAMBERT93_SRID))))
    write_features(df, path, srid=str(G.WGS84_SRID if degrees else G.LAMBERT93_SRID), layer=layer)


def stage_deliveries(spark: SparkSession, sf_dir: str, root: str) -> None:
    """raw/delivery_<region>_<year>/ with parcels or blocks, communes/ and crop_groups/ below root.

    A delivery is split over files; one region is drawn in degrees, and so are the communes.
    """
    layers = zip(data.parcel_layers(spark, sf_dir), ("PARCELLES_GRAPHIQUES", "ILOTS_ANONYMES"))
    for layer, name in layers:
        drawn = stored(layer.withColumn("rings", F.expr(placed("rings"))))
        for region, year in sorted(map(tuple, drawn.select("region_code", "year").distinct().collect())):  # one row per delivery
            of_delivery = drawn.filter((F.col("region_code") == region) & (F.col("year") == year)).drop("region_code", "year", "feature")
            path = f"{root}/raw/delivery_{region}_{year}"
            _write(of_delivery.coalesce(FILES_PER_DELIVERY), path, region == IN_DEGREES, name)
    towns = data.communes(spark, sf_dir).select(F.col("geo_unit").alias("insee"), "nom", "surf_ha", F.expr(placed("rings")).alias("rings"))
    _write(towns.coalesce(1), f"{root}/communes", True, "communes")
    groups = data.crop_groups(spark, sf_dir).orderBy("CODE_CULTURE")
    groups.write.csv(f"{root}/crop_groups", sep=";", header=True, encoding="UTF-8")


def department_code() -> str:
    """Code of a nation as a department: first those of the two regions with lists, then others."""
    codes = DEPARTMENTS_ILE_DE_FRANCE + DEPARTMENTS_CORSE
    listed = ", ".join(f"'{c}'" for c in codes)
    return f"CASE WHEN n_nationkey < {len(codes)} THEN array({listed})[n_nationkey] ELSE CAST(n_nationkey + 10 AS STRING) END"


def stage_departments(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Two files of department outlines: one keyed code_insee in metres, one keyed insee_dep in degrees."""
    outlines = data.communes(spark, sf_dir).select(F.col("geo_unit").cast("int").alias("n_nationkey"), F.expr(placed("rings")).alias("rings"))
    for rest, key, degrees in ((0, "code_insee", False), (1, "insee_dep", True)):
        half = outlines.filter(F.col("n_nationkey") % 2 == rest).select(F.expr(department_code()).alias(key), "rings")
        _write(half.coalesce(1), f"{path}/{key}", degrees, "departments")
