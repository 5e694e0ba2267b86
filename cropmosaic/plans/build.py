"""The whole job: delivered layers -> prepared table -> compiled table -> map table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropmosaic.operators import communes, prepare, spatial
from cropmosaic.schemas import region_dim
from cropmosaic.sinks.tables import write_compiled, write_prepared
from cropmosaic.sources.layers import FOLDER_PATTERN, list_layers, pick_layer
from cropmosaic.sources.shapefile import read_shapefiles
from cropmosaic.sources.tables import load_prepared, read_crop_groups


def read_parcels(spark: SparkSession, raw_root: str, folder_pattern: str = FOLDER_PATTERN) -> DataFrame:
    """All deliveries as one frame. The choice of layers has one row per region and year."""
    chosen = pick_layer(list_layers(spark, raw_root), folder_pattern).collect()
    frames = []
    for kind in ("pg", "ia"):
        paths = [row["path"] for row in chosen if row["kind"] == kind]
        if paths:
            frames.append(
                prepare.normalize_parcels(
                    read_shapefiles(spark, paths, kind),
                    kind,
                    F.regexp_extract("source_path", folder_pattern, 1),
                    F.regexp_extract("source_path", folder_pattern, 2),
                )
            )
    if not frames:
        raise FileNotFoundError(f"no parcel layer below {raw_root}")
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def prepare_deliveries(
    spark: SparkSession,
    raw_root: str,
    communes_path: str,
    crop_groups_csv: str,
    out_root: str,
    cell_size: float | None = None,
) -> DataFrame:
    """Assign parcels to communes, aggregate and write `prepared`; returns it as stored.

    Outlines are projected and cut into tiles once for all deliveries. Deliveries found
    again replace their own folders only.
    """
    units = prepare.normalize_communes(read_shapefiles(spark, communes_path, "commune"))
    size = cell_size or spatial.suggest_cell_size(units)
    tiles = spatial.unit_tiles(units, size, path=f"{out_root}/tiles")
    assigned = spatial.join_largest(
        read_parcels(spark, raw_root), tiles, size, prepare.PARCEL_KEY, ["data_type", "CODE_GROUP", "area_m2"]
    )
    labels = prepare.crop_label_dim(read_crop_groups(spark, crop_groups_csv))
    write_prepared(communes.commune_crop(assigned, units, labels, region_dim(spark)), f"{out_root}/prepared")
    return load_prepared(spark, f"{out_root}/prepared")


def compile_table(spark: SparkSession, out_root: str, mode: str = "reference") -> DataFrame:
    """Repair border communes over all prepared deliveries and write `compiled`."""
    merged = communes.merge_border_communes(load_prepared(spark, f"{out_root}/prepared"), mode)
    write_compiled(merged, f"{out_root}/compiled")
    return spark.read.parquet(f"{out_root}/compiled")
