"""Prepared and compiled tables, and geometry in exchange formats."""

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropmosaic.functions import geometry as G
from cropmosaic.sources.shapefile import register


def write_prepared(prepared: DataFrame, root: str) -> None:
    """One folder per year and region; only the deliveries present in the frame are replaced.

    The rebalance hint lets Spark split a large delivery over several files and put small
    ones together.
    """
    (
        prepared.hint("rebalance", "year", "region_code")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "region_code")
        .parquet(root)
    )


def write_compiled(compiled: DataFrame, path: str) -> None:
    """The compiled table, with or without geometry, as Parquet."""
    compiled.write.mode("overwrite").parquet(path)


def _pack_wkb(parts: pa.ListArray) -> Iterator[bytes | None]:
    """Little-endian WKB MultiPolygons of features given as polygons of rings, cut from the Arrow buffers."""
    polygons = parts.values
    rings = polygons.values
    points = rings.values
    xy = np.column_stack([points.field(c).to_numpy(zero_copy_only=False) for c in "xy"]).astype("<f8").tobytes()
    feature_at, polygon_at, ring_at = (a.offsets.to_numpy() for a in (parts, polygons, rings))
    for i, missing in enumerate(parts.is_null().to_pylist()):
        if missing:
            yield None
            continue
        out = [struct.pack("<BII", 1, 6, feature_at[i + 1] - feature_at[i])]
        for p in range(feature_at[i], feature_at[i + 1]):
            out.append(struct.pack("<BII", 1, 3, polygon_at[p + 1] - polygon_at[p]))
            for r in range(polygon_at[p], polygon_at[p + 1]):
                out.append(struct.pack("<I", ring_at[r + 1] - ring_at[r]))
                out.append(xy[16 * ring_at[r] : 16 * ring_at[r + 1]])
        yield b"".join(out)


def _replace_by_wkb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last column packed as WKB, all others passed through."""
    for batch in batches:
        packed = pa.array(_pack_wkb(batch.column(batch.num_columns - 1)), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], packed], names=[*batch.schema.names[:-1], "wkb"]
        )


def with_wkb(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Rings replaced by a WKB column, cleaned and grouped into polygons on the way."""
    others = [c for c in df.columns if c != rings]
    parts = df.select(*others, F.expr(G.clean_rings(rings)).alias("_clean")).select(
        *others, F.expr(G.polygon_parts("_clean")).alias("_parts")
    )
    schema = T.StructType([parts.schema[c] for c in others] + [T.StructField("wkb", T.BinaryType())])
    return parts.mapInArrow(_replace_by_wkb, schema)


def geojson_lines(df: DataFrame, rings: str = "rings") -> DataFrame:
    """One GeoJSON feature per row in column `value`; all other columns become properties."""
    properties = F.struct(*[c for c in df.columns if c != rings])
    clean = df.withColumn("_properties", properties).withColumn("_clean", F.expr(G.clean_rings(rings)))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.expr(G.geojson_geometry("_clean")).alias("geometry"),
        F.col("_properties").alias("properties"),
    )
    return clean.select(F.to_json(feature).alias("value"))


def write_features(df: DataFrame, path: str, format: str = "shapefile", clean: bool = True, **options: str) -> None:
    """Features with geometry, replacing what is there: 'shapefile', 'geojson' (lines) or 'wkb' (Parquet).

    Rings are closed and turned on the way, each compared with the others of its feature. For
    shapefiles clean=False leaves that out, for outlines that are valid already, such as united
    or repaired ones: their rings may be very many.
    """
    if not clean and format != "shapefile":
        raise ValueError("clean=False is for shapefiles")
    if format == "shapefile":
        register(df.sparkSession)
        rings = G.clean_rings("rings") if clean else "rings"
        clockwise = df.withColumn("rings", F.expr(f"transform({rings}, r -> reverse(r))"))
        clockwise.write.format("shapefile").mode("overwrite").options(**options).save(path)
    elif format == "geojson":
        geojson_lines(df).write.mode("overwrite").options(**options).text(path)
    elif format == "wkb":
        with_wkb(df).write.mode("overwrite").options(**options).parquet(path)
    else:
        raise ValueError(f"unknown format {format!r}")
