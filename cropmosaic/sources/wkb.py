"""Polygons from WKB, as other tools store them in tables."""

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cropmosaic.functions import geometry as G

# Geometry types of the format.
POLYGON, MULTI_POLYGON = 3, 6


def _rings(data: bytes) -> list[np.ndarray]:
    """All rings of a polygon or multi-polygon, each as rows of x, y; any byte order, z and m left out."""
    rings: list[np.ndarray] = []

    def read(at: int) -> int:
        order = "<" if data[at] else ">"
        kind, n = struct.unpack_from(f"{order}2I", data, at + 1)
        at += 9
        plain = kind % 1000 if kind < 1 << 16 else kind & 0xFF
        extra = {0: 0, 1: 1, 2: 1, 3: 2}[kind // 1000] if kind < 1 << 16 else bool(kind & 1 << 31) + bool(kind & 1 << 30)
        if plain == MULTI_POLYGON:
            for _ in range(n):
                at = read(at)
            return at
        if plain != POLYGON:
            raise ValueError(f"geometry type {plain} is no polygon")
        width = 2 + extra
        for _ in range(n):
            points = struct.unpack_from(f"{order}I", data, at)[0]
            rings.append(np.frombuffer(data, f"{order}f8", points * width, at + 4).reshape(points, width)[:, :2])
            at += 4 + 8 * width * points
        return at

    read(0)
    return rings


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last column, WKB, replaced by rings built from offsets."""
    for batch in batches:
        cells = batch.column(batch.num_columns - 1).to_pylist()
        features = [None if c is None else _rings(c) for c in cells]
        flat = [r for f in features if f for r in f]
        xy = np.concatenate(flat).astype(np.float64) if flat else np.empty((0, 2))
        points = pa.StructArray.from_arrays([pa.array(xy[:, 0].copy()), pa.array(xy[:, 1].copy())], ["x", "y"])
        ends = np.concatenate([[0], np.cumsum([len(r) for r in flat])]).astype(np.int32)
        each = np.concatenate([[0], np.cumsum([len(f or []) for f in features])]).astype(np.int32)
        missing = np.array([f is None for f in features] + [False], bool)
        rings = pa.ListArray.from_arrays(pa.array(each, pa.int32(), mask=missing), pa.ListArray.from_arrays(pa.array(ends), points))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], rings], names=[*batch.schema.names[:-1], "rings"])


def with_rings(df: DataFrame, wkb: str = "wkb") -> DataFrame:
    """df with the WKB column replaced by `rings`, last. NULL stays NULL; other geometry than polygons is an error."""
    others = [c for c in df.columns if c != wkb]
    kind = T.DataType.fromDDL(G.RINGS_TYPE)
    return df.select(*others, wkb).mapInArrow(_decoded, T.StructType([df.schema[c] for c in others] + [T.StructField("rings", kind)]))
