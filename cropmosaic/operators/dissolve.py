"""Outlines that are made, not delivered: polygons united per group, and repaired ones written as rings."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropmosaic.functions import geometry as G
from cropmosaic.functions import outlines as O
from cropmosaic.operators.spatial import CELL, cell_edges
from cropmosaic.session import stored

#: Edges of one group in one cell that a task unites at once; fuller cells are cut into four, this often at most.
MOST_EDGES, DEEPEST = 1024, 12
#: Edges that a task unites side by side, of whole cells.
EDGES_AT_ONCE = 1 << 16
_PIECE = ["x1", "y1", "x2", "y2", "s"]


def _in_cells(features: DataFrame, keys: list[str], size: float, rings: str) -> DataFrame:
    """keys, lv, cx, cy, x1 ... s: the edges of all features of a group in a cell, those that cancel left out.

    Cells of level lv have the side size / 2^lv. A cell holding more than MOST_EDGES is cut
    into four, and those again: one crowded place costs more cells, not a larger task.
    """
    features = features.select(*keys, F.col(rings).alias("_rings"), O.meets_itself(rings).alias("_meets"))
    edges = features.select(*keys, F.expr(G.bbox("_rings")).alias("box"), F.explode(F.expr(G.valid_edges("_rings", "_meets"))).alias("e"))
    edges = edges.select(*keys, "box.ymin", "box.ymax", "e")
    done = None
    for level in range(DEEPEST + 1):
        width = size / 2**level
        found = stored(cell_edges(edges, keys, width).withColumn("lv", F.lit(level)))
        counts = found.groupBy(*keys, *CELL).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > MOST_EDGES)
        full = stored(counts.select(*[F.col(c).alias(f"_{c}") for c in [*keys, *CELL]]))
        match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*keys, *CELL]]
        if level == DEEPEST or not full.count():
            return found if done is None else done.unionByName(found)
        calm = found.join(full, match, "left_anti")
        done = calm if done is None else done.unionByName(calm)
        crowded = found.join(full, match, "left_semi")
        side = F.lit(width)
        # heights inside the cell: both halves, none of the cells above and below
        edges = crowded.select(
            *keys,
            ((F.col("cy") + F.lit(0.25)) * side).alias("ymin"),
            ((F.col("cy") + F.lit(0.75)) * side).alias("ymax"),
            F.struct(*_PIECE).alias("e"),
        )


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last column, the signed edges of each row, replaced by those of their union; many rows at a time."""
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        at, flat = lists.offsets.to_numpy().astype(np.int64), lists.values
        pieces = [flat.field(c).to_numpy(zero_copy_only=False) for c in _PIECE]
        lo = 0
        while lo < batch.num_rows:
            hi = max(int(np.searchsorted(at, at[lo] + EDGES_AT_ONCE, side="right")) - 1, lo + 1)
            of = np.repeat(np.arange(hi - lo), np.diff(at[lo : hi + 1]))
            of, *found = O.union_of_groups(of, *[p[at[lo] : at[hi]] for p in pieces])
            columns = [pa.array(c, pa.int32() if n == "s" else pa.float64()) for n, c in zip(_PIECE, found)]
            ends = pa.array(np.searchsorted(of, np.arange(hi - lo + 1)), pa.int32())
            united = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(columns, _PIECE))
            others = [c.slice(lo, hi - lo) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*others, united], names=batch.schema.names)
            lo = hi


def dissolve(features: DataFrame, keys: list[str], size: float, rings: str = "rings") -> DataFrame:
    """keys, lv, cx, cy, edges, area_m2: what the features of a group cover, each place counted once, cell by cell.

    Features are read by the even-odd rule where they cross themselves; overlaps of features,
    repeated features and shared borders vanish. Cells partition the plane, so the area of a
    group is the sum over its cells. A group of any size is spread over its cells. NULL is an
    ordinary key; features without a shape add nothing, so a group of such has no row.
    """
    cells = _in_cells(features, keys, size, rings)
    names = [*keys, "lv", *CELL]
    lists = cells.groupBy(*names).agg(F.collect_list(F.struct(*_PIECE)).alias("edges"))
    schema = T.StructType([cells.schema[c] for c in names] + [T.StructField("edges", T.DataType.fromDDL(f"array<{G.EDGE_TYPE}>"))])
    united = lists.mapInArrow(_united, schema)
    base = f"(cy * {G.number(size)} / power(2, lv))"
    return united.filter(F.size("edges") > 0).withColumn("area_m2", F.expr(G.edges_area("edges", base)))


def dissolve_joined(pairs: DataFrame, features: DataFrame, on: list[str], keys: list[str], size: float, rings: str = "rings") -> DataFrame:
    """dissolve() of joined rows that carry no outlines: those of `features` are fetched by `on` and united per `keys`.

    This is what a summary per unit and crop does to the geometry of a spatial join: a feature
    that touches two units counts, whole, in both. Pairs without a feature add nothing.
    """
    shapes = features.select(*on, rings)
    return dissolve(pairs.select(*dict.fromkeys([*on, *keys])).distinct().join(shapes, on), keys, size, rings)


def dissolved_area(dissolved: DataFrame, keys: list[str]) -> DataFrame:
    """keys, area_m2 of the result of dissolve()."""
    return dissolved.groupBy(*keys).agg(F.sum("area_m2").alias("area_m2"))


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last column, signed edges, replaced by the rings they bound."""
    point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        at, flat = lists.offsets.to_numpy(), lists.values
        parts = [flat.field(c).to_numpy(zero_copy_only=False) for c in _PIECE]
        rings = [
            None if missing else [[{"x": x, "y": y} for x, y in ring] for ring in O.walk(*[p[at[i] : at[i + 1]] for p in parts])]
            for i, missing in enumerate(lists.is_null().to_pylist())
        ]
        column = pa.array(rings, pa.list_(pa.list_(point)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=[*batch.schema.names[:-1], "rings"])


def _with_rings(df: DataFrame, edges: str) -> DataFrame:
    """df with the column of signed edges replaced by `rings`."""
    others = [c for c in df.columns if c != edges]
    kind = T.DataType.fromDDL(G.RINGS_TYPE)
    return df.select(*others, edges).mapInArrow(_walked, T.StructType([df.schema[c] for c in others] + [T.StructField("rings", kind)]))


def outlines(dissolved: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rings: the result of dissolve() as one outline per group, cell borders gone, shells and holes turned.

    The outline of a group is one row, as in any table of polygons, and must fit into a task's
    memory; where it does not, keep the cells.
    """
    whole = dissolved.groupBy(*keys).agg(F.flatten(F.collect_list("edges")).alias("_edges"))
    return _with_rings(whole, "_edges")


def repair_outlines(df: DataFrame, rings: str = "rings") -> DataFrame:
    """The same rows with `rings` as valid outlines: cut where they cross, walked back to shells and holes.

    Shells run counter-clockwise and are closed; a figure of eight becomes its lobes, a doubled
    boundary vanishes, a ring inside another is a hole. Row by row; an outline without area
    becomes [], NULL stays NULL. Column order is kept but for `rings`, which comes last.
    """
    tested = df.withColumn("_meets", O.meets_itself(rings))
    edges = tested.withColumn("_edges", F.when(F.col(rings).isNotNull(), F.expr(G.valid_edges(rings, "_meets")))).drop(rings, "_meets")
    out = _with_rings(edges, "_edges")
    return out if rings == "rings" else out.withColumnRenamed("rings", rings)
