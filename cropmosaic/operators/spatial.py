"""Spatial joins of polygons with administrative units.

Space is cut into square cells. Units are clipped to the cells once (`unit_tiles`), parcels
only learn which cells their bounding box meets, and both sides join on the cell with an
ordinary equi-join. Cells partition the plane, so the overlap of a parcel with a unit is the
sum over the cells and no pair has to be removed twice. A cell lying wholly inside one unit
needs no geometry at all for the parcels inside it.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from cropmosaic.functions import geometry as G
from cropmosaic.functions import outlines as O
from cropmosaic.functions.tiles import Tiles
from cropmosaic.operators.skew import BROADCAST_BYTES, fits_broadcast, keyed_join, salted_join, sized_join
from cropmosaic.session import stored

CELL = ["cx", "cy"]


#: A feature is dealt to cells of a size that its box decides: the smallest of size, 2 size, 4 size, ... at which
#: its longer side spans at most so many of them. Candidates only need few rows; tiles should also be small.
PAIR_SPAN, TILE_SPAN = 1, 8


def cell_level(box: str, size: float, span: int) -> Column:
    """The level l of a feature: cells of side size * 2^l, at most span + 1 of them across its box."""
    b = F.col(box)
    side = F.greatest(b["xmax"] - b["xmin"], b["ymax"] - b["ymin"])
    return F.when(b.isNotNull(), F.greatest(F.coalesce(F.ceil(F.log2(side / F.lit(size * span))), F.lit(0)), F.lit(0)).cast("int"))


def grid_cells(df: DataFrame, size: float | Column, box: str = "box", keep_empty: bool = False, extent: tuple | None = None) -> DataFrame:
    """One row per cell (cx, cy) met by the bounding box; rows without one go, or stay cell-less.

    `extent` (first and last cx, first and last cy) leaves out cells beyond it.
    """
    explode = F.explode_outer if keep_empty else F.explode
    (xa, xb), (ya, yb) = (tuple(F.floor(F.col(box)[c] / size) for c in pair) for pair in (("xmin", "xmax"), ("ymin", "ymax")))
    if extent is None:
        return df.withColumn("cx", explode(F.sequence(xa, xb))).withColumn("cy", explode(F.sequence(ya, yb)))
    x0, x1, y0, y1 = map(F.lit, extent)
    met = (xa <= x1) & (xb >= x0) & (ya <= y1) & (yb >= y0)
    xs = F.when(met, F.sequence(F.greatest(xa, x0), F.least(xb, x1)))
    ys = F.when(met, F.sequence(F.greatest(ya, y0), F.least(yb, y1)))
    return df.withColumn("cx", explode(xs)).withColumn("cy", explode(ys))


def suggest_cell_size(units: DataFrame, rings: str = "rings") -> float:
    """Half the median longer side of the units' boxes: most units then span a few cells."""
    box = F.expr(G.bbox(rings))
    side = F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"])
    return units.agg((F.percentile_approx(side, 0.5) / 2).alias("s")).first()["s"]


def _levels(df: DataFrame, level: Column) -> list[int]:
    """The levels that occur: at most some hundred, as a level is the logarithm of a length."""
    return sorted(r[0] for r in df.select(level.alias("l")).filter("l IS NOT NULL").distinct().collect())


def _cells_of_levels(df: DataFrame, box: str, size: float, keys: Column) -> DataFrame:
    """df, one row per entry (lv, k) of the array `keys` and cell of side size * 2^lv that the box meets."""
    dealt = df.withColumn("_key", F.explode(keys)).withColumn("_side", F.lit(size) * F.pow(F.lit(2.0), F.col("_key.lv")))
    return grid_cells(dealt.select("*", "_key.lv", "_key.k").drop("_key"), F.col("_side"), box)


def candidate_pairs(
    left: DataFrame,
    right: DataFrame,
    size: float,
    left_key: str,
    right_key: str,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Pairs of keys whose bounding boxes meet (contact counts), each exactly once.

    Both frames have rings. Boxes of any size may be mixed: each lies in at most four cells of
    the level its size asks for (`size` is the smallest cell), and in four of each coarser level
    that the other frame uses, so the rows per feature do not depend on its extent. Two features
    meet at the coarser of their levels. A pair sharing several cells is kept only in the cell
    that holds the lower left corner of the boxes' intersection, so no distinct is needed.
    """
    a, b = (
        stored(df.select(F.col(key), F.expr(G.bbox("rings")).alias(box)).withColumn(f"{box}_lv", cell_level(box, size, PAIR_SPAN)))
        for df, key, box in ((left, left_key, "abox"), (right, right_key, "bbox"))
    )
    a_levels, b_levels = _levels(a, F.col("abox_lv")), _levels(b, F.col("bbox_lv"))
    if not a_levels or not b_levels:
        return a.select(left_key, F.lit(None).cast(b.schema[right_key].dataType).alias(right_key)).limit(0)

    def entries(levels: list[int], condition, k: int) -> Column:
        all_ = F.array(*[F.struct(F.lit(n).alias("lv"), F.lit(k).alias("k")) for n in levels])
        return F.filter(all_, lambda e: condition(e["lv"]))

    # k = 0: the left feature at its own level, the right one at most as coarse; k = 1: the right one at its own, the left finer
    a_keys = F.concat(entries(a_levels, lambda n: n == F.col("abox_lv"), 0), entries(b_levels, lambda n: n > F.col("abox_lv"), 1))
    b_keys = F.concat(entries(a_levels, lambda n: n >= F.col("bbox_lv"), 0), entries(b_levels, lambda n: n == F.col("bbox_lv"), 1))
    a = _cells_of_levels(a, "abox", size, a_keys).drop("abox_lv")
    b = _cells_of_levels(b, "bbox", size, b_keys).drop("bbox_lv", "_side")
    joined = sized_join(a, b, ["lv", "k", *CELL], [left_key], "inner", 112, limit)
    x = F.greatest("abox.xmin", "bbox.xmin")
    y = F.greatest("abox.ymin", "bbox.ymin")
    return joined.filter(
        (x <= F.least("abox.xmax", "bbox.xmax"))
        & (y <= F.least("abox.ymax", "bbox.ymax"))
        & (F.floor(x / F.col("_side")) == F.col("cx"))
        & (F.floor(y / F.col("_side")) == F.col("cy"))
    ).select(left_key, right_key)


def _clamped_pieces(size: float, of: str = "") -> str:
    """One edge piece of a strip in cell (cx, cy): up to three pieces, flat where it leaves the cell.

    Takes px1, py1, px2, py2, s, columns or the fields of a struct named by `of`. With la, lb the share of the piece at which it
    meets the lower and the upper side of the cell, the part between both stays as it is and
    the parts before and after lie on the side they have crossed.
    """
    low, high = f"(cy * {G.number(size)})", f"((cy + 1) * {G.number(size)})"

    px1, py1, px2, py2, s = (f"{of}.{c}" if of else c for c in ("px1", "py1", "px2", "py2", "s"))

    def share(level: str) -> str:
        return (
            f"CASE WHEN {py1} = {py2} THEN CASE WHEN {py1} < {level} THEN 1D ELSE 0D END "
            f"ELSE ({level} - {py1}) / ({py2} - {py1}) END"
        )

    # a horizontal piece below the cell counts as rising out of reach, one above as past it
    def x_at(t: str) -> str:
        return f"CASE WHEN {t} <= 0 THEN {px1} WHEN {t} >= 1 THEN {px2} ELSE {px1} + {t} * ({px2} - {px1}) END"

    def y_at(x: str, side: str) -> str:
        end = f"CASE WHEN {x} = {px1} THEN {py1} WHEN {x} = {px2} THEN {py2} ELSE {side} END"
        return f"greatest(least({end}, {high}), {low})"

    first_side = f"(CASE WHEN {py2} >= {py1} THEN {low} ELSE {high} END)"
    last_side = f"(CASE WHEN {py2} >= {py1} THEN {high} ELSE {low} END)"
    pieces = (
        f"array(struct({px1} AS x1, {first_side} AS y1, c.a AS x2, {first_side} AS y2, {s} AS s), "
        f"struct(c.a AS x1, {y_at('c.a', first_side)} AS y1, c.b AS x2, {y_at('c.b', last_side)} AS y2, {s} AS s), "
        f"struct(c.b AS x1, {last_side} AS y1, {px2} AS x2, {last_side} AS y2, {s} AS s))"
    )
    cuts = G.bind(
        "t",
        f"struct({share(low)} AS low, {share(high)} AS high)",
        f"CASE WHEN {py2} >= {py1} "
        f"THEN struct({x_at('t.low')} AS a, {x_at('t.high')} AS b) "
        f"ELSE struct({x_at('t.high')} AS a, {x_at('t.low')} AS b) END",
    )
    return f"filter({G.bind('c', cuts, pieces)}, p -> p.x1 < p.x2)"


def _merged_flats(pieces: str, level: str) -> str:
    """The flat pieces on one side of a cell as few pieces: steps at the same x add up, and mostly vanish.

    Along a chain of edges that stays beyond the side every inner corner is one step up and one
    down, so only the places where the chain enters and leaves remain, however long it is.
    """
    steps = (
        f"array_sort(flatten(transform(filter({pieces}, fp -> fp.y1 = {level} AND fp.y2 = {level}), "
        "fp -> array(struct(fp.x1 AS x, fp.s AS s), struct(fp.x2 AS x, -fp.s AS s)))))"
    )
    done = "CASE WHEN fa.s != 0 THEN concat(fa.steps, array(struct(fa.x AS x, fa.s AS s))) ELSE fa.steps END"
    nothing = "CAST(NULL AS DOUBLE) AS x, 0 AS s, CAST(array() AS array<struct<x:double,s:int>>) AS steps"
    sums = (
        f"aggregate({steps}, struct({nothing}), (fa, fs) -> CASE WHEN fs.x = fa.x "
        "THEN struct(fa.x AS x, fa.s + fs.s AS s, fa.steps AS steps) "
        f"ELSE struct(fs.x AS x, fs.s AS s, {done} AS steps) END, fa -> {done})"
    )
    between = (
        f"filter(transform(slice(fm, 1, greatest(size(fm) - 1, 0)), (fb, fi) -> struct(fb.x AS x1, {level} AS y1, "
        f"get(fm, fi + 1).x AS x2, {level} AS y2, aggregate(slice(fm, 1, fi + 1), 0, (ft, fv) -> ft + fv.s) AS s)), "
        "fp -> fp.s != 0)"
    )
    return G.bind("fm", sums, between)


def clip_to_cell(edges: str, size: float) -> str:
    """Signed edges of the part of a polygon inside cell (cx, cy), as SQL text; [] if there is none.

    A boundary piece above or below the cell is flattened onto the cell side, as in the tiles,
    so the result is closed and overlaps with anything inside the cell are those of the polygon.
    """
    width = G.number(size)
    left, right = f"(cx * {width})", f"((cx + 1) * {width})"
    low, high = f"(cy * {width})", f"((cy + 1) * {width})"

    def y_at(x: str) -> str:
        return (
            f"CASE WHEN {x} = ke.x1 THEN ke.y1 WHEN {x} = ke.x2 THEN ke.y2 "
            f"ELSE ke.y1 + ({x} - ke.x1) / (ke.x2 - ke.x1) * (ke.y2 - ke.y1) END"
        )

    from_x, to_x = f"greatest(ke.x1, {left})", f"least(ke.x2, {right})"
    piece = f"struct({from_x} AS px1, {y_at(from_x)} AS py1, {to_x} AS px2, {y_at(to_x)} AS py2, ke.s AS s)"
    strip = (
        f"flatten(transform(filter({edges}, ke -> ke.x1 < {right} AND ke.x2 > {left}), "
        f"ke -> {G.bind('kq', piece, _clamped_pieces(size, 'kq'))}))"
    )
    drawn = f"filter(kp, kf -> kf.y1 != kf.y2 OR (kf.y1 != {low} AND kf.y1 != {high}))"
    return G.bind("kp", strip, f"concat({drawn}, {_merged_flats('kp', low)}, {_merged_flats('kp', high)})")


def segments_near_cell(segs: str, size: float) -> str:
    """Boundary segments that reach into cell (cx, cy), with the slack that tiles allow too."""
    width, slack = G.number(size), G.number(size * 1e-9)
    return (
        f"filter({segs}, kg -> kg.x1 - {slack} <= (cx + 1) * {width} AND kg.x2 + {slack} >= cx * {width} "
        f"AND least(kg.y1, kg.y2) - {slack} <= (cy + 1) * {width} AND greatest(kg.y1, kg.y2) + {slack} >= cy * {width})"
    )




def unit_tiles(
    units: DataFrame,
    size: float,
    unit: str = "geo_unit",
    contact: bool = False,
    repair: bool = False,
    path: str | None = None,
) -> DataFrame:
    """Units clipped to the grid: unit, lv, cx, cy, tile (signed edges), its box tx1 ... ty2, full, segs.

    Cells of level lv have the side size * 2^lv. Units that span more than TILE_SPAN cells are
    clipped at a coarser level of their own, so a table may mix units of any size.

    A piece of the boundary counts in every cell of its strip: above or below the cell it
    is flattened onto the cell side. Flat pieces of one height are stored as steps at their
    start, steps at the same x add up and mostly vanish, so a cell inside the unit is left
    with two edges and one outside with none. With `contact`, `segs` are the boundary
    segments reaching into the cell as drawn, as contact tests need them. Outlines are read
    as drawn, shells against holes, in time linear in their corners; `repair` reads them by
    the even-odd rule first, for outlines that cross themselves.

    The tiles are written once, to `path` or to the shared working folder, and serve any
    number of joins; give a path to keep them.
    """
    units = units.filter(F.size("rings") > 0).select(unit, "rings", F.expr(G.bbox("rings")).alias("_box"))
    levels = _levels(units, cell_level("_box", size, TILE_SPAN)) or [0]
    if len(levels) > 1:
        units = stored(units)  # read once for each level
    tiles = None
    for level in levels:
        own = units.filter(cell_level("_box", size, TILE_SPAN) == level) if len(levels) > 1 else units
        made = _build_tiles(own.select(unit, "rings"), size * 2.0**level, unit, contact, repair).withColumn("lv", F.lit(level))
        tiles = made if tiles is None else tiles.unionByName(made)
    return stored(tiles, path)


def _y_on_edge(x: str) -> str:
    return (
        f"CASE WHEN {x} = e.x1 THEN e.y1 WHEN {x} = e.x2 THEN e.y2 "
        f"ELSE e.y1 + ({x} - e.x1) / (e.x2 - e.x1) * (e.y2 - e.y1) END"
    )


def cell_edges(edges: DataFrame, keys: list[str], size: float, tasks: int | None = None) -> DataFrame:
    """Signed edges dealt to the cells: (keys, ymin, ymax, e) -> keys, cx, cy, x1, y1, x2, y2, s.

    ymin and ymax say how high the polygon of an edge reaches: an edge counts in every cell of
    its strip between them. All edges of the same keys in a cell are added up, equal ones with
    their signs; flat ones on a cell side become steps, at x1 and for the rest of the cell. With
    `tasks` strips are dealt out to so many tasks, and the sum finds its rows in place.
    """
    width = G.number(size)
    low, high, right = f"(cy * {width})", f"((cy + 1) * {width})", f"((cx + 1) * {width})"
    from_x, to_x = f"greatest(e.x1, cx * {width})", f"least(e.x2, {right})"
    strips = edges.select("*", F.expr(f"explode(sequence(floor(e.x1 / {width}), floor(e.x2 / {width})))").alias("cx"))
    if tasks:
        strips = strips.repartition(tasks, *keys, "cx")
    pieces = strips.select(
        *keys,
        "cx",
        F.expr(f"explode(sequence(floor(ymin / {width}), floor(ymax / {width})))").alias("cy"),
        F.expr(from_x).alias("px1"),
        F.expr(_y_on_edge(from_x)).alias("py1"),
        F.expr(to_x).alias("px2"),
        F.expr(_y_on_edge(to_x)).alias("py2"),
        "e.s",
    ).select(*keys, *CELL, F.explode(F.expr(f"CASE WHEN px1 < px2 THEN {_clamped_pieces(size)} END")).alias("p"))
    step = "CAST(NULL AS DOUBLE) AS x2, CAST(NULL AS DOUBLE) AS y2"
    marks = (
        f"CASE WHEN p.y1 = p.y2 AND (p.y1 = {low} OR p.y1 = {high}) "
        f"THEN array(struct(p.x1 AS x1, p.y1 AS y1, {step}, p.s AS s), struct(p.x2 AS x1, p.y1 AS y1, {step}, -p.s AS s)) "
        "ELSE array(p) END"
    )
    return (
        pieces.select(*keys, *CELL, F.inline(F.expr(marks)))
        .filter(F.expr(f"x1 < {right}"))
        .groupBy(*keys, *CELL, "x1", "y1", "x2", "y2")
        .agg(F.sum("s").cast("int").alias("s"))
        .filter("s != 0")
        .select(*keys, *CELL, "x1", "y1", F.expr(f"coalesce(x2, {right})").alias("x2"), F.expr("coalesce(y2, y1)").alias("y2"), "s")
    )


def _build_tiles(units: DataFrame, size: float, unit: str, contact: bool, repair: bool) -> DataFrame:
    width = G.number(size)
    low, high, right = f"(cy * {width})", f"((cy + 1) * {width})", f"((cx + 1) * {width})"
    base = units.select(unit, "rings")
    edges_of = G.valid_edges if repair else G.oriented_edges
    drawn = base.select(unit, F.expr(G.bbox("rings")).alias("box"), F.explode(F.expr(edges_of("rings"))).alias("e"))
    # One row per edge and strip of cells it runs through, then per cell of that strip. Strips
    # are dealt out in between: a long outline is worked on by many tasks, and both groupings
    # below find their rows in place. The number of tasks is named because the rows are still
    # few here, and Spark would merge them into fewer tasks than the work ahead deserves.
    tasks = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = cell_edges(drawn.select(unit, "box.ymin", "box.ymax", "e"), [unit], size, tasks).select(
        unit, *CELL, F.struct("x1", "y1", "x2", "y2", "s").alias("edge"), F.lit(None).cast(G.SEG_TYPE).alias("seg")
    )
    if contact:
        # a hair of slack: the cell of a contact point may be computed from either side
        slack = G.number(size * 1e-9)
        box = (
            f"struct(seg.x1 - {slack} AS xmin, least(seg.y1, seg.y2) - {slack} AS ymin, "
            f"seg.x2 + {slack} AS xmax, greatest(seg.y1, seg.y2) + {slack} AS ymax)"
        )
        segs = base.select(unit, F.explode(F.expr(G.contact_segments("rings"))).alias("seg"))
        edges = edges.unionByName(
            grid_cells(segs.withColumn("box", F.expr(box)), size).select(
                unit, *CELL, F.lit(None).cast(G.EDGE_TYPE).alias("edge"), "seg"
            )
        )
    whole = (
        f"size(tile) = 2 AND forall(tile, e -> e.x1 = cx * {width} AND e.x2 = {right} AND e.y1 = e.y2 "
        f"AND ((e.y1 = {high} AND e.s = 1) OR (e.y1 = {low} AND e.s = -1)))"
    )
    return (
        edges.groupBy(unit, *CELL)
        .agg(
            F.collect_list("edge").alias("tile"),
            F.collect_list("seg").alias("segs"),
            F.min("edge.x1").alias("tx1"),
            F.max("edge.x2").alias("tx2"),
            F.min(F.least("edge.y1", "edge.y2")).alias("ty1"),
            F.max(F.greatest("edge.y1", "edge.y2")).alias("ty2"),
        )
        .withColumn("full", F.expr(whole))
    )


def _tile_bytes() -> Column:
    return 96 + F.size("tile") * 40 + F.size("segs") * 32


def _box_in_cell(box: str) -> Column:
    b, side = F.col(box), F.col("_side")
    return (
        (b["xmin"] >= F.col("cx") * side)
        & (b["xmax"] <= (F.col("cx") + 1) * side)
        & (b["ymin"] >= F.col("cy") * side)
        & (b["ymax"] <= (F.col("cy") + 1) * side)
    )


def _row_id(parcels: DataFrame) -> Column:
    """Tells rows apart that are equal in all columns carried along, so that each stays a row of its own.

    Where the frame names its features that is their file and record; else rows are numbered
    (a frame read from files or a table is numbered alike when a lost task is run again).
    """
    if "feature" in parcels.columns:
        number = F.coalesce("feature", F.monotonically_increasing_id().cast("string"))
    else:
        number = F.monotonically_increasing_id()
    return number.alias("_row")


#: Lists of edges this short are not cut at cell borders.
FEW_EDGES = 8


def _shaped(parcels: DataFrame, columns: list[str], contact: bool) -> DataFrame:
    """columns, _row, box, _drawn (area of the whole outline), _edges (signed), with `contact` also _segs; computed once per parcel."""
    parcels = parcels.select("*", _row_id(parcels), O.outline_parts("rings").alias("_plain"))
    box = F.coalesce("_plain.box", F.expr(G.bbox("rings")))
    edges = F.coalesce("_plain.edges", F.expr(G.valid_edges("rings", "_plain.meets")))
    shape = [edges.alias("_edges"), F.expr(G.polygon_area("rings")).alias("_drawn")]
    if contact:
        shape.append(F.expr(G.contact_segments("rings")).alias("_segs"))
    return parcels.select(*columns, "_row", box.alias("box"), *shape)


def parcel_cells(shaped: DataFrame, size: float, contact: bool = False, extent: tuple | None = None) -> DataFrame:
    """One row for each cell of side `size` that the box meets, with only what lies in that cell.

    _edges become those of the part in the cell (see clip_to_cell), _segs the segments near it;
    lists of at most FEW_EDGES stay, as their part in a cell would be no shorter. _inside tells
    whether all of _edges lies in the cell. Parcels that meet no cell, of the extent if one is
    given, stay as one row without a cell.
    """
    cells = grid_cells(shaped, size, keep_empty=True, extent=extent).withColumn("_side", F.lit(size))
    whole = F.col("cx").isNull() | _box_in_cell("box")
    few = F.size("_edges") <= FEW_EDGES
    cells = cells.withColumn("_inside", whole | ~few).withColumn(
        "_edges", F.when(whole | few, F.col("_edges")).otherwise(F.expr(clip_to_cell("_edges", size)))
    )
    if contact:
        few = F.size("_segs") <= FEW_EDGES
        cells = cells.withColumn("_segs", F.when(whole | few, F.col("_segs")).otherwise(F.expr(segments_near_cell("_segs", size))))
    return cells


def _cells_of_all_levels(shaped: DataFrame, tiles: DataFrame, size: float, levels: list[int], contact: bool) -> tuple[DataFrame, DataFrame]:
    """Parcels and tiles of several levels, keyed by (lv, k, cx, cy) so that each pair meets in cells of one level.

    A parcel lies in cells of every tile level that is not below its own (k = 0). Tiles of lower
    levels come to the parcel instead: as they are, in the cell of its level that holds theirs
    (k = 1). So a parcel has few rows at each level, however large it is.
    """
    shaped = stored(shaped.withColumn("_lv", cell_level("box", size, TILE_SPAN)))
    lowest = levels[0]
    raised = [n for n in _levels(shaped, F.col("_lv")) if n > lowest]
    parts, lifted = [], [tiles.withColumn("k", F.lit(0))]
    for level in levels:
        fits = F.col("_lv") <= level
        fits = fits | F.col("_lv").isNull() if level == lowest else fits
        parts.append(parcel_cells(shaped.filter(fits), size * 2.0**level, contact).withColumns({"lv": F.lit(level), "k": F.lit(0)}))
    for level in raised:
        own = shaped.filter(F.col("_lv") == level)
        parts.append(parcel_cells(own, size * 2.0**level, contact).withColumns({"lv": F.lit(level), "k": F.lit(1)}))
        up = {c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.lit(level) - F.col("lv"))) for c in CELL}
        lifted.append(tiles.filter(F.col("lv") < level).withColumns({**up, "full": F.lit(False), "lv": F.lit(level), "k": F.lit(1)}))
    cells, units = parts[0], lifted[0]
    for part in parts[1:]:
        cells = cells.unionByName(part)
    for part in lifted[1:]:
        units = units.unionByName(part)
    return cells.drop("_lv"), units


def _cell_join(
    parcels: DataFrame,
    tiles: DataFrame,
    size: float,
    columns: list[str],
    key: list[str],
    limit: int,
    contact: bool = False,
    condition: Column | None = None,
) -> DataFrame:
    """Parcels, one row per cell and unit tile in it; parcels meeting no tile stay.

    Tiles of at most `limit` bytes are broadcast, and the parcels stay where they were read.
    Otherwise the rows per cell are written once, so that the source is read once and rows are
    numbered for good; hot cells are counted in that table, and what then crosses the exchange
    is the part of each outline inside its cell.
    """
    ends = [f(c).alias(f"{n}_{c}") for c in CELL for n, f in (("first", F.min), ("last", F.max))]
    facts = tiles.agg(F.sum(_tile_bytes()).alias("bytes"), F.collect_set("lv").alias("levels"), *ends).first()
    levels, shaped, on = sorted(facts["levels"]), _shaped(parcels, columns, contact), CELL
    if len(levels) > 1:
        cells, tiles = _cells_of_all_levels(shaped, tiles, size, levels, contact)
        on = ["lv", "k", *CELL]
        small = fits_broadcast(tiles, _tile_bytes(), limit)
    else:
        extent = tuple(facts[f"{n}_{c}"] for c in CELL for n in ("first", "last")) if levels else None
        cells = parcel_cells(shaped, size * 2.0 ** (levels[0] if levels else 0), contact, extent)
        tiles = tiles.drop("lv")
        small = (facts["bytes"] or 0) <= limit
    if small:
        return keyed_join(cells, F.broadcast(tiles), on, "left", condition)
    return salted_join(stored(cells), tiles, on, [*key, "_row"], "left", condition=condition)


def _piece_area() -> str:
    """Overlap of the part of a parcel in a cell with a tile; a tile that fills its cell needs no intersection."""
    base = "greatest(box.ymin, cy * _side)"
    return f"CASE WHEN full AND _inside THEN {G.edges_area('_edges', base)} ELSE {G.overlap_area('_edges', 'tile')} END"


#: Rows of parcel and unit that a task aggregates after the join, so that its memory does not grow with the table.
MOVED_ROWS = 1 << 16


def _moved(rows: DataFrame, key: list[str]) -> DataFrame:
    """The joined rows at their parcels' partitions, of which there are as many as the rows ask for.

    They are written once, without geometry, and counted there.
    """
    rows = stored(rows)
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // MOVED_ROWS))
    return rows.repartition(tasks, *[F.col(k) for k in key])


def _overlaps(
    parcels: DataFrame,
    tiles: DataFrame,
    size: float,
    key: list[str],
    keep: list[str] = (),
    unit: str = "geo_unit",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """overlaps() with the row's number and the area drawn.

    The joined rows move once, to the parcel's own partition, and carry no geometry there.
    """
    columns = list(dict.fromkeys([*key, *keep]))
    boxes_overlap = (
        (F.col("box.xmin") < F.col("tx2"))
        & (F.col("tx1") < F.col("box.xmax"))
        & (F.col("box.ymin") < F.col("ty2"))
        & (F.col("ty1") < F.col("box.ymax"))
    )
    joined = _cell_join(parcels, tiles, size, columns, key, limit, condition=boxes_overlap)
    # tiles that fill their cell are not handed to the batch
    cut = F.col(unit).isNotNull() & ~(F.col("full") & F.col("_inside"))
    batch = O.overlap_of_edges(*(F.when(cut, F.col(c)) for c in ("_edges", "tile")))
    joined = joined.withColumn("_cut", batch)
    area = F.when(F.col(unit).isNotNull(), F.coalesce("_cut", F.expr(_piece_area())))
    moved = _moved(joined.select(*columns, "_row", "_drawn", unit, area.alias("_area")), key)
    return moved.groupBy(*columns, "_row", unit).agg(F.sum("_area").alias("overlap_m2"), F.max("_drawn").alias("_drawn"))


def overlaps(
    parcels: DataFrame,
    tiles: DataFrame,
    size: float,
    key: list[str],
    keep: list[str] = (),
    unit: str = "geo_unit",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """key, keep, unit, overlap_m2: one row per parcel and unit near it, or one with NULLs.

    Tiles of at most `limit` bytes are held by each task, which adds up all cells of a parcel where it was read.
    Otherwise parcels and tiles meet in a join, and its rows are added up behind an exchange.
    """
    if fits_broadcast(tiles, _tile_bytes(), limit):
        return _laid(parcels, tiles, size, key, keep, unit)
    return _overlaps(parcels, tiles, size, key, keep, unit, limit).drop("_row", "_drawn")


def _laid(parcels: DataFrame, tiles: DataFrame, size: float, key: list[str], keep: list[str], unit: str) -> DataFrame:
    """overlaps() by tasks that hold all tiles.

    A row per parcel with the units near it is written once. Only parcels that share their columns and feature,
    or have pieces left to the expression, are added up behind an exchange.
    """
    columns = list(dict.fromkeys([*key, *keep]))
    shaped = _shaped(parcels, columns, contact=False).drop("_drawn")
    held = tiles.select(unit, "lv", *CELL, "tile", "tx1", "tx2", "ty1", "ty2", "full")
    shared = tiles.sparkSession.sparkContext.broadcast(held.toArrow())
    names = [*columns, "_row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = Tiles(shared.value, unit, size, TILE_SPAN)
        for batch in batches:
            edges, box = batch.column("_edges"), batch.column("box")
            for first, last, found, left in tiles.lay(edges, box):
                kept = pa.array(np.arange(first, last), mask=left.is_null().to_numpy(zero_copy_only=False))
                shape = [c.take(kept) for c in (edges, box)]  # of parcels with pieces left
                carried = [batch.column(n).slice(first, last - first) for n in names]
                yield pa.RecordBatch.from_arrays([*carried, found, left, *shape], [*names, "_found", "_left", "_edges", "box"])

    found = StructType([StructField(unit, tiles.schema[unit].dataType), StructField("overlap_m2", DoubleType())])
    left = StructType([*(StructField(c, tiles.schema[c].dataType) for c in (unit, "tile", "full", "cy")), StructField("_side", DoubleType())])
    lists = [StructField("_found", ArrayType(found)), StructField("_left", ArrayType(left))]
    schema = StructType([*(shaped.schema[n] for n in names), *lists, *(shaped.schema[c] for c in ("_edges", "box"))])
    rows = stored(shaped.select(*names, "_edges", "box").mapInArrow(run, schema))
    shared.unpersist()
    batch = O.overlap_of_edges(*(F.when(~F.col("full"), F.col(c)) for c in ("_edges", "tile")))
    area = F.coalesce("_cut", F.expr(_piece_area()))
    same, left = F.xxhash64(*names).alias("_same"), F.col("_left").isNotNull()
    if "feature" in parcels.columns:  # else rows are numbered
        again = rows.groupBy(same).agg(F.count(F.lit(1)).alias("n"), F.max(left).alias("left")).filter("n > 1 OR left").select("_same")
    else:
        again = rows.filter(left).select(same).distinct()
    again = stored(again.withColumn("_again", F.lit(True)))
    if again.isEmpty():
        return rows.select(*columns, F.inline("_found"))
    rows = sized_join(rows.withColumn("_same", same), again, ["_same"], ["_row"], "left", 16)
    alone, many = rows.filter("_again IS NULL"), rows.filter("_again")
    pieces = many.select(*names, "_edges", "box", F.inline("_left")).withColumn("_inside", F.lit(True)).withColumn("_cut", batch)
    summed = many.select(*names, F.inline("_found")).unionByName(pieces.select(*names, unit, area.alias("overlap_m2")))
    summed = _moved(summed, key).groupBy(*names, unit).agg(F.sum("overlap_m2").alias("overlap_m2")).drop("_row")
    return alone.select(*columns, F.inline("_found")).unionByName(summed)


def _rounding() -> Column:
    """Square metres up to which an overlap is rounding error.

    Metres near 7,000,000 are exact to 1e-9, so two borders drawn as one may cross by that much
    once one of them has been projected: for a field that is below 1e-9 of its area. The bound
    grows more slowly for large parcels, so that a small unit inside one still counts.
    """
    drawn = F.col("_drawn")
    return F.least(F.lit(1e-9) * drawn, F.lit(1e-6) + F.lit(1e-11) * drawn)


def join_largest(
    parcels: DataFrame,
    tiles: DataFrame,
    size: float,
    key: list[str],
    keep: list[str] = (),
    unit: str = "geo_unit",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Each parcel with the one unit it overlaps most, NULL if it overlaps none.

    Every row of `parcels` gives one row, whatever its key; `key` says where it is moved to,
    `keep` are further columns to carry along. Any overlap above rounding error counts. Overlaps
    are compared to the square millimetre, so that rounding does not decide; of equal ones the
    smallest unit wins.
    """
    columns = list(dict.fromkeys([*key, *keep]))
    rounded = F.round("overlap_m2", 6)
    best = F.min(
        F.when(
            F.col("overlap_m2") > _rounding(),
            F.struct((-rounded).alias("o"), F.col(unit).alias("u"), F.col("overlap_m2").alias("area")),
        )
    )
    return (
        _overlaps(parcels, tiles, size, key, keep, unit, limit)
        .groupBy(*columns, "_row")
        .agg(best.alias("_best"))
        .select(*columns, F.col("_best.u").alias(unit), F.col("_best.area").alias("overlap_m2"))
    )


def join_intersects(
    parcels: DataFrame,
    tiles: DataFrame,
    size: float,
    key: list[str],
    keep: list[str] = (),
    unit: str = "geo_unit",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join: one row per parcel and unit sharing at least a point; NULL unit if there is none.

    Contact of the boundaries counts. Containment shows as a positive overlap in some cell.
    """
    columns = list(dict.fromkeys([*key, *keep]))
    joined = _cell_join(parcels, tiles, size, columns, key, limit, contact=True)
    hit = (
        F.when(F.col(unit).isNull(), F.lit(False))
        .when(F.col("full") & _box_in_cell("box"), F.lit(True))
        .when(F.expr(G.segments_touch("_segs", "segs")), F.lit(True))
        .otherwise(F.expr(_piece_area()) > _rounding())
    )
    moved = _moved(joined.select(*columns, "_row", F.when(hit, F.col(unit)).alias(unit)), key)
    # collect_set holds the distinct units touched by one parcel, at most the units near it
    return (
        moved.groupBy(*columns, "_row")
        .agg(F.collect_set(unit).alias("_units"))
        .select(*columns, F.explode_outer("_units").alias(unit))
    )


def units_with_parcels(pairs: DataFrame, units: DataFrame, unit: str = "geo_unit") -> DataFrame:
    """The same pairs seen from the units: units without a parcel stay, parcels without a unit go.

    Matched pairs are kept as they are and the few unmatched units are appended, so a unit
    holding very many parcels never becomes the key of a join.
    """
    pairs = stored(pairs)  # used twice: the join that made them runs once
    matched = pairs.filter(F.col(unit).isNotNull())
    empty = units.select(unit).join(matched.select(unit).distinct(), unit, "left_anti")
    return matched.unionByName(empty, allowMissingColumns=True)


def count_candidates(pairs: DataFrame, key: str) -> DataFrame:
    """How many parcels have one, two, ... candidate units."""
    per_parcel = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("candidates"))
    return per_parcel.groupBy("candidates").agg(F.count(F.lit(1)).alias("parcels"))
