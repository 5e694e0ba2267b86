"""Parcels laid over tiles that a task holds: against the join, whole, and without an exchange."""

import math
from collections import Counter

import numpy as np
import pytest
from conftest import executed_plan
from pyspark.sql import functions as F
from test_geometry import box, star
from test_outlines import mixed
from test_spatial import features

from cropmosaic.functions import geometry as G
from cropmosaic.functions import outlines, tiles
from cropmosaic.operators import skew, spatial


def rows_of(df) -> Counter:
    def plain(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else round(v, 6) + 0.0 if isinstance(v, float) else v

    return Counter(tuple(plain(v) for v in r) for r in df.collect())


def layouts(spark):
    rng = np.random.default_rng(11)
    stars = [(f"s{i}", star(rng, *rng.uniform(0, 40, 2))) for i in range(40)]
    boxes = [(f"b{i}", [box(x, y, x + w, y + h)]) for i, (x, y, w, h) in enumerate(rng.integers(1, 30, (40, 4)).astype(float))]
    shapes = [
        ("bow", [[(8, 2), (14, 4), (14, 2), (8, 4)]]),
        ("holed", [box(3, 3, 30, 30), box(8, 8, 20, 20)]),
        ("spike", [[(1, 1), (9, 1), (9, 9), (9, 12), (9, 9), (1, 9)]]),
        ("away", [box(900, 900, 901, 901)]),
        ("wide", [box(-500, 5, 500, 6)]),
        ("empty", []),
        ("ringless", [[]]),
        ("line", [[(1, 1), (1, 9)]]),
    ]
    units = [(f"u{i:02d}", [[(x * 3 + 20, y * 3 + 20) for x, y in star(rng, *rng.uniform(-8, 8, 2))[0]]]) for i in range(9)]
    units += [("square", [box(0, 0, 18, 18)]), ("ring", [box(0, 0, 40, 40), box(5, 5, 35, 35)])]
    return features(spark, "parcel_id", stars + boxes + shapes), features(spark, "geo_unit", units)


@pytest.mark.parametrize("size", [3.0, 200.0])
def test_as_the_join_tells(spark, size):
    parcels, units = layouts(spark)
    units = units.unionByName(features(spark, "geo_unit", [("none", [box(2, 2, 9, 9)])]).withColumn("geo_unit", F.lit(None).cast("string")))
    held = spatial.unit_tiles(units, size)
    parcels = parcels.withColumn("year", F.lit(2010))
    got, want = (rows_of(spatial.overlaps(parcels, held, size, ["parcel_id"], ["year"], limit=n)) for n in (skew.BROADCAST_BYTES, -1))
    assert got == want and len(got) > 100


def test_as_the_join_tells_with_cells_of_several_sizes(spark):
    parcels, units = mixed(spark)
    held = spatial.unit_tiles(units, 2.0)
    forms = [spatial.overlaps(parcels, held, 2.0, ["parcel_id"], limit=n).collect() for n in (skew.BROADCAST_BYTES, -1)]
    got, want = ({(r["parcel_id"], r["geo_unit"]): r["overlap_m2"] for r in rows} for rows in forms)
    assert got.keys() == want.keys() and len(forms[0]) == len(got)
    for pair, area in want.items():
        assert got[pair] == (None if area is None else pytest.approx(area, rel=1e-7, abs=1e-4)), pair


def test_no_tiles(spark):
    parcels, units = layouts(spark)
    held = spatial.unit_tiles(units.limit(0), 5.0)
    assert rows_of(spatial.overlaps(parcels, held, 5.0, ["parcel_id"])) == Counter((r[0], None, None) for r in parcels.select("parcel_id").collect())


def test_parcels_stay_where_they_were_read(spark):
    parcels, units = layouts(spark)
    held = spatial.unit_tiles(units, 5.0)
    for some in (parcels, parcels.withColumn("feature", F.col("parcel_id"))):
        plan = executed_plan(spatial.overlaps(some, held, 5.0, ["parcel_id"]))
        assert "Exchange" not in plan and "Aggregate" not in plan


def test_parcels_of_one_feature_are_added_up(spark):
    parcels = features(spark, "parcel_id", [("a", [box(1, 1, 4, 4)])] * 2 + [("b", [box(3, 3, 8, 6)])] * 2 + [("c", [box(60, 0, 61, 1)])] * 2)
    parcels = parcels.withColumn("feature", F.when(F.col("parcel_id") != "b", F.col("parcel_id")))
    held = spatial.unit_tiles(features(spark, "geo_unit", [("u", [box(0, 0, 20, 20)]), ("v", [box(0, 0, 3, 20)])]), 5.0)
    got, want = (rows_of(spatial.overlaps(parcels, held, 5.0, ["parcel_id"], limit=n)) for n in (skew.BROADCAST_BYTES, -1))
    assert got == want
    # b names no feature, so its rows stay apart; its box touches a tile of v
    assert got - Counter({("b", "v", 0.0): 2}) == Counter({("a", "u", 18.0): 1, ("a", "v", 12.0): 1, ("b", "u", 15.0): 2, ("c", None, None): 1})


def test_odd_coordinates_are_left_to_the_expression(spark):
    held = spatial.unit_tiles(features(spark, "geo_unit", [("square", [box(0, 0, 18, 18)]), ("ring", [box(0, 0, 40, 40), box(5, 5, 35, 35)])]), 5.0)
    nan, inf = float("nan"), float("inf")
    odd = [None, [[(1, 1), (9, 1), (9, None), (1, 9)]], [[(1, 1), (9, nan), (9, 9), (1, 9)]], [[(1, 1), (9, 1), (9, inf), (1, 9)]], [[(1, None), (9, None), (9, None)]]]
    odd += [[box(2, 2, 4, 4)], [None], [[(1, 1), None, (9, 9), (1, 9)]]]

    def rings(g):
        return g and [r and [p and {"x": None if p[0] is None else float(p[0]), "y": None if p[1] is None else float(p[1])} for p in r] for r in g]

    parcels = spark.createDataFrame([(f"o{i}", rings(g)) for i, g in enumerate(odd)], f"parcel_id string, rings {G.RINGS_TYPE}")
    got, want = (rows_of(spatial.overlaps(parcels, held, 5.0, ["parcel_id"], limit=n)) for n in (skew.BROADCAST_BYTES, -1))
    assert got == want and {k[0] for k in got} == {f"o{i}" for i in range(len(odd))}


def test_plain_outlines_are_those_of_the_expression(spark):
    rng = np.random.default_rng(3)
    shapes = [[[tuple(map(float, p)) for p in rng.integers(0, g, (rng.integers(0, 8), 2))] for _ in range(rng.integers(0, 3))] for g in (3, 6, 40) * 200]
    stars = [star(rng, *rng.uniform(0, 9, 2))[0] for _ in range(60)]
    shapes += [[[(float(x), float(y)) for x, y in ring[:: (-1) ** i]]] for i, ring in enumerate(stars)]
    shapes += [None, [], [[]], [[(0.0, float("nan")), (1.0, 1.0), (2.0, 0.0)]]]
    df = spark.createDataFrame([(s,) for s in shapes], f"rings {G.RINGS_TYPE}")
    told = df.select(outlines.outline_parts("rings").alias("p"), F.expr(G.valid_edges("rings")).alias("e"), F.expr(G.bbox("rings")).alias("b"))
    rows = told.collect()
    plain = [r for r in rows if r["p"]["edges"] is not None]
    assert len(plain) > 150 and all(r["p"]["edges"] == r["e"] and r["p"]["box"] == r["b"] for r in plain)
    assert all(r["p"]["box"] is None for r in rows if r["p"]["edges"] is None)


@pytest.mark.parametrize("few", [1, 7])
def test_small_steps_make_the_same_rows(spark, monkeypatch, few):
    parcels, units = layouts(spark)
    held = spatial.unit_tiles(units, 5.0).toArrow()
    shaped = spatial._shaped(parcels, ["parcel_id"], False).toArrow().combine_chunks()
    edges, boxes = (shaped.column(c).chunk(0) for c in ("_edges", "box"))

    def laid():
        parts = list(tiles.Tiles(held, "geo_unit", 5.0, spatial.TILE_SPAN).lay(edges, boxes))
        assert [p[0] for p in parts] == [0, *(p[1] for p in parts[:-1])] and parts[-1][1] == len(edges)
        return [[(e["geo_unit"], e["overlap_m2"]) for e in row] for p in parts for row in p[2].to_pylist()], len(parts)

    want, whole = laid()
    for name in ("CELLS", "PAIRS", "EDGE_PAIRS"):
        monkeypatch.setattr(tiles, name, few)
    got, cut = laid()
    assert whole == 1 and cut > 10 and [[u for u, _ in row] for row in got] == [[u for u, _ in row] for row in want]
    areas = [[a for row in rows for _, a in row if a is not None] for rows in (got, want)]
    assert areas[0] == pytest.approx(areas[1], abs=1e-9)
