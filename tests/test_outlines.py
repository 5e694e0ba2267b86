"""Clipped pieces, cells of several sizes, unions and outlines walked back from edges."""

import numpy as np
import pytest
from conftest import executed_plan
from pyspark.sql import functions as F
from test_geometry import box, star
from test_spatial import brute, features

from cropmosaic.functions import geometry as G
from cropmosaic.functions import outlines
from cropmosaic.operators import dissolve, quality, skew, spatial
from cropmosaic.sinks.tables import write_features
from cropmosaic.sources.shapefile import read_shapefiles


def ring_area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]])) / 2


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]]):
            if (ax > x) != (bx > x) and ay + (x - ax) / (bx - ax) * (by - ay) > y:
                odd = not odd
    return odd


def signed(polygons):
    """Edges of counter-clockwise rings as five columns."""
    rows = []
    for ring in polygons:
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]]):
            if ax != bx:
                rows.append((bx, by, ax, ay, 1) if bx < ax else (ax, ay, bx, by, -1))
    columns = [np.array(c, np.float64) for c in zip(*rows)] or [np.zeros(0)] * 5
    return [*columns[:4], columns[4].astype(np.int64)]


def some_polygons(rng):
    out = []
    for _ in range(rng.integers(1, 9)):
        x, y = (int(v) for v in rng.integers(0, 12, 2))
        kind, w, n = rng.integers(0, 3), int(rng.integers(1, 7)), int(rng.integers(3, 12))
        if kind == 0:
            h = int(rng.integers(1, 7))
            out.append([(x, y), (x + w, y), (x + w, y + h), (x, y + h)])
        elif kind == 1:
            turn, r = np.arange(n) * 2 * np.pi / n, rng.uniform(1, 5, n)
            out.append(list(zip((x + r * np.cos(turn)).tolist(), (y + r * np.sin(turn)).tolist())))
        else:
            out.append([(x, y), (x + w, y + w), (x, y + 2 * w), (x - w, y + w)])
    return out


# ---------------------------------------------------------------- unions and walks


def test_union_and_walk_against_points():
    rng = np.random.default_rng(1)
    for _ in range(150):
        polygons = some_polygons(rng)
        united = outlines.union(*signed(polygons))
        rings = outlines.walk(*united)
        points = rng.uniform(-5, 20, (200, 2))
        assert all(inside(rings, *p) == any(inside([ring], *p) for ring in polygons) for p in points)
        x1, y1, x2, y2, s = united
        assert sum(map(ring_area, (r[:-1] for r in rings))) == pytest.approx((s * (x2 - x1) * (y1 + y2) / 2).sum(), abs=1e-6)
        assert all(len(set(r)) == len(r) - 1 and r[0] == r[-1] for r in rings)


def test_walk_cases():
    def rings(*polygons):
        return outlines.walk(*outlines.union(*signed(polygons)))

    square = [(0, 0), (2, 0), (2, 2), (0, 2)]
    assert rings(square) == [[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]]
    assert rings(square, square) == rings(square)
    assert rings(square, [(2, 0), (4, 0), (4, 2), (2, 2)]) == [[(0, 0), (4, 0), (4, 2), (0, 2), (0, 0)]]  # shared border gone
    touching = rings(square, [(2, 2), (4, 2), (4, 4), (2, 4)])  # one corner shared: two rings
    assert sorted(map(len, touching)) == [5, 5]
    frame = rings([(0, 0), (3, 0), (3, 1), (0, 1)], [(0, 2), (3, 2), (3, 3), (0, 3)], [(0, 0), (1, 0), (1, 3), (0, 3)], [(2, 0), (3, 0), (3, 3), (2, 3)])
    assert sorted(ring_area(r[:-1]) for r in frame) == [-1.0, 9.0]  # a hole
    assert outlines.walk(*[np.zeros(0)] * 5) == []


def test_crossings_in_blocks(monkeypatch):
    rng = np.random.default_rng(4)
    edges = signed([list(zip(rng.uniform(0, 10, 40).tolist(), rng.uniform(0, 10, 40).tolist()))])[:4]
    whole = np.sort(outlines.crossings(*edges))
    monkeypatch.setattr(outlines, "_ROWS", 3)
    assert np.allclose(np.sort(outlines.crossings(*edges)), whole) and len(whole) > 50


# ---------------------------------------------------------------- dissolve


def groups_of_polygons(spark, rng, groups=12):
    rows = [(f"g{g}" if g else None, p) for g in range(groups) for p in some_polygons(rng)]
    return rows, features(spark, "g", [(g, [p]) for g, p in rows])


@pytest.mark.parametrize("size,most", [(100.0, 1024), (3.3, 1024), (7.0, 8)])
def test_dissolve_against_one_union(spark, monkeypatch, size, most):
    monkeypatch.setattr(dissolve, "MOST_EDGES", most)  # 8: crowded cells are cut again and again
    monkeypatch.setattr(dissolve, "DEEPEST", 5)
    rows, df = groups_of_polygons(spark, np.random.default_rng(6))
    united = dissolve.dissolve(df, ["g"], size).cache()
    got = dict(map(tuple, dissolve.dissolved_area(united, ["g"]).collect()))
    whole = {r["g"]: [[(p["x"], p["y"]) for p in ring] for ring in r["rings"]] for r in dissolve.outlines(united, ["g"]).collect()}
    assert set(got) == {g for g, _ in rows} == set(whole)
    rng = np.random.default_rng(0)
    for g in got:
        polygons = [p for h, p in rows if h == g]
        x1, y1, x2, y2, s = outlines.union(*signed(polygons))
        assert got[g] == pytest.approx((s * (x2 - x1) * (y1 + y2) / 2).sum(), abs=1e-6)
        assert sum(ring_area(r[:-1]) for r in whole[g]) == pytest.approx(got[g], abs=1e-5)
        assert all(inside(whole[g], *p) == any(inside([ring], *p) for ring in polygons) for p in rng.uniform(-5, 20, (100, 2)))


def test_dissolve_odd(spark):
    crossing = [[(0, 0), (4, 4), (4, 0), (0, 4)]]
    df = features(spark, "g", [("a", crossing), ("a", crossing), ("b", []), ("c", [[]]), (None, [box(0, 0, 1, 1)])])
    got = dict(map(tuple, dissolve.dissolved_area(dissolve.dissolve(df, ["g"], 1.5), ["g"]).collect()))
    assert got == {"a": pytest.approx(8.0), None: pytest.approx(1.0)}
    assert dissolve.dissolve(df.limit(0), ["g"], 1.5).count() == 0


def test_many_copies_are_one(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), F.expr(G.box_rings("0", "0", "10", "10")).alias("rings"))
    united = dissolve.dissolve(df, ["g"], 4.0)
    assert dissolve.dissolved_area(united, ["g"]).first()["area_m2"] == pytest.approx(100.0)
    assert len(dissolve.outlines(united, ["g"]).first()["rings"][0]) == 5


# ---------------------------------------------------------------- repaired outlines


def test_repaired_outlines_round_trip(spark, tmp_path):
    rng = np.random.default_rng(12)
    tangled = [[(float(x), float(y)) for x, y in rng.integers(0, 9, (int(rng.integers(4, 9)), 2))] for _ in range(40)]
    rows = [(f"t{i:02d}", [ring]) for i, ring in enumerate(tangled)]
    rows += [("hole", [box(0, 0, 9, 9), box(2, 2, 5, 5)]), ("flat", [[(0, 0), (5, 0), (9, 0)]]), ("empty", [])]
    df = features(spark, "k", rows)
    fixed = dissolve.repair_outlines(df).cache()
    area = {r["k"]: r["a"] for r in df.select("k", F.expr(G.edges_area(G.even_odd_edges("rings"))).alias("a")).collect()}
    write_features(fixed.filter("size(rings) > 0"), str(tmp_path / "out"))
    back = {r["k"]: r for r in read_shapefiles(spark, str(tmp_path / "out")).select("k", "rings", F.expr(G.polygon_area("rings")).alias("a")).collect()}
    assert {r["k"] for r in fixed.collect() if not r["rings"]} == {k for k, a in area.items() if abs(a) < 1e-9} >= {"flat", "empty"}
    for k, rings in rows:
        if k not in back:
            continue
        assert back[k]["a"] == pytest.approx(area[k], abs=1e-6)
        found = [[(p["x"], p["y"]) for p in ring] for ring in back[k]["rings"]]
        assert all(inside(found, *p) == inside(rings, *p) for p in rng.uniform(-1, 10, (100, 2)))
    own = quality.flag_invalid(fixed.select("k", F.explode("rings").alias("r")).select("k", F.array("r").alias("rings")), ["k"])
    assert own.filter("crossing OR open_rings > 0 OR repeated_points > 0").count() == 0


def test_repair_keeps_nulls_and_columns(spark):
    df = features(spark, "k", [("a", [box(0, 0, 1, 1)])]).withColumn("n", F.lit(3))
    df = df.unionByName(df.withColumn("rings", F.lit(None).cast(G.RINGS_TYPE)))
    got = dissolve.repair_outlines(df)
    assert set(got.columns) == {"k", "n", "rings"} and got.filter("rings IS NULL").count() == 1


# ---------------------------------------------------------------- pieces inside their cells


@pytest.mark.parametrize("size", [2.3, 9.0, 40.0])
def test_pieces_lie_in_their_cells_and_add_up(spark, monkeypatch, size):
    monkeypatch.setattr(spatial, "FEW_EDGES", 0)
    rng = np.random.default_rng(3)
    parcels = features(spark, "parcel_id", [(f"p{i}", star(rng, *rng.uniform(-20, 20, 2))) for i in range(30)])
    parcels = parcels.unionByName(features(spark, "parcel_id", [("holed", [box(0, 0, 30, 30), box(3, 3, 21, 26)[::-1]])]))
    cells = spatial.parcel_cells(spatial._shaped(parcels, ["parcel_id"], True), size, contact=True)
    out = f"exists(_edges, e -> e.x1 < cx * {size}D OR e.x2 > (cx + 1) * {size}D OR least(e.y1, e.y2) < cy * {size}D - 1e-9 OR greatest(e.y1, e.y2) > (cy + 1) * {size}D + 1e-9)"
    assert cells.filter(F.expr(out)).count() == 0
    sums = cells.groupBy("parcel_id").agg(F.sum(F.expr(G.edges_area("_edges", "box.ymin"))).alias("a"), F.max("_drawn").alias("d")).collect()
    assert len(sums) == 31 and all(r["a"] == pytest.approx(r["d"], rel=1e-9) for r in sums)


def test_a_long_outline_is_not_repeated_in_every_cell(spark):
    """A saw of 4,000 teeth over 40 x 40 cells: the pieces of all cells together stay near the length of the outline."""
    teeth = [(i / 100, 39.0 + (i % 2) * 0.5) for i in range(4000)]
    parcels = features(spark, "parcel_id", [("saw", [[(0.0, 0.0), (39.99, 0.0), *teeth[::-1]]])])
    shaped = spatial._shaped(parcels, ["parcel_id"], True)
    edges, segs = spatial.parcel_cells(shaped, 1.0, contact=True).agg(F.sum(F.size("_edges")), F.sum(F.size("_segs"))).first()
    assert edges < 3 * 4000 + 40 * 40 * 4 and segs < 3 * 4000


def test_no_whole_outline_in_an_exchange(spark):
    """In the shuffle form outlines are cut before they are written, and the plan reads that table."""
    rng = np.random.default_rng(7)
    parcels = features(spark, "parcel_id", [(f"p{i}", star(rng, *rng.uniform(0, 60, 2))) for i in range(20)])
    tiles = spatial.unit_tiles(features(spark, "geo_unit", [("u", [box(0, 0, 60, 60)])]), 10.0, contact=True)
    for join in (spatial.join_largest, spatial.join_intersects):
        plan = executed_plan(join(parcels, tiles, 10.0, ["parcel_id"], limit=-1))
        assert "Exchange" in plan and "valid_edges" not in plan and "rings" not in plan
        assert "Scan ExistingRDD" not in plan  # the source was read before, once


# ---------------------------------------------------------------- cells of several sizes


def mixed(spark):
    """Units and parcels from 1 m to 100 km across, one parcel with a stray corner far away."""
    rng = np.random.default_rng(9)
    sides = [1.0, 3.0, 10.0, 400.0, 9_000.0, 100_000.0]

    def some(name, n):
        rows = []
        for i in range(n):
            r, (x, y) = sides[i % len(sides)], rng.uniform(0, 60, 2)
            rows.append((f"{name}{i}", [[(x + a * r / 10, y + b * r / 10) for a, b in star(rng, 0, 0)[0]]]))
        return rows

    parcels = some("p", 30) + [("stray", [[(0.0, 0.0), (40.0, 1.0), (3e6, 2e6), (1.0, 40.0)]])]
    units = some("u", 18) + [("far", [box(5e5, 5e5, 5e5 + 10, 5e5 + 10)])]
    return features(spark, "parcel_id", parcels), features(spark, "geo_unit", units)


@pytest.mark.parametrize("limit", [skew.BROADCAST_BYTES, -1])
def test_mixed_sizes(spark, limit):
    parcels, units = mixed(spark)
    want = brute(parcels, units)
    tiles = spatial.unit_tiles(units, 2.0, contact=True)
    assert tiles.count() < 19 * (spatial.TILE_SPAN + 2) ** 2 and tiles.select("lv").distinct().count() > 3
    got = {(r[0], r[1]): r[2] for r in spatial.overlaps(parcels, tiles, 2.0, ["parcel_id"], limit=limit).collect()}
    for pair, area in want.items():
        assert (got.get(pair) or 0.0) == pytest.approx(area, rel=1e-7, abs=1e-4), pair
    touching = {tuple(r) for r in spatial.join_intersects(parcels, tiles, 2.0, ["parcel_id"], limit=limit).collect() if r[1]}
    assert touching >= {p for p, a in want.items() if a > 1e-3}
    assert {p for p, _ in touching} <= {p for p, _ in want} and spatial.join_largest(parcels, tiles, 2.0, ["parcel_id"], limit=limit).count() == 31


@pytest.mark.parametrize("limit", [skew.BROADCAST_BYTES, -1])
def test_candidates_of_mixed_sizes(spark, limit):
    parcels, units = mixed(spark)
    boxes = parcels.select("parcel_id", F.expr(G.bbox("rings")).alias("p")).crossJoin(units.select("geo_unit", F.expr(G.bbox("rings")).alias("u")))
    want = boxes.filter("p.xmin <= u.xmax AND u.xmin <= p.xmax AND p.ymin <= u.ymax AND u.ymin <= p.ymax").select("parcel_id", "geo_unit")
    got = spatial.candidate_pairs(parcels, units, 2.0, "parcel_id", "geo_unit", limit)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spatial.candidate_pairs(parcels, units.limit(0), 2.0, "parcel_id", "geo_unit", limit).count() == 0


def test_rows_per_feature_are_bounded(spark):
    parcels, _ = mixed(spark)
    boxes = parcels.select("parcel_id", F.expr(G.bbox("rings")).alias("b")).withColumn("lv", spatial.cell_level("b", 2.0, spatial.PAIR_SPAN))
    keys = F.array(*[F.struct(F.lit(n).alias("lv"), F.lit(0).alias("k")) for n in spatial._levels(boxes, F.col("lv"))])
    rows = spatial._cells_of_levels(boxes.withColumnRenamed("lv", "own"), "b", 2.0, F.filter(keys, lambda e: e["lv"] >= F.col("own")))
    assert rows.groupBy("parcel_id", "lv").count().agg(F.max("count")).first()[0] <= 4


def test_a_stray_parcel_stays_within_the_tiles(spark):
    tiles = spatial.unit_tiles(features(spark, "geo_unit", [("u", [box(0, 0, 20, 20)])]), 5.0)
    stray = features(spark, "parcel_id", [("stray", [[(10.0, 10.0), (1e9, 11.0), (1e9, 12.0), (10.0, 12.0)]]), ("away", [box(90, 90, 91, 91)]), ("empty", [])])
    got = {r["parcel_id"]: (r["geo_unit"], r["overlap_m2"]) for r in spatial.join_largest(stray, tiles, 5.0, ["parcel_id"]).collect()}
    assert got == {"stray": ("u", pytest.approx(20.0, abs=1e-6)), "away": (None, None), "empty": (None, None)}


def test_groups_united_side_by_side_as_one_by_one():
    rng = np.random.default_rng(5)
    edges = []
    for group in range(40):
        for _ in range(rng.integers(1, 6)):
            x, y, r = *rng.integers(0, 6, 2), rng.integers(1, 4)
            corners = [(x, y), (x + r, y + 0.5), (x + r + 1, y + r), (x - 1, y + r)]
            for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1]):
                if ax != bx:
                    edges.append((group, *((ax, ay, bx, by, -1) if ax < bx else (bx, by, ax, ay, 1))))
    of, *pieces = (np.array(c, np.int64 if i in (0, 5) else np.float64) for i, c in enumerate(zip(*edges)))
    got = outlines.union_of_groups(of, *pieces)
    for group in range(40):
        alone = outlines.union(*[p[of == group] for p in pieces])
        assert all(np.array_equal(a[got[0] == group], b) for a, b in zip(got[1:], alone))


def test_self_meetings_tell_what_the_expression_tells(spark):
    rng = np.random.default_rng(3)
    shapes = [[[tuple(map(float, p)) for p in rng.integers(0, g, (rng.integers(0, 8), 2))] for _ in range(rng.integers(0, 3))] for g in (3, 6, 40) * 200]
    shapes += [None, [], [[(0.0, float("nan")), (1.0, 1.0), (2.0, 0.0)]]]
    df = spark.createDataFrame([(s,) for s in shapes], f"rings {G.RINGS_TYPE}")
    rows = df.select(outlines.meets_itself("rings").alias("a"), F.expr(G.self_crossing("rings")).alias("b")).collect()
    assert {(r["a"], r["b"]) for r in rows[:-1]} == {(True, True), (False, False)}
    assert rows[-1]["a"] is None  # left to the expression


def test_overlap_areas_add_up_what_the_expression_adds_up(spark, monkeypatch):
    monkeypatch.setattr(outlines, "EDGE_PAIRS", 5)
    rng = np.random.default_rng(4)

    def edges(most):
        x, y = np.sort(rng.integers(0, 9, (rng.integers(0, most), 2))) + [0, 1], rng.normal(size=(99, 2))
        return [(float(a), float(c), float(b), float(d), int(s)) for (a, b), (c, d), s in zip(x, y, rng.choice([-1, 1], 99))]

    rows = [(edges(5), edges(30)) for _ in range(300)] + [(None, edges(5)), (edges(5), None), ([], edges(5))]
    odd = [([(0.0, y, 1.0, 1.0, 1)], edges(9)) for y in (None, float("nan"), float("inf"))]
    df = spark.createDataFrame(rows + odd, f"a array<{G.EDGE_TYPE}>, b array<{G.EDGE_TYPE}>").coalesce(1)
    told = F.expr(G.overlap_area("a", "b"))
    got = df.select("a", outlines.overlap_of_edges(F.col("a"), F.col("b")).alias("batch"), told.alias("told")).collect()
    assert [r["batch"] for r in got[:300]] == [r["told"] for r in got[:300]]
    assert [r["batch"] for r in got[300:]] == [None, None, 0.0, None, None, None]  # left to the expression


def test_overlaps_are_added_up_a_batch_at_a_time(spark, monkeypatch):
    given, batch = [], outlines.overlap_of_edges
    monkeypatch.setattr(outlines, "overlap_of_edges", lambda a, b: given.append((a, b)) or batch(a, b))
    units = features(spark, "geo_unit", [("u", star(np.random.default_rng(5), 5, 5, 9))])
    parcels = features(spark, "parcel_id", [("p", [box(3, 3, 4, 4)])])
    pairs = spatial.overlaps(parcels, spatial.unit_tiles(units, 2.0), 2.0, ["parcel_id"]).filter("geo_unit = 'u'").collect()
    assert len(given) == len(pairs) == 1 and 0 < pairs[0]["overlap_m2"] <= 1


@pytest.mark.parametrize("limit", [skew.BROADCAST_BYTES, -1])
def test_tasks_behind_the_join_grow_with_its_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(spatial, "MOVED_ROWS", 3)
    parcels = features(spark, "parcel_id", [(f"p{i}", [box(i, 0, i + 1, 1)]) for i in range(60)])
    tiles = spatial.unit_tiles(features(spark, "geo_unit", [("u", [box(0, 0, 90, 60)])]), 100.0, contact=True)
    for join in (spatial.join_largest, spatial.join_intersects):
        found = join(parcels, tiles, 100.0, ["parcel_id"], limit=limit)
        assert found.rdd.getNumPartitions() == 20
        assert {r["geo_unit"] for r in found.collect()} == {"u"} and found.count() == 60
