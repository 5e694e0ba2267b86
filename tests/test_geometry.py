"""Geometry expressions against hand-computed values and brute force."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cropmosaic.functions import geometry as G
from cropmosaic.functions.geometry import RINGS_TYPE
from cropmosaic.operators import quality


def test_holes_need_no_cutting(spark):
    """Rings that do not meet are turned, however they are drawn; the area is that of the even-odd rule."""

    def ring(n, r, x=0.0, y=0.0, step=1):
        a = np.linspace(0, 2 * np.pi, n, endpoint=False)[::step]
        return [{"x": float(x + r * np.cos(t)), "y": float(y + r * np.sin(t))} for t in a]

    shapes = [
        ("hole", [ring(40, 9), ring(30, 4)]),
        ("hole_turned", [ring(30, 4, step=-1), ring(40, 9)]),
        ("island", [ring(40, 9), ring(30, 6), ring(20, 2), ring(12, 3, 30)]),
        ("large", [ring(2000, 9), ring(300, 4)]),
    ]
    df = spark.createDataFrame(shapes, f"name string, rings {RINGS_TYPE}")
    area = lambda edges: F.expr(G.edges_area(edges))
    for r in df.filter("name <> 'large'").select("name", area(G.valid_edges("rings")).alias("a"), area(G.even_odd_edges("rings")).alias("b")).collect():
        assert r["a"] == pytest.approx(r["b"], rel=1e-12)
    start = time.perf_counter()
    large = df.filter("name = 'large'").select(area(G.valid_edges("rings"))).first()[0]
    assert large == pytest.approx(np.pi * (81 - 16), rel=1e-3)
    assert time.perf_counter() - start < 6  # 2300 corners, start of the job included


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def frame(spark, *columns):
    """One row per tuple of geometries; a geometry is a list of rings of (x, y)."""
    names = ["a", "b"][: len(columns[0])]
    rows = [tuple([[{"x": float(x), "y": float(y)} for x, y in ring] for ring in g] for g in row) for row in columns]
    return spark.createDataFrame(rows, ", ".join(f"{n} {RINGS_TYPE}" for n in names))


def values(spark, geometries, text):
    return [r[0] for r in frame(spark, *[(g,) for g in geometries]).select(F.expr(text)).collect()]


BOW_TIE = [[(0, 0), (4, 4), (4, 0), (0, 4)]]
WITH_HOLE = [box(0, 0, 4, 3), box(1, 1, 2, 2)[::-1]]
TWO_PARTS = [box(0, 0, 1, 1), box(3, 0, 5, 2)]


def inside(rings, x, y):
    """Even-odd test of many points."""
    odd = np.zeros(x.shape, dtype=bool)
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if x1 != x2:
                crosses = (x1 > x) != (x2 > x)
                odd ^= crosses & (y1 + (x - x1) / (x2 - x1) * (y2 - y1) > y)
    return odd


def grid_area(*polygons, n=700):
    points = np.array([p for g in polygons for ring in g for p in ring], dtype=float)
    (x0, y0), (x1, y1) = points.min(axis=0), points.max(axis=0)
    xs = x0 + (np.arange(n) + 0.5) * (x1 - x0) / n
    ys = y0 + (np.arange(n) + 0.5) * (y1 - y0) / n
    x, y = np.meshgrid(xs, ys)
    hit = np.ones(x.shape, dtype=bool)
    for g in polygons:
        hit &= inside(g, x, y)
    return hit.mean() * (x1 - x0) * (y1 - y0)


def star(rng, cx, cy, corners=15):
    angles = np.sort(rng.uniform(0, 2 * np.pi, corners))
    radius = rng.uniform(2, 10, corners)
    return [[(cx + r * math.cos(t), cy + r * math.sin(t)) for r, t in zip(radius, angles)]]


def tangle(rng, corners=7):
    return [[tuple(p) for p in rng.uniform(0, 10, (corners, 2))]]


def test_areas(spark):
    got = values(spark, [WITH_HOLE, [box(0, 0, 4, 3)[::-1]], TWO_PARTS, []], G.polygon_area("a"))
    assert got == [11.0, 12.0, 5.0, 0.0]


def test_area_keeps_digits_far_from_origin(spark):
    far = [[(700000 + x, 6600000 + y) for x, y in box(0.1, 0.1, 0.4, 0.3)]]
    assert values(spark, [far], G.polygon_area("a"))[0] == pytest.approx(0.06, rel=1e-7)


def test_bbox(spark):
    got = values(spark, [TWO_PARTS, []], G.bbox("a"))
    assert tuple(got[0]) == (0.0, 0.0, 5.0, 2.0) and got[1] is None


def test_lambert93(spark):
    df = frame(spark, ([[(3.0, 46.5), (2.3522, 48.8566)]],))
    ring = df.select(F.expr(G.to_lambert93("a", "4326"))).first()[0][0]
    assert (ring[0].x, ring[0].y) == pytest.approx((700000, 6600000), abs=1e-6)
    assert (ring[1].x, ring[1].y) == pytest.approx((652469.023, 6862035.259), abs=1e-3)
    same = df.select(F.expr(G.to_lambert93("a", "2154"))).first()[0][0]
    assert same[0].x == 3.0
    with pytest.raises(Exception, match="no transform"):
        df.select(F.expr(G.to_lambert93("a", "27572"))).collect()


def test_lambert93_and_back(spark):
    rng = np.random.default_rng(1)
    points = [(float(x), float(y)) for x, y in zip(rng.uniform(-5, 10, 200), rng.uniform(41, 51.5, 200))]
    df = frame(spark, ([points],)).withColumn("m", F.expr(G.to_lambert93("a", "4326"))).withColumn("back", F.expr(G.to_lonlat("m", "2154")))
    back = df.select("back", F.expr(G.to_lonlat("back", "4326")).alias("same")).first()
    assert max(abs(p.x - x) * 1.1e8 for p, (x, _) in zip(back[0][0], points)) < 1  # millimetres
    assert max(abs(p.y - y) * 1.1e8 for p, (_, y) in zip(back[0][0], points)) < 1
    assert back[1] == back[0]
    with pytest.raises(Exception, match="no transform"):
        df.select(F.expr(G.to_lonlat("a", "27572"))).collect()


OVERLAPS = [
    ([box(0, 0, 4, 4)], [box(2, 2, 6, 6)], 4.0),
    (WITH_HOLE, [box(1, 1, 2, 2)], 0.0),
    (WITH_HOLE, [box(0, 0, 2, 2)], 3.0),
    ([box(0, 0, 1, 1)], [box(1, 0, 2, 1)], 0.0),
    (TWO_PARTS, [box(0, 0, 4, 1)], 2.0),
    (WITH_HOLE, WITH_HOLE, 11.0),
]


def test_overlaps(spark):
    df = frame(spark, *[(a, b) for a, b, _ in OVERLAPS])
    for edges in (G.oriented_edges, G.even_odd_edges, G.valid_edges):
        got = [r[0] for r in df.select(F.expr(G.overlap_area(edges("a"), edges("b")))).collect()]
        assert got == pytest.approx([want for _, _, want in OVERLAPS], abs=1e-12)


def test_overlap_of_stars_against_points(spark):
    rng = np.random.default_rng(1)
    pairs = [(star(rng, 0, 0), star(rng, *rng.uniform(-5, 5, 2))) for _ in range(12)]
    text = G.overlap_area(G.valid_edges("a"), G.valid_edges("b"))
    df = frame(spark, *pairs)
    got = [r[0] for r in df.select(F.expr(text)).collect()]
    back = [r[0] for r in df.select(F.expr(G.overlap_area(G.valid_edges("b"), G.valid_edges("a")))).collect()]
    assert got == pytest.approx(back, rel=1e-9, abs=1e-9)
    areas = [(r[0], r[1]) for r in df.select(F.expr(G.polygon_area("a")), F.expr(G.polygon_area("b"))).collect()]
    for (a, b), overlap, sizes in zip(pairs, got, areas):
        assert overlap == pytest.approx(grid_area(a, b), abs=0.01 * max(sizes))
        assert overlap <= min(sizes) + 1e-9


REPAIRED = [
    (BOW_TIE, 8.0),
    ([[(0, 0), (2, 2), (4, 4), (4, 0), (2, 2), (0, 4)]], 8.0),  # crossing at a vertex visited twice
    ([box(0, 0, 4, 3), box(1, 1, 2, 2)], 11.0),  # hole drawn like a shell
    ([box(0, 0, 2, 2), box(2, 0, 4, 2)], 8.0),  # parts sharing a side
    ([box(0, 0, 2, 2), box(2, 1, 4, 3)], 8.0),  # parts sharing half a side
    ([[(0, 0), (4, 0), (4, 4), (2, 4), (2, 6), (2, 4), (0, 4)]], 16.0),  # spike
    ([box(0, 0, 2, 2), box(1, 1, 3, 3)], 6.0),  # overlapping parts: even-odd
]


def test_repair(spark):
    geometries = [g for g, _ in REPAIRED]
    got = values(spark, geometries, G.edges_area(G.valid_edges("a")))
    assert got == pytest.approx([want for _, want in REPAIRED], abs=1e-9)
    assert all(values(spark, geometries[:2] + [geometries[5]], G.self_crossing("a")))
    assert not any(values(spark, [WITH_HOLE, TWO_PARTS, [box(0, 0, 1, 1)]], G.self_crossing("a")))


def test_repair_of_tangled_rings_against_points(spark):
    rng = np.random.default_rng(2)
    tangles = [tangle(rng) for _ in range(25)]
    got = values(spark, tangles, G.edges_area(G.valid_edges("a")))
    for g, area in zip(tangles, got):
        assert area == pytest.approx(grid_area(g), abs=0.5)


def test_self_crossing_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    rings = [tangle(rng, 5)[0] for _ in range(40)] + [star(rng, 0, 0)[0] for _ in range(10)]

    def crosses(ring):
        edges = list(zip(ring, ring[1:] + ring[:1]))

        def side(e, p):
            (x1, y1), (x2, y2) = e
            return np.sign((x2 - x1) * (p[1] - y1) - (y2 - y1) * (p[0] - x1))

        return any(
            side(e, f[0]) * side(e, f[1]) < 0 and side(f, e[0]) * side(f, e[1]) < 0
            for i, e in enumerate(edges)
            for f in edges[:i]
        )

    got = values(spark, [[r] for r in rings], G.self_crossing("a"))
    assert got == [crosses(r) for r in rings]


def test_clean_rings(spark):
    messy = [[(0, 0), (0, 0), (4, 0), (4, 3), (4, 3), (0, 3)][::-1], box(1, 1, 2, 2), [(5, 5), (6, 6), (5, 5)]]
    rings = values(spark, [messy], G.clean_rings("a"))[0]
    assert [len(r) for r in rings] == [5, 5]
    assert all(r[0] == r[-1] for r in rings)
    assert values(spark, [messy], G.signed_area(G.clean_rings("a")))[0] == 11.0
    island = [box(0, 0, 9, 9), box(1, 1, 8, 8), box(2, 2, 7, 7)]
    assert values(spark, [island], G.signed_area(G.clean_rings("a")))[0] == 81 - 49 + 25


def test_flag_invalid(spark):
    df = frame(spark, ([box(0, 0, 4, 3)],), (BOW_TIE,), ([box(0, 0, 4, 3)[::-1]],), ([[(0, 0), (1, 1)]],))
    rows = quality.flag_invalid(df.withColumnRenamed("a", "rings").withColumn("id", F.monotonically_increasing_id()), ["id"])
    got = [r.asDict() for r in rows.orderBy("id").collect()]
    assert [r["valid"] for r in got] == [True, False, False, False]
    assert got[1]["crossing"] and got[1]["open_rings"] == 1
    assert got[2]["misoriented"] and got[3]["small_rings"] == 1


def test_polygon_parts(spark):
    island = [box(0, 0, 9, 9), box(1, 1, 8, 8), box(2, 2, 7, 7), box(20, 20, 21, 21)]
    parts = values(spark, [island], G.polygon_parts(G.clean_rings("a")))[0]
    assert sorted(len(p) for p in parts) == [1, 1, 2]
