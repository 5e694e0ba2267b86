"""Spatial joins: brute force, independence of the grid, hot cells, plans."""

import numpy as np
import pytest
from conftest import executed_plan
from pyspark.sql import functions as F
from test_geometry import box, star

from cropmosaic.functions import geometry as G
from cropmosaic.functions.geometry import RINGS_TYPE
from cropmosaic.operators import skew, spatial


def features(spark, key, rows):
    data = [(k, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in g]) for k, g in rows]
    return spark.createDataFrame(data, f"{key} string, rings {RINGS_TYPE}")


@pytest.fixture(scope="module")
def stars(spark):
    rng = np.random.default_rng(7)
    parcels = features(spark, "parcel_id", [(f"p{i}", star(rng, *rng.uniform(0, 60, 2))) for i in range(60)])
    units = features(spark, "geo_unit", [(f"u{i:02d}", [[(x * 3 + 30, y * 3 + 30) for x, y in star(rng, *rng.uniform(-10, 10, 2))[0]]]) for i in range(12)])
    return parcels.cache(), units.cache()


def brute(parcels, units):
    """All pairs, in the test only."""
    area = F.expr(G.overlap_area(G.valid_edges("rings"), G.valid_edges("r")))
    pairs = parcels.crossJoin(units.withColumnRenamed("rings", "r")).select("parcel_id", "geo_unit", area.alias("a"))
    return {(r[0], r[1]): r[2] for r in pairs.collect()}


@pytest.mark.parametrize("size", [3.7, 10.0, 25.0, 200.0])
@pytest.mark.parametrize("limit", [skew.BROADCAST_BYTES, -1])
def test_overlaps_do_not_depend_on_the_grid(stars, size, limit):
    parcels, units = stars
    want = brute(parcels, units)
    tiles = spatial.unit_tiles(units, size)
    got = {(r[0], r[1]): r[2] for r in spatial.overlaps(parcels, tiles, size, ["parcel_id"], limit=limit).collect()}
    for pair, area in want.items():
        assert (got.get(pair) or 0.0) == pytest.approx(area, abs=1e-7)
    best = {r["parcel_id"]: r["geo_unit"] for r in spatial.join_largest(parcels, tiles, size, ["parcel_id"], limit=limit).collect()}
    for p in {p for p, _ in want}:
        of_p = {u: a for (q, u), a in want.items() if q == p and a > 1e-6}
        assert best[p] == (max(of_p, key=of_p.get) if of_p else None)


@pytest.mark.parametrize("limit", [skew.BROADCAST_BYTES, -1])
def test_equal_features_stay_rows(spark, limit):
    square = [[(0, 0), (5, 0), (5, 5), (0, 5)]]
    parcels = features(spark, "parcel_id", [("a", square), ("a", square), ("a", [[(20, 0), (25, 0), (25, 5), (20, 5)]])])
    tiles = spatial.unit_tiles(features(spark, "geo_unit", [("u", [[(-1, -1), (30, -1), (30, 30), (-1, 30)]])]), 7.0, contact=True)
    largest = spatial.join_largest(parcels, tiles, 7.0, ["parcel_id"], limit=limit).collect()
    assert [(r["geo_unit"], round(r["overlap_m2"], 9)) for r in largest] == [("u", 25.0)] * 3
    assert spatial.join_intersects(parcels, tiles, 7.0, ["parcel_id"], limit=limit).count() == 3


def test_sliver_counts(spark):
    parcels = features(spark, "parcel_id", [("in", [[(0, 0), (5, 0), (5, 5), (0, 5)]]), ("out", [[(-5, 0), (0, 0), (0, 5), (-5, 5)]])])
    tiles = spatial.unit_tiles(features(spark, "geo_unit", [("u", [[(5 - 2e-8, 0), (9, 0), (9, 5), (5 - 2e-8, 5)]])]), 7.0)
    got = {r["parcel_id"]: r["geo_unit"] for r in spatial.join_largest(parcels, tiles, 7.0, ["parcel_id"]).collect()}
    assert got == {"in": "u", "out": None}


def test_tiles_add_up_to_the_unit(stars):
    _, units = stars
    tiles = spatial.unit_tiles(units, 6.0)
    sums = tiles.groupBy("geo_unit").agg(F.sum(F.expr(G.edges_area("tile"))).alias("t"))
    for r in units.select("geo_unit", F.expr(G.polygon_area("rings")).alias("a")).join(sums, "geo_unit").collect():
        assert r["t"] == pytest.approx(r["a"], rel=1e-9)


def test_overlaps_of_a_tiling_fill_the_parcel(spark, stars):
    parcels, _ = stars
    units = features(spark, "geo_unit", [(f"{i}-{j}", [box(i * 17, j * 17, i * 17 + 17, j * 17 + 17)]) for i in range(-2, 6) for j in range(-2, 6)])
    tiles = spatial.unit_tiles(units, 10.0)
    sums = spatial.overlaps(parcels, tiles, 10.0, ["parcel_id"]).groupBy("parcel_id").agg(F.sum("overlap_m2").alias("s"))
    for r in parcels.select("parcel_id", F.expr(G.polygon_area("rings")).alias("a")).join(sums, "parcel_id").collect():
        assert r["s"] == pytest.approx(r["a"], rel=1e-9)


def test_ties_missing_and_holes(spark):
    units = features(
        spark,
        "geo_unit",
        [("a", [box(0, 0, 10, 10), box(4, 4, 6, 6)[::-1]]), ("b", [box(10, 0, 20, 10)]), ("c", [box(4, 4, 6, 6)])],
    )
    parcels = features(
        spark,
        "parcel_id",
        [
            ("tie", [box(9, 1, 11, 2)]),
            ("out", [box(50, 50, 51, 51)]),
            ("hole", [box(4.5, 4.5, 5.5, 5.5)]),
            ("touch", [box(20, 0, 21, 1)]),
            ("bow", [[(8, 2), (14, 4), (14, 2), (8, 4)]]),
            ("none", []),
        ],
    )
    tiles = spatial.unit_tiles(units, 5.0, contact=True)
    got = {r["parcel_id"]: r for r in spatial.join_largest(parcels, tiles, 5.0, ["parcel_id"]).collect()}
    assert {k: r["geo_unit"] for k, r in got.items()} == {"tie": "a", "out": None, "hole": "c", "touch": None, "bow": "b", "none": None}
    touching = {}
    for r in spatial.join_intersects(parcels, tiles, 5.0, ["parcel_id"]).collect():
        touching.setdefault(r["parcel_id"], set()).add(r["geo_unit"])
    assert touching == {"tie": {"a", "b"}, "out": {None}, "hole": {"c"}, "touch": {"b"}, "bow": {"a", "b"}, "none": {None}}
    pairs = spatial.join_intersects(parcels, tiles, 5.0, ["parcel_id"])
    more = units.unionByName(features(spark, "geo_unit", [("far", [box(900, 900, 901, 901)])]))
    first = spatial.units_with_parcels(pairs, more)
    assert first.filter("parcel_id IS NULL").select("geo_unit").collect()[0][0] == "far"
    assert first.filter("geo_unit IS NULL").count() == 0


def test_candidates_once_each(stars):
    parcels, units = stars
    boxes = parcels.select("parcel_id", F.expr(G.bbox("rings")).alias("p")).crossJoin(units.select("geo_unit", F.expr(G.bbox("rings")).alias("u")))
    want = boxes.filter("p.xmin <= u.xmax AND u.xmin <= p.xmax AND p.ymin <= u.ymax AND u.ymin <= p.ymax")
    for size in (4.0, 50.0):
        for limit in (skew.BROADCAST_BYTES, -1):
            got = spatial.candidate_pairs(parcels, units, size, "parcel_id", "geo_unit", limit)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("parcel_id", "geo_unit").collect()))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_with_a_hot_key(spark, how):
    left = spark.range(9000).selectExpr("id", "IF(id % 3 = 0, 7, IF(id % 3 = 1, CAST(NULL AS INT), CAST(id % 50 AS INT))) AS k")
    right = spark.range(30).selectExpr("CAST(id AS INT) AS k", "id * 10 AS v").union(spark.sql("SELECT 7, 71L"))
    got = skew.salted_join(left, right, ["k"], ["id"], how, shares=8)
    want = left.join(right, "k", how)
    assert got.select("id", "k", "v").exceptAll(want.select("id", "k", "v")).count() == 0
    assert want.select("id", "k", "v").exceptAll(got.select("id", "k", "v")).count() == 0


def test_salted_join_spreads_the_hot_key(spark):
    left = spark.range(8000).selectExpr("id", "IF(id % 2 = 0, 1, id) AS k")
    right = spark.range(2).selectExpr("id AS k", "id AS v")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.salted_join(left, right, ["k"], ["id"], "left", shares=100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 8000 and max(sizes) < 4000


@pytest.mark.parametrize("limit", [skew.BROADCAST_BYTES, -1])
def test_plans_have_no_nested_loops(stars, limit):
    parcels, units = stars
    tiles = spatial.unit_tiles(units, 10.0, contact=True)
    for df in (
        spatial.join_largest(parcels, tiles, 10.0, ["parcel_id"], limit=limit),
        spatial.join_intersects(parcels, tiles, 10.0, ["parcel_id"], limit=limit),
        spatial.candidate_pairs(parcels, units, 10.0, "parcel_id", "geo_unit", limit),
    ):
        plan = executed_plan(df)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_geometry_does_not_cross_the_parcel_shuffle(stars):
    parcels, units = stars
    tiles = spatial.unit_tiles(units, 10.0)
    plan = spatial.join_largest(parcels, tiles, 10.0, ["parcel_id"])._jdf.queryExecution().optimizedPlan().toString()
    shuffle = next(i for i, line in enumerate(plan.splitlines()) if "RepartitionByExpression" in line)
    moved = plan.splitlines()[shuffle + 1]
    assert "overlap" not in moved and moved.count(" AS ") <= 2


def test_suggested_cell_size(spark):
    units = features(spark, "geo_unit", [("a", [box(0, 0, 10, 4)]), ("b", [box(0, 0, 20, 4)]), ("c", [box(0, 0, 30, 4)])])
    assert spatial.suggest_cell_size(units) == 10.0
