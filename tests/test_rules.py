"""Hand-computed tables for the NULL, tie and text rules."""

import math

import pytest
from pyspark.sql import functions as F

from cropmosaic.functions.aggregates import distinct_with_null, lenient_sum, strict_max, strict_sum
from cropmosaic.functions.text import clean_number, first_of, strip_leading_zero, strip_trailing_newline, strip_unit
from cropmosaic.operators import analysis, communes, prepare, quality
from cropmosaic.schemas import region_dim

PREPARED = (
    "geo_unit string, CODE_GROUP string, cult_label string, data_type string, region string, name string, year int, "
    "surf_tot_geo_unit_m2 double, surf_agri_geo_unit_m2 double, surf_cult_m2 double, surf_cult_perc double, "
    "parcel_cult_n bigint, parcel_cult_perc double, region_code string"
)


def prepared_row(unit, crop, region, agri, area, n, year=2010):
    return (unit, crop, f"L{crop}", "ia", region, f"N{unit}", year, 1e6, agri, area, area / agri, n, 0.5, region)


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_sums_and_max(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("b", None), ("c", 2.0), ("c", 3.0)], "k string, x double")
    got = {
        r["k"]: r[1:]
        for r in df.groupBy("k")
        .agg(strict_sum(F.col("x")), lenient_sum(F.col("x")), strict_max(F.col("x")), distinct_with_null(F.col("x")))
        .collect()
    }
    assert got["a"] == (None, 1.0, None, 2)
    assert got["b"] == (None, 0.0, None, 1)
    assert got["c"] == (5.0, 5.0, 3.0, 2)


def test_codes(spark):
    got = [r[0] for r in texts(spark, ["01", "1", "10", "005", "0", None]).select(strip_leading_zero(F.col("t"))).collect()]
    assert got == ["1", "1", "10", "05", "", None]


def test_numbers(spark):
    df = texts(spark, ["0.25 [1]", "1.2e-05 [1]", ".", "abc", None])
    assert [r[0] for r in df.select(clean_number(F.col("t"))).collect()] == [0.25, 1.2, None, None, None]
    df = texts(spark, ["0.25 [1]", "1.2e-05 [m^2]", "abc", None])
    assert [r[0] for r in df.select(strip_unit(F.col("t"))).collect()] == [0.25, 1.2e-05, None, None]


def test_url_parts(spark):
    df = texts(spark, ["x/R27-2015_R84.7z\n", "x/none\n\n"])
    rows = df.select(first_of(F.col("t"), ["R84", "R27"]), strip_trailing_newline(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [("R27", "x/R27-2015_R84.7z"), (None, "x/none\n")]


@pytest.mark.parametrize(
    "values, shannon, simpson",
    [
        ([5.0], 0.0, 0.0),
        ([2.0, 2.0, 2.0, 2.0], math.log(4), 0.75),
        ([1.0, 1.0, 0.0], math.log(2), 0.5),
        ([0.0, 0.0], 0.0, 1.0),
        ([1.0, None], None, None),
    ],
)
def test_diversity(spark, values, shannon, simpson):
    df = spark.createDataFrame([(1, v) for v in values], "k int, x double")
    row = analysis.diversity(df, ["k"], "x").first()
    for got, want in ((row[1], shannon), (row[2], simpson)):
        assert got == want if want is None else got == pytest.approx(want, abs=1e-12)


def test_diversity_rejects_negative(spark):
    df = spark.createDataFrame([(1, -1.0)], "k int, x double")
    with pytest.raises(Exception, match="non-negative"):
        analysis.diversity(df, ["k"], "x").collect()


def test_diversity_bounds(spark):
    df = spark.range(2000).selectExpr("id % 50 AS k", "CAST(pmod(hash(id), 100) AS DOUBLE) AS x", "CAST(id AS STRING) AS label")
    rows = analysis.diversity(df, ["k"], "x").join(analysis.crop_richness(df, ["k"], "label"), "k").collect()
    for r in rows:
        assert 0 <= r["shannon_diversity"] <= math.log(r["crops"]) + 1e-12
        assert 0 <= r["simpson_diversity"] < 1


def test_border_unequal_totals(spark):
    rows = [
        prepared_row("u", "1", "A", 100.0, 60.0, 6),
        prepared_row("u", "2", "A", 100.0, 40.0, 4),
        prepared_row("u", "1", "B", 30.0, 20.0, 2),
        prepared_row("u", "3", "B", 30.0, 10.0, 1),
    ]
    df = spark.createDataFrame(rows, PREPARED)
    got = {r["CODE_GROUP"]: r for r in communes.merge_border_communes(df).collect()}
    assert set(got) == {"1", "2"}  # crop 3, on the smaller side only, is lost
    assert got["1"]["surf_cult_m2"] == 80.0 and got["1"]["surf_agri_geo_unit_m2"] == 120.0
    assert got["1"]["surf_cult_perc"] == pytest.approx(80 / 120)
    assert got["1"]["N_Parcels"] == 12 and got["1"]["max_agri"] == 100.0
    full = {r["CODE_GROUP"]: r for r in communes.merge_border_communes(df, "complete").collect()}
    assert set(full) == {"1", "2", "3"}
    assert full["3"]["region"] == "B" and full["1"]["region"] == "A"
    assert sum(r["surf_cult_perc"] for r in full.values()) == pytest.approx(1)


def test_border_equal_totals(spark):
    rows = [prepared_row("u", "1", "A", 50.0, 50.0, 5), prepared_row("u", "1", "B", 50.0, 50.0, 5)]
    df = spark.createDataFrame(rows, PREPARED)
    assert communes.merge_border_communes(df).count() == 2  # both sides stay
    assert communes.merge_border_communes(df, "complete").first()["surf_cult_perc"] == 1.0


def test_border_unknown_total_drops_the_commune(spark):
    rows = [prepared_row("u", "1", "A", 50.0, 50.0, 5)]
    df = spark.createDataFrame(rows, PREPARED).withColumn("surf_agri_geo_unit_m2", F.lit(None).cast("double"))
    assert communes.merge_border_communes(df).count() == 0


def test_border_has_one_shuffle(spark):
    from conftest import executed_plan

    df = spark.createDataFrame([prepared_row("u", "1", "A", 50.0, 50.0, 5)], PREPARED)
    assert executed_plan(communes.merge_border_communes(df)).count("Exchange") == 1


def test_commune_crop_keeps_parcels_outside_and_null_areas(spark):
    assigned = spark.createDataFrame(
        [
            (2010, "R84", "ia", "u", "1", 10.0),
            (2010, "R84", "ia", "u", "1", None),
            (2010, "R84", "ia", "u", "2", 30.0),
            (2010, "R84", "ia", None, "1", 5.0),
        ],
        "year int, region_code string, data_type string, geo_unit string, CODE_GROUP string, area_m2 double",
    )
    units = spark.createDataFrame([("u", "Town", 2.0)], "geo_unit string, nom string, surf_ha double")
    labels = spark.createDataFrame([("1", "Wheat"), ("2", "Maize")], "CODE_GROUP string, cult_label string")
    rows = {(r["geo_unit"], r["CODE_GROUP"]): r for r in communes.commune_crop(assigned, units, labels, region_dim(spark)).collect()}
    assert len(rows) == 3
    one = rows["u", "1"]
    assert one["surf_cult_m2"] == 10.0 and one["surf_agri_geo_unit_m2"] is None and one["surf_cult_perc"] is None
    assert one["parcel_cult_n"] == 2 and one["parcel_cult_perc"] == pytest.approx(2 / 3)
    assert one["surf_tot_geo_unit_m2"] == 20000.0 and one["name"] == "Town"
    assert rows[None, "1"]["surf_cult_perc"] == 1.0 and rows[None, "1"]["name"] is None


def test_split_by_layout_does_not_matter(spark):
    square = "array(array(struct(0D AS x, 0D AS y), struct(2D AS x, 0D AS y), struct(2D AS x, 2D AS y), struct(0D AS x, 2D AS y)))"
    base = spark.range(20).selectExpr("CAST(id AS STRING) AS pid", "lpad(CAST(id % 3 + 1 AS STRING), 2, '0') AS code", f"{square} AS rings")
    at = dict(region_code=F.lit("R84"), year=F.lit(2010))
    pg = prepare.normalize_parcels(base.selectExpr("pid AS ID_PARCEL", "code AS CODE_GROUP", "rings"), "pg", **at)
    ia = prepare.normalize_parcels(base.selectExpr("pid AS ID_ILOT", "code AS CODE_CULTU", "rings"), "ia", **at)
    same = ["parcel_id", "CODE_GROUP", "region_code", "year", "area_m2"]
    assert sorted(pg.select(same).collect()) == sorted(ia.select(same).collect())
    assert pg.filter("area_m2 != 4").count() == 0


@pytest.mark.parametrize("keys", [["name"], ["name", "geo_unit"]])
def test_top_crop_keeps_ties_and_skips_missing(spark, keys):
    rows = [("a", "u", "x", 0.5), ("a", "u", "y", 0.5), ("a", "u", "z", 0.1), ("b", "v", "x", None), (None, "w", "x", 0.2)]
    df = spark.createDataFrame(rows, "name string, geo_unit string, cult_label string, surf_cult_perc double")
    df = df.unionByName(df.limit(1).withColumn("surf_cult_perc", F.lit(float("nan"))))
    got = sorted((r["name"] or "", r["cult_label"]) for r in analysis.top_crop(df, keys).collect())
    assert got == [("", "x"), ("a", "x"), ("a", "y")]


def test_top_crop_of_a_hot_name_equals_the_window(spark):
    df = spark.range(30000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('n', id % 500)) AS name", "id AS geo_unit", "pmod(hash(id), 400) / 7 AS surf_cult_perc"
    )
    from pyspark.sql import Window

    w = Window.partitionBy("name")
    want = df.withColumn("m", F.max("surf_cult_perc").over(w)).filter("m = surf_cult_perc").drop("m")
    got = analysis.top_crop(df, ["name"])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_national_denominators(spark):
    rows = [prepared_row("u", "1", "A", 100.0, 60.0, 6), prepared_row("u", "2", "A", 100.0, 40.0, 4)]
    compiled = communes.merge_border_communes(spark.createDataFrame(rows, PREPARED))
    by_rows = analysis.national_crop_share(compiled, 2010)
    by_unit = analysis.national_crop_share(compiled, 2010, "geo_unit")
    assert by_rows.agg(F.sum("surf_cult_perc")).first()[0] == pytest.approx(50)
    assert by_unit.agg(F.sum("surf_cult_perc")).first()[0] == pytest.approx(100)
    assert analysis.national_crop_share(compiled, 1900).count() == 0


def test_department_rows_without_parcels(spark):
    joined = spark.createDataFrame(
        [("d", "1", 2.0, "p"), ("d", "2", 6.0, "q"), ("e", None, None, None)],
        "geo_unit string, CODE_GROUP string, surf_parc_ha double, parcel_id string",
    )
    by_parcels = {r["geo_unit"]: r for r in communes.department_crop(joined).filter("CODE_GROUP IS NULL OR CODE_GROUP = '1'").collect()}
    assert by_parcels["d"]["surf_perc"] == 0.25 and by_parcels["e"]["n_parcels"] == 0
    by_rows = {r["geo_unit"]: r for r in communes.department_crop(joined, mode="rows").collect()}
    assert by_rows["e"]["n_parcels"] == 1


def test_value_counts_skips_null(spark):
    got = quality.value_counts(texts(spark, ["b", "a", None, "a"]), "t").collect()
    assert [tuple(r) for r in got] == [("a", 2), ("b", 1)]


def test_richness_sketches(spark):
    """Merged sketches against exact counts: small groups exact, large ones within four standard errors."""
    rows = spark.range(200_000).selectExpr("id % 40 AS unit", "id % 4 AS region", "IF(id % 997 = 0, NULL, CAST(pmod(xxhash64(id), 50000) AS STRING)) AS cult_label")
    few = spark.range(100).selectExpr("id % 5 + 100 AS unit", "9 AS region", "CAST(id % 20 AS STRING) AS cult_label")
    blank = spark.sql("SELECT 200L AS unit, 10L AS region, CAST(NULL AS STRING) AS cult_label")
    df = rows.unionByName(few).unionByName(blank)
    kept = analysis.richness_sketch(df, ["unit", "region"])
    got = {r["region"]: r["crops"] for r in analysis.estimated_richness(analysis.merge_richness(kept, ["region"])).collect()}
    want = {r["region"]: r["crops"] for r in analysis.crop_richness(df, ["region"]).collect()}
    assert got[9] == want[9] == 20 and got[10] == want[10] == 1
    assert all(abs(got[g] / want[g] - 1) < 4 * 1.04 / 2 ** (analysis.SKETCH_BITS / 2) for g in range(4))
    whole = analysis.estimated_richness(analysis.richness_sketch(df, ["region"]))
    assert {r["region"]: r["crops"] for r in whole.collect()} == got
