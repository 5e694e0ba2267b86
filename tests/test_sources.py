"""Readers, writers, sampling and the whole job on generated files."""

import os
import struct
import time

import numpy as np
import pytest
from conftest import executed_plan
from pyspark.sql import functions as F
from test_geometry import box
from test_spatial import features

from cropmosaic import session
from cropmosaic.functions import geometry as G
from cropmosaic.operators import prepare, sampling
from cropmosaic.plans import build
from cropmosaic.plans.catalog import QUERIES
from cropmosaic.sinks import tables
from cropmosaic.sources import layers, links
from cropmosaic.sources.shapefile import cut_records, read_shapefiles, short_names
from cropmosaic.sources.tables import load_prepared, read_catch_crops, read_crop_groups, stack
from cropmosaic.sources.wkb import with_rings


def test_shapefile_keeps_geometry_and_attributes(spark, tmp_path):
    df = features(spark, "name", [("é1", [box(0, 0, 4, 3), box(1, 1, 2, 2)[::-1]]), ("two", [box(0, 0, 1, 1), box(3, 3, 4, 4)]), (None, [])])
    df = df.select("name", F.lit(7).cast("bigint").alias("a_long_column_name"), F.lit(0.1).alias("a_long_column_value"), "rings")
    tables.write_features(df.coalesce(1), str(tmp_path / "out"), srid="4326", layer="towns")
    back = read_shapefiles(spark, str(tmp_path / "out"), recordsPerPartition="2", recordsPerBatch="1").orderBy("record")
    assert back.columns == ["name", "a_long_col", "a_long_co1", "rings", "srid", "source_path", "record"]
    rows = back.collect()
    assert [r["name"] for r in rows] == ["é1", "two", None]
    assert [len(r["rings"]) if r["rings"] else None for r in rows] == [2, 2, None]
    assert rows[0]["a_long_col"] == 7 and rows[0]["a_long_co1"] == 0.1 and rows[0]["srid"] == 4326
    assert back.selectExpr("sum(size(rings[0]))").first()[0] == 10
    assert read_shapefiles(spark, str(tmp_path / "out"), recordsPerPartition="1").rdd.getNumPartitions() == 3


def test_shapefile_overwrite_replaces_and_append_adds(spark, tmp_path):
    df = features(spark, "name", [("a", [box(0, 0, 1, 1)])])
    for _ in range(2):
        tables.write_features(df, str(tmp_path / "out"))
    assert read_shapefiles(spark, str(tmp_path / "out")).count() == 1
    df.write.format("shapefile").mode("append").save(str(tmp_path / "out"))
    assert read_shapefiles(spark, str(tmp_path / "out")).count() == 2
    assert not [f for f in os.listdir(tmp_path / "out") if f.startswith("_")]


def test_shapefile_splits_large_parts(spark, tmp_path):
    df = features(spark, "name", [(str(i), [box(0, 0, 1, 1)]) for i in range(50)]).coalesce(1)
    tables.write_features(df, str(tmp_path / "out"), maxFileBytes="1000")
    assert len(os.listdir(tmp_path / "out")) > 3
    assert read_shapefiles(spark, str(tmp_path / "out")).select("name").distinct().count() == 50


def test_shapefile_rejects_long_text(spark, tmp_path):
    df = features(spark, "name", [("x" * 90, [box(0, 0, 1, 1)])])
    with pytest.raises(Exception, match="stringWidth"):
        tables.write_features(df, str(tmp_path / "out"))
    tables.write_features(df, str(tmp_path / "wide"), stringWidth="100")


def test_requested_columns_missing_in_the_file_are_null(spark, tmp_path):
    df = features(spark, "ID_ILOT", [("i1", [box(0, 0, 1, 1)])])
    tables.write_features(df, str(tmp_path / "out"))
    row = read_shapefiles(spark, str(tmp_path / "out"), "ia").first()
    assert row["NUM_ILOT"] is None and row["ID_ILOT"] == "i1" and row["srid"] == 2154


def test_short_names():
    assert short_names(["surf_cult_m2", "surf_cult_perc", "x"]) == ["surf_cult_", "surf_cult1", "x"]


def test_wkb(spark, tmp_path):
    df = features(spark, "name", [("a", [box(0, 0, 4, 3), box(1, 1, 2, 2), box(8, 8, 9, 9)])])
    tables.write_features(df, str(tmp_path / "out"), "wkb")
    data = bytes(spark.read.parquet(str(tmp_path / "out")).first()["wkb"])
    assert struct.unpack_from("<BII", data) == (1, 6, 2)
    assert struct.unpack_from("<BII", data, 9) == (1, 3, 2)
    assert struct.unpack_from("<I2d", data, 18) == (5, 0.0, 0.0)


def test_wkb_read_back(spark, tmp_path):
    rows = [("a", [box(0, 0, 4, 3), box(1, 1, 2, 2), box(8, 8, 9, 9)]), ("b", []), ("c", [box(0, 0, 1, 1)])]
    df = features(spark, "name", rows)
    df = df.unionByName(df.limit(1).select(F.lit("n").alias("name"), F.lit(None).cast(G.RINGS_TYPE).alias("rings")))
    tables.write_features(df, str(tmp_path / "out"), "wkb")
    back = with_rings(spark.read.parquet(str(tmp_path / "out"))).withColumn("a", F.expr(G.signed_area("rings")))
    got = {r["name"]: (r["a"], None if r["rings"] is None else len(r["rings"])) for r in back.collect()}
    assert got["a"] == (12.0, 3) and got["c"] == (1.0, 1) and not got["b"][1] and not got["n"][1]


def test_wkb_of_other_writers(spark):
    ring = [(0.0, 0.0, 7.0), (2.0, 0.0, 7.0), (0.0, 2.0, 7.0), (0.0, 0.0, 7.0)]
    big = struct.pack(">BIII", 0, 3, 1, 4) + b"".join(struct.pack(">2d", *p[:2]) for p in ring)
    iso_z = struct.pack("<BIII", 1, 1003, 1, 4) + b"".join(struct.pack("<3d", *p) for p in ring)
    flagged_z = struct.pack("<BIII", 1, 0x80000003, 1, 4) + b"".join(struct.pack("<3d", *p) for p in ring)
    df = spark.createDataFrame([(i, bytearray(w)) for i, w in enumerate((big, iso_z, flagged_z))], "i int, wkb binary")
    assert [r[0] for r in with_rings(df).select(F.expr(G.signed_area("rings"))).collect()] == [2.0] * 3
    point = spark.createDataFrame([(bytearray(struct.pack("<BI2d", 1, 1, 0, 0)),)], "wkb binary")
    with pytest.raises(Exception, match="no polygon"):
        with_rings(point).collect()


def test_pick_layer(spark, tmp_path):
    for name in (
        "delivery_R84_2015/b/PARCELLES_GRAPHIQUES.shp",
        "delivery_R84_2015/c/PARCELLES_GRAPHIQUES.shp",
        "delivery_R84_2015/a/ILOTS_ANONYMES.shp",
        "delivery_R27_2010/x/ILOTS_ANONYMES.shp",
        "delivery_R11_2010/x/OTHER.shp",
    ):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x")
    chosen = {(r["region_code"], r["year"]): r for r in layers.pick_layer(layers.list_layers(spark, str(tmp_path))).collect()}
    assert set(chosen) == {("R84", 2015), ("R27", 2010)}
    assert chosen["R84", 2015]["kind"] == "pg" and "/b/" in chosen["R84", 2015]["path"]
    assert chosen["R27", 2010]["kind"] == "ia"


def test_links_after_a_stray_end(spark):
    pages = [(1, "</ul><ul><li><a href='/1'>1</a></ul>"), (2, "</ul></ul><ul><a href=/2>2</a></ul></ul><ul><a href='/3'>3</a></ul>"), (1, "<ul><a href='/1'>again</a></ul>")]
    got = links.extract_links(spark.createDataFrame(pages, "page_id int, html string")).collect()
    assert sorted(map(tuple, got)) == [(1, "/1"), (1, "/1"), (2, "/2"), (2, "/3")]


def test_delivery_of_many_files(spark):
    names = ["d_R84_2015/part-1/PARCELLES_GRAPHIQUES.shp", "d_R84_2015/part-0/PARCELLES_GRAPHIQUES.shp", "d_R84_2015/ILOTS_ANONYMES.shp", "d_R27_2010/ILOTS_ANONYMES.shp"]
    paths = spark.createDataFrame([(n,) for n in names], "path string")
    assert {r["path"] for r in layers.pick_layer(paths).collect()} == {names[0], names[1], names[3]}
    assert {r["path"] for r in layers.pick_layer(paths, files="first").collect()} == {names[1], names[3]}


def test_sample_of_repeated_ids(spark):
    rows = spark.range(1000).selectExpr("id % 100 AS id", "cast(id div 100 AS int) AS year")
    got = sampling.sample_rows(rows, ["id", "year"], fraction=0.1)
    assert got.count() == 100 and got.select("id").distinct().count() > 40
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, sampling.sample_rows(rows.repartition(5), ["id", "year"], fraction=0.1).collect()))


def test_catalog_order_and_codes(spark):
    grid = spark.createDataFrame([("Somewhere", "R99", 2015)], "region_name string, region_code string, year int")
    found = spark.createDataFrame([("a_R99_x",), ("b_R99_2015",), ("c_R84_2015",)], "url string")
    assert [(r["year"], r["region_name"]) for r in links.link_catalog(found, grid).collect()] == [(2015, "Somewhere"), (None, None)]


def test_links_inside_lists_only(spark):
    html = (
        "<a href='/out'>o</a><UL class=x><li><a class=\"y\" href=\"/it's?a=1&amp;b=2\">1</a>"
        "<ul><li><a href='/2'>2</a></ul><li><a href=/bare>3</a><li><a name=n>4</a><a\nhref = \"/5\">5</a></UL><a href='/end'>e</a>"
    )
    df = spark.createDataFrame([(1, html), (2, None)], "page_id int, html string")
    assert [r["url"] for r in links.extract_links(df).collect()] == ["/it's?a=1&b=2", "/2", "/bare", "/5"]
    assert links.extract_links(df, r"(?s)(<ul><li>.*?</ul>)").first()["url"] == "/2"


def test_links_need_no_exchange(spark):
    df = spark.createDataFrame([(1, "<ul><a href='/1'></ul>")], "page_id int, html string")
    assert "Exchange" not in executed_plan(links.extract_links(df))


def test_a_page_of_100_000_links(spark):
    """Lists opened and closed all the way, stray ends among them, against a plain count."""
    rng = np.random.default_rng(5)
    tags = rng.choice(["<ul>", "</ul>", "<a href='/x'>", "<A HREF=y>", "<a name=z>"], 200_000, p=[0.2, 0.22, 0.3, 0.2, 0.08])
    depth, want = 0, 0
    for t in tags:
        depth = max(0, depth + (t == "<ul>") - (t == "</ul>"))
        want += depth > 0 and "name" not in t and t[1] in "aA"
    df = spark.createDataFrame([(1, "".join(tags)), (2, ""), (3, None), (4, "no tag"), (5, "<a href=/out>")], "page_id int, html string")
    start = time.time()
    assert links.extract_links(df).groupBy("page_id").count().collect() == [(1, want)] and want > 10_000
    assert time.time() - start < 60


def test_code_tables(spark, tmp_path):
    groups = tmp_path / "groups.csv"
    groups.write_text("CODE_CULTURE;LIBELLE_CULTURE;CODE_GROUPE_CULTURE;LIBELLE_GROUPE_CULTURE\nBTH;Blé tendre d’hiver;1;Blé tendre\n", "utf-8")
    assert tuple(read_crop_groups(spark, str(groups)).first()) == ("BTH", "Blé tendre d’hiver", 1, "Blé tendre")
    catch = tmp_path / "catch.csv"
    catch.write_text("CODE_CULTURE_DEROBEE;LIBELLE_CULTURE_DEROBEE\nDRG;Ray-grass\n", "utf-8")
    assert tuple(read_catch_crops(spark, str(catch)).first()) == ("DRG", "Ray-grass")


def test_prepared_replaces_only_its_own_folders(spark, tmp_path):
    root = str(tmp_path / "prepared")
    df = spark.createDataFrame([(2010, "A", 1), (2010, "B", 2), (2011, "A", 3)], "year int, region_code string, v int")
    tables.write_prepared(df, root)
    tables.write_prepared(df.filter("v = 2").withColumn("v", F.lit(20)), root)
    back = load_prepared(spark, root)
    assert sorted(r["v"] for r in back.collect()) == [1, 3, 20]
    assert "PartitionFilters: [isnotnull(year" in back.filter("year = 2011")._jdf.queryExecution().executedPlan().toString()
    assert stack([df, df.select("v", "year", "region_code")]).count() == 6


class _Session:
    """A session as far as shared_folder looks at it."""

    def __init__(self, master, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master

    def getConf(self):
        return self.conf


def test_shared_folder_follows_the_session():
    assert session.shared_folder(_Session("spark://host", "hdfs:///work/")).startswith("hdfs:///work/cropmosaic-")
    assert session.shared_folder(_Session("local[2]", None)).startswith("/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(_Session("spark://host", None))


@pytest.mark.parametrize("n", [0, 5, 137, 400, 1000, 5000])
def test_samples_cut_by_histogram_equal_the_sorted_ones(spark, monkeypatch, n):
    df = spark.range(1000).withColumn("id", F.col("id").cast("string"))
    want = sorted(r["id"] for r in sampling.sample_rows(df, "id", n=n).collect())
    monkeypatch.setattr(sampling, "TOP_K", 3)
    monkeypatch.setattr(sampling, "PREFIX", 1)
    got = sorted(r["id"] for r in sampling.sample_rows(df, "id", n=n).collect())
    assert got == want and len(got) == min(n, 1000)


def test_sample_sizes_round_half_to_even(spark):
    for rows, size in ((25, 2), (35, 4), (40, 4)):
        assert sampling.sample_rows(spark.range(rows), "id", fraction=0.1).count() == size


def test_whole_job(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    lonlat = [[(2.99, 46.49), (3.01, 46.49), (3.01, 46.51), (2.99, 46.51)]]
    east = [[(3.01, 46.49), (3.03, 46.49), (3.03, 46.51), (3.01, 46.51)]]
    towns = features(spark, "insee", [("01001", lonlat), ("01002", east)])
    towns = towns.select("insee", F.concat(F.lit("Town "), "insee").alias("nom"), F.lit(300.0).alias("surf_ha"), "rings")
    tables.write_features(towns, f"{raw}/towns", srid="4326")
    groups = tmp_path / "groups.csv"
    groups.write_text("CODE_CULTURE;LIBELLE_CULTURE;CODE_GROUPE_CULTURE;LIBELLE_GROUPE_CULTURE\nBTH;x;1;Blé tendre\nMID;y;2;Maïs\n", "utf-8")

    def field(x, y):
        return [box(700000 + x, 6600000 + y, 700000 + x + 10, 6600000 + y + 10)]

    pg = features(spark, "ID_PARCEL", [("1", field(0, 0)), ("2", field(50, 0)), ("3", field(2000, 0)), ("4", field(90000, 0))])
    pg = pg.select("ID_PARCEL", F.lit("01").alias("CODE_GROUP"), F.lit(0.01).alias("SURF_PARC"), "rings")
    ia = features(spark, "NUM_ILOT", [("9", field(0, 20))]).select("NUM_ILOT", F.lit("2").alias("CODE_CULTU"), "rings")
    tables.write_features(pg, f"{raw}/deliveries/delivery_R84_2015", layer="PARCELLES_GRAPHIQUES")
    tables.write_features(ia.coalesce(1), f"{raw}/deliveries/delivery_R84_2010", layer="ILOTS_ANONYMES")
    assert len(list((tmp_path / "raw/deliveries/delivery_R84_2015").rglob("*.shp"))) > 1

    prepared = build.prepare_deliveries(spark, f"{raw}/deliveries", f"{raw}/towns", str(groups), out)
    got = {(r["year"], r["geo_unit"]): r for r in prepared.collect()}
    assert set(got) == {(2015, "01001"), (2015, "01002"), (2015, None), (2010, "01001")}
    town = got[2015, "01001"]
    assert town["parcel_cult_n"] == 2 and town["surf_cult_m2"] == pytest.approx(200) and town["cult_label"] == "Blé tendre"
    assert town["region"] == "Auvergne-Rhône-Alpes" and town["name"] == "Town 01001" and town["data_type"] == "pg"
    compiled = build.compile_table(spark, out)
    assert compiled.count() == 4 and {"max_agri", "N_Parcels"} <= set(compiled.columns)


def test_columns_of_all_files_and_ranges_by_bytes(spark, tmp_path):
    rings = F.expr("array(array(struct(0D AS x, 0D AS y), struct(1D AS x, 0D AS y), struct(1D AS x, 1D AS y), struct(0D AS x, 0D AS y)))")
    for name, extra in (("a", F.col("id").alias("n")), ("b", F.concat(F.lit("t"), "id").alias("n")), ("c", (F.col("id") / 4).alias("late"))):
        frame = spark.range(40).select(extra, rings.alias("rings")).coalesce(1)
        tables.write_features(frame, str(tmp_path / name))
    all_ = read_shapefiles(spark, str(tmp_path))
    assert {c: t for c, t in all_.dtypes if c in ("n", "late")} == {"n": "string", "late": "double"}
    assert all_.filter("n IS NOT NULL").count() == 80 and all_.agg(F.sum("late")).first()[0] == 195.0
    assert read_shapefiles(spark, str(tmp_path / "a"), bytesPerPartition=1000).rdd.getNumPartitions() > 4


def test_ranges_follow_the_index(spark, tmp_path):
    """One heavy record among light ones: no range holds more than twice the bytes, unless it is that record alone."""
    light = spark.range(5000).select(F.col("id"), F.expr("array(array(struct(0D AS x, 0D AS y), struct(1D AS x, 0D AS y), struct(1D AS x, 1D AS y)))").alias("rings"))
    heavy = F.expr("array(transform(sequence(1, 20000), i -> struct(cos(i / 3183.0988) AS x, sin(i / 3183.0988) AS y)))")
    df = light.withColumn("rings", F.when(F.col("id") == 2500, heavy).otherwise(F.col("rings"))).coalesce(1)
    tables.write_features(df, str(tmp_path / "out"))
    path = str(next((tmp_path / "out").rglob("*.shp")))
    cuts = cut_records(path, task_bytes=40_000)
    assert cuts[0] == 0 and cuts[-1] == 5000 and cuts == sorted(set(cuts))
    with open(path[:-4] + ".shx", "rb") as f:
        lengths = [2 * n + 8 for n in struct.unpack(">10000i", f.read()[100:])[1::2]]
    sizes = [(sum(lengths[a:b]), b - a) for a, b in zip(cuts, cuts[1:])]
    assert all(size <= 40_000 or n == 1 for size, n in sizes) and sum(size > 40_000 for size, _ in sizes) == 1
    assert len(cuts) < 30
    back = read_shapefiles(spark, path, bytesPerPartition=40_000)
    assert back.count() == 5000 and back.rdd.getNumPartitions() == len(cuts) - 1
    assert cut_records(path, per_task=7)[:3] == [0, 7, 14]


def test_index_read_in_pieces(spark, tmp_path, monkeypatch):
    tables.write_features(spark.range(100).select("id", F.expr("array(array(struct(0D AS x, 0D AS y), struct(1D AS x, 0D AS y), struct(1D AS x, 1D AS y)))").alias("rings")).coalesce(1), str(tmp_path / "out"))
    path = str(next((tmp_path / "out").rglob("*.shp")))
    monkeypatch.setattr("cropmosaic.sources.shapefile.INDEX_ROWS", 30)
    assert cut_records(path) == [0, 30, 60, 90, 100]


def test_many_files_are_planned_by_a_job(spark, tmp_path):
    rings = F.expr("array(array(struct(0D AS x, 0D AS y), struct(1D AS x, 0D AS y), struct(1D AS x, 1D AS y)))")
    tables.write_features(spark.range(240, numPartitions=120).select("id", rings.alias("rings")), str(tmp_path / "out"))
    back = read_shapefiles(spark, str(tmp_path / "out"))
    assert back.select("source_path").distinct().count() == 120 and back.agg(F.sum("id")).first()[0] == 240 * 239 // 2
    assert read_shapefiles(spark, str(tmp_path / "out"), where={"id": ["7", "239"]}).count() == 2
    (tmp_path / "none").mkdir()
    assert read_shapefiles(spark, str(tmp_path / "none"), "pg").count() == 0


def test_unwanted_shapes_are_not_parsed(spark, tmp_path):
    """Every shape but the wanted one is spoilt; only a read of all of them fails."""
    df = features(spark, "code_insee", [(c, [box(0, 0, i + 1, 1)]) for i, c in enumerate(["01", "75", "2A", "33"])])
    tables.write_features(df.coalesce(1), str(tmp_path / "a"))
    tables.write_features(df.withColumnRenamed("code_insee", "insee_dep").coalesce(1), str(tmp_path / "b"))
    for path in list(tmp_path.rglob("*.shp")):
        content = bytearray(path.read_bytes())
        index = path.with_suffix(".shx").read_bytes()[100:]
        for k in (0, 2, 3):
            at = 2 * struct.unpack_from(">i", index, 8 * k)[0] + 8
            content[at : at + 4] = struct.pack("<i", 77)
        path.write_bytes(bytes(content))
    wanted = read_shapefiles(spark, str(tmp_path), "department", where={"code_insee|insee_dep": ["75", "95"]})
    units = prepare.normalize_departments(wanted.withColumn("srid", F.lit(2154)))
    assert [(r["geo_unit"], len(r["rings"][0])) for r in units.collect()] == [("75", 5)] * 2
    assert read_shapefiles(spark, str(tmp_path), "department", where={"absent": ["75"]}).count() == 0
    with pytest.raises(Exception, match="shape type 77"):
        read_shapefiles(spark, str(tmp_path), "department").select(F.size("rings")).collect()


@pytest.mark.parametrize("srid", [27572, None])
def test_parcels_of_an_unknown_system_are_an_error(spark, srid):
    df = features(spark, "ID_PARCEL", [("1", [box(0, 0, 1, 1)])])
    df = df.select("ID_PARCEL", F.lit("1").alias("CODE_GROUP"), F.lit(1.0).alias("SURF_PARC"), "rings", F.lit(srid).cast("int").alias("srid"))
    with pytest.raises(Exception, match="no transform"):
        prepare.normalize_parcels(df, "pg", F.lit("R84"), F.lit(2015)).collect()


def test_parcels_in_degrees_are_projected(spark):
    df = features(spark, "ID_PARCEL", [("1", [box(3.0, 46.5, 3.001, 46.501)])])
    df = df.select("ID_PARCEL", F.lit("1").alias("CODE_GROUP"), F.lit(1.0).alias("SURF_PARC"), "rings", F.lit(4326).alias("srid"))
    row = prepare.normalize_parcels(df, "pg", F.lit("R84"), F.lit(2015)).first()
    assert row["rings"][0][0]["x"] == pytest.approx(700000) and row["rings"][0][0]["y"] == pytest.approx(6600000)
    assert row["area_m2"] == pytest.approx(8517, rel=1e-3)


def test_links_of_the_whole_block(spark, tmp_path):
    def entries(names: str) -> str:
        return "".join(f'<li><a href="/{n}">{n}</a></li>' for n in names)

    html = f"<ul>{entries('x')}</ul><nav>\n<ul>{entries('abcde')}</ul></nav><ul>{entries('y')}</ul>"
    pages = [(1, html), (2, f"<nav><ul>{entries('fg')}</ul></nav>"), (3, f"<ul>{entries('z')}</ul>"), (4, None)]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = QUERIES["extract_links_of_block"](spark, str(tmp_path)).collect()
    assert sorted((r["page_id"], r["url"]) for r in found) == [(1, f"/{n}") for n in "abcde"] + [(2, f"/{n}") for n in "fg"]
