"""The registered queries: every operator over the test tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropmosaic.functions import geometry as G
from cropmosaic.functions.text import clean_number, strip_unit
from cropmosaic.operators import analysis, charts, communes, dissolve, prepare, quality, sampling, spatial
from cropmosaic.plans import build, staging
from cropmosaic.plans import surrogates as data
from cropmosaic.schemas import DEPARTMENTS_CORSE, DEPARTMENTS_ILE_DE_FRANCE, region_dim
from cropmosaic.session import shared_folder, stored
from cropmosaic.sinks import tables
from cropmosaic.sources import layers, links
from cropmosaic.sources.shapefile import read_shapefiles
from cropmosaic.sources.tables import load_prepared, read_crop_groups
from cropmosaic.sources.wkb import with_rings

CELL = data.CELL_SIZE
REPORT_YEAR = 1997
KEEP = ["data_type", "CODE_GROUP", "area_m2"]


# ---------------------------------------------------------------- shared steps


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    tiles = spatial.unit_tiles(data.communes(spark, sf), CELL)
    return spatial.join_largest(data.parcels(spark, sf), tiles, CELL, prepare.PARCEL_KEY, KEEP)


def commune_crop(spark: SparkSession, sf: str) -> DataFrame:
    return communes.commune_crop(
        _assigned(spark, sf), data.communes(spark, sf), data.labels(spark, sf), region_dim(spark)
    )


def compiled(spark: SparkSession, sf: str) -> DataFrame:
    return communes.merge_border_communes(commune_crop(spark, sf))


def saved_compiled(spark: SparkSession, sf: str) -> DataFrame:
    """The compiled table as reports find it: written, then read by each part that needs it."""
    return stored(compiled(spark, sf))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# ---------------------------------------------------------------- preparation


def normalized_parcels(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(data.parcels(spark, sf).drop("rings", "feature"), "area_m2", "surf_parc_ha")


def labelled_parcels(spark: SparkSession, sf: str) -> DataFrame:
    labelled = prepare.add_labels(data.parcels(spark, sf), data.labels(spark, sf), ["parcel_id"])
    return labelled.groupBy("CODE_GROUP", "cult_label").agg(F.count(F.lit(1)).alias("n"))


def crop_label_dim(spark: SparkSession, sf: str) -> DataFrame:
    return data.labels(spark, sf)


def numbers_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = data.number_texts(spark, sf).select(clean_number(F.col("text")).alias("value"))
    return cleaned.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def units_stripped(spark: SparkSession, sf: str) -> DataFrame:
    stripped = data.number_texts(spark, sf).select(strip_unit(F.col("text")).alias("value"))
    return stripped.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- links and files


def extract_links(spark: SparkSession, sf: str) -> DataFrame:
    return links.extract_links(data.table(spark, sf, "pages"))


def extract_links_of_block(spark: SparkSession, sf: str) -> DataFrame:
    return links.extract_links(data.table(spark, sf, "pages"), r"(?s)<nav>(.*?)</nav>")


def link_catalog(spark: SparkSession, sf: str) -> DataFrame:
    grid = links.region_year_grid(region_dim(spark))
    return links.link_catalog(data.file_urls(spark, sf), grid)


def region_year_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Files found per region and year of the grid."""
    catalog = link_catalog(spark, sf).groupBy("region_code", "year").agg(F.count(F.lit(1)).alias("files"))
    grid = links.region_year_grid(region_dim(spark))
    return grid.join(catalog, ["region_code", "year"], "left").na.fill(0, ["files"])


def missing_files(spark: SparkSession, sf: str) -> DataFrame:
    return links.missing_files(links.region_year_grid(region_dim(spark)), link_catalog(spark, sf))


def layer_choice(spark: SparkSession, sf: str) -> DataFrame:
    return layers.pick_layer(data.layer_paths(spark, sf), files="first")


# ---------------------------------------------------------------- geometry


def polygon_area(spark: SparkSession, sf: str) -> DataFrame:
    return data.stars(spark, sf).select("vec_id", F.round(F.expr(G.polygon_area("rings")), 6).alias("area_m2"))


def star_boxes(spark: SparkSession, sf: str) -> DataFrame:
    boxes = data.stars(spark, sf).select("vec_id", F.expr(G.bbox("rings")).alias("box"))
    return boxes.select("vec_id", *[F.round(f"box.{c}", 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


def to_lambert93(spark: SparkSession, sf: str) -> DataFrame:
    x, y = G.lonlat_to_lambert93("lon", "lat")
    return data.lonlat_points(spark, sf).select(
        "c_custkey", F.round(F.expr(x), 4).alias("x"), F.round(F.expr(y), 4).alias("y")
    )


def projected_rings(spark: SparkSession, sf: str) -> DataFrame:
    """Small fields in degrees brought to metres, measured, and taken back to where they were (to a millimetre)."""
    fields = data.lonlat_points(spark, sf).select("c_custkey", F.expr(G.box_rings("lon", "lat", "0.02", "0.01")).alias("drawn"))
    metres = fields.withColumn("rings", F.expr(G.to_lambert93("drawn", str(G.WGS84_SRID))))
    metres = metres.withColumn("back", F.expr(G.to_lonlat("rings", str(G.LAMBERT93_SRID)))).withColumn("box", F.expr(G.bbox("rings")))
    off = "array_max(zip_with(flatten(drawn), flatten(back), (a, b) -> greatest(abs(a.x - b.x), abs(a.y - b.y))))"
    return metres.select(
        "c_custkey",
        F.round(F.expr(G.polygon_area("rings")), 0).alias("area_m2"),
        F.round("box.xmin", 3).alias("xmin"),
        F.round("box.ymax", 3).alias("ymax"),
        (F.expr(off) < 8e-9).alias("returns"),
    )


def invalid_rings(spark: SparkSession, sf: str) -> DataFrame:
    return quality.flag_invalid(data.damaged_stars(spark, sf), ["vec_id"])


def cleaned_rings(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = quality.clean_geometry(data.damaged_stars(spark, sf))
    return cleaned.select(
        "vec_id",
        F.size("rings").alias("n_rings"),
        F.size(F.col("rings")[0]).alias("n_points"),
        F.round(F.expr(G.signed_area("rings")), 6).alias("signed_area_m2"),
    )


def repaired_area(spark: SparkSession, sf: str) -> DataFrame:
    """Area after repair, crossing rings read by the even-odd rule."""
    return data.damaged_stars(spark, sf).select(
        "vec_id", F.round(F.expr(G.edges_area(G.valid_edges("rings"))), 6).alias("area_m2")
    )


# ---------------------------------------------------------------- spatial joins


def spatial_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.candidate_pairs(data.parcels(spark, sf), data.communes(spark, sf), CELL, "parcel_id", "geo_unit")


def candidate_counts(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.count_candidates(spatial_candidates(spark, sf), "parcel_id")


def spatial_largest(spark: SparkSession, sf: str) -> DataFrame:
    return _assigned(spark, sf).select("parcel_id", "geo_unit", F.round("overlap_m2", 6).alias("overlap_m2"))


def spatial_intersects(spark: SparkSession, sf: str) -> DataFrame:
    tiles = spatial.unit_tiles(data.communes(spark, sf), CELL, contact=True)
    return spatial.join_intersects(data.parcels(spark, sf), tiles, CELL, ["parcel_id"])


def _repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Parcels of which eight in turn share an id, as ids do over years and regions."""
    return data.parcels(spark, sf).withColumn("parcel_id", F.expr("CAST(CAST(parcel_id AS BIGINT) div 8 AS STRING)"))


def repeated_ids_largest(spark: SparkSession, sf: str) -> DataFrame:
    tiles = spatial.unit_tiles(data.communes(spark, sf), CELL)
    found = spatial.join_largest(_repeated(spark, sf), tiles, CELL, ["parcel_id"])
    return found.select("parcel_id", "geo_unit", F.round("overlap_m2", 6).alias("overlap_m2"))


def repeated_ids_intersects(spark: SparkSession, sf: str) -> DataFrame:
    """The shuffle form: no tile table is small enough for a limit of 0."""
    tiles = spatial.unit_tiles(data.communes(spark, sf), CELL, contact=True)
    return spatial.join_intersects(_repeated(spark, sf), tiles, CELL, ["parcel_id"], limit=0)


def overlap_area(spark: SparkSession, sf: str) -> DataFrame:
    """Exact overlap of every star with every commune it meets."""
    tiles = spatial.unit_tiles(data.communes(spark, sf), CELL)
    pairs = spatial.overlaps(data.stars(spark, sf), tiles, CELL, ["vec_id"])
    return pairs.select("vec_id", "geo_unit", F.round("overlap_m2", 5).alias("overlap_m2")).filter("overlap_m2 > 0")


def star_largest(spark: SparkSession, sf: str) -> DataFrame:
    tiles = spatial.unit_tiles(data.communes(spark, sf), CELL)
    best = spatial.join_largest(data.stars(spark, sf), tiles, CELL, ["vec_id"])
    return best.select("vec_id", "geo_unit", F.round("overlap_m2", 5).alias("overlap_m2"))


def parcels_on_stars(spark: SparkSession, sf: str) -> DataFrame:
    """Roles exchanged: the stars are the units, so tiles have slanting edges."""
    units = data.stars(spark, sf).select(F.lpad(F.col("vec_id").cast("string"), 6, "0").alias("geo_unit"), "rings")
    tiles = spatial.unit_tiles(units, CELL / 4)
    parcels = data.parcels(spark, sf)
    pairs = spatial.overlaps(parcels, tiles, CELL / 4, ["parcel_id"])
    some = F.col("overlap_m2") >= 5e-6  # round(overlap_m2, 5) > 0, told without decimal numbers
    return (
        pairs.filter(some)
        .groupBy("geo_unit")
        .agg(F.count(F.lit(1)).alias("parcels"), F.round(F.sum("overlap_m2"), 2).alias("overlap_m2"))
    )


# ---------------------------------------------------------------- departments and quality


def _department_pairs(spark: SparkSession, sf: str) -> DataFrame:
    tiles = spatial.unit_tiles(data.departments(spark, sf), 2 * CELL, contact=True)
    return spatial.join_intersects(
        data.parcels(spark, sf).filter("data_type = 'pg'"),
        tiles,
        2 * CELL,
        ["parcel_id"],
        ["CODE_GROUP", "surf_parc_ha"],
    )


def department_crop(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(communes.department_crop(_department_pairs(spark, sf)), "surf_ha", "surf_perc", "perc_parcels")


def department_crop_units_first(spark: SparkSession, sf: str) -> DataFrame:
    pairs = spatial.units_with_parcels(_department_pairs(spark, sf), data.departments(spark, sf))
    crops = communes.department_crop(pairs, mode="rows")
    return _rounded(crops, "surf_ha", "surf_perc", "perc_parcels")


def _united_department_crop(spark: SparkSession, sf: str) -> DataFrame:
    tiles = spatial.unit_tiles(data.departments(spark, sf), 2 * CELL, contact=True)
    parcels = data.parcels(spark, sf)
    pairs = spatial.join_intersects(parcels, tiles, 2 * CELL, ["parcel_id"], ["CODE_GROUP"]).filter("geo_unit IS NOT NULL")
    return dissolve.dissolve_joined(pairs, parcels, ["parcel_id"], ["geo_unit", "CODE_GROUP"], 2 * CELL)


def dissolved_department_crop(spark: SparkSession, sf: str) -> DataFrame:
    """Ground covered per department and crop by the parcels that touch the department, overlaps counted once."""
    united = dissolve.dissolved_area(_united_department_crop(spark, sf), ["geo_unit", "CODE_GROUP"])
    return _rounded(united, "area_m2")


def department_crop_outlines(spark: SparkSession, sf: str) -> DataFrame:
    """The same table with its united outlines, one feature per department and crop, exported as polygon files and read back."""
    path = shared_folder(spark)
    whole = dissolve.outlines(_united_department_crop(spark, sf), ["geo_unit", "CODE_GROUP"])
    tables.write_features(whole.withColumnRenamed("CODE_GROUP", "crop"), path, clean=False)
    back = read_shapefiles(spark, path).withColumn("area_m2", F.expr(G.polygon_area("rings")))
    return _rounded(back.select("geo_unit", F.col("crop").alias("CODE_GROUP"), "area_m2"), "area_m2")


def dissolved_stars(spark: SparkSession, sf: str) -> DataFrame:
    """Area of two united stars, summed over cells and of the outline walked back from them."""
    united = stored(dissolve.dissolve(data.paired_stars(spark, sf), ["pair_id"], CELL / 4))
    outline = dissolve.outlines(united, ["pair_id"]).select("pair_id", F.expr(G.signed_area("rings")).alias("outline_m2"))
    both = dissolve.dissolved_area(united, ["pair_id"]).join(outline, "pair_id")
    return both.select("pair_id", *[F.round(c, 5).alias(c) for c in ("area_m2", "outline_m2")])


def repaired_outlines(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged stars repaired to outlines, written as polygon files, read back, measured; rings that meet themselves counted."""
    path = shared_folder(spark)
    tables.write_features(dissolve.repair_outlines(data.damaged_stars(spark, sf).select("vec_id", "rings")), path)
    back = read_shapefiles(spark, path)
    return back.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.round(F.expr(G.polygon_area("rings")), 6).alias("area_m2"),
        F.expr(f"size(filter(rings, ring -> {G.self_crossing('array(ring)')}))").alias("crossing"),
    )


def department_crop_of_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Crops of the departments of two regions, whose outlines alone are parsed from files keyed in two ways."""
    path = shared_folder(spark)
    staging.stage_departments(spark, sf, path)
    listed = {"code_insee|insee_dep": DEPARTMENTS_ILE_DE_FRANCE + DEPARTMENTS_CORSE}
    units = prepare.normalize_departments(read_shapefiles(spark, path, "department", where=listed))
    parcels = data.parcels(spark, sf).withColumn("rings", F.expr(staging.placed("rings")))
    parcels = parcels.withColumn("surf_parc_ha", F.col("area_m2") / 10000)
    tiles = spatial.unit_tiles(units, 2 * CELL)
    found = spatial.join_largest(parcels, tiles, 2 * CELL, ["parcel_id"], ["CODE_GROUP", "surf_parc_ha"])
    crops = communes.department_crop(found.filter("geo_unit IS NOT NULL"))
    return _rounded(crops, "surf_ha", "surf_perc", "perc_parcels")


def units_of_region(spark: SparkSession, sf: str) -> DataFrame:
    """Parcels whose leading unit belongs to a chosen region."""
    chosen = prepare.units_of_region(_assigned(spark, sf), ["00", "01", "05", "06"])
    return chosen.groupBy("geo_unit", "CODE_GROUP").agg(F.count(F.lit(1)).alias("n"))


def parcels_of_region(spark: SparkSession, sf: str) -> DataFrame:
    """Parcels of a chosen region: its outlines are selected before anything is cut into tiles or joined."""
    chosen = prepare.units_of_region(data.communes(spark, sf), ["00", "01", "05", "06"])
    tiles = spatial.unit_tiles(chosen, CELL)
    found = spatial.join_largest(data.parcels(spark, sf), tiles, CELL, prepare.PARCEL_KEY, KEEP)
    return found.filter("geo_unit IS NOT NULL").groupBy("geo_unit", "CODE_GROUP").agg(F.count(F.lit(1)).alias("n"))


def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.value_counts(data.parcels(spark, sf), "CODE_GROUP")


def area_check(spark: SparkSession, sf: str) -> DataFrame:
    checked = quality.area_check(data.parcels(spark, sf).filter("data_type = 'pg'"))
    return checked.withColumns({c: F.round(c, 2) for c in ("computed_m2", "declared_m2", "difference_m2")})


def area_check_by_delivery(spark: SparkSession, sf: str) -> DataFrame:
    checked = quality.area_check(data.parcels(spark, sf), ["year", "region_code"])
    return checked.withColumns({c: F.round(c, 2) for c in ("computed_m2", "declared_m2", "difference_m2")})


def sample_exact(spark: SparkSession, sf: str) -> DataFrame:
    narrow = data.parcels(spark, sf).select("parcel_id", "CODE_GROUP")
    return sampling.sample_rows(narrow, "parcel_id", fraction=0.1)


def sample_hundred(spark: SparkSession, sf: str) -> DataFrame:
    narrow = data.parcels(spark, sf).select("parcel_id", "CODE_GROUP")
    return sampling.sample_rows(narrow, "parcel_id", n=100)


def sample_layer(spark: SparkSession, sf: str) -> DataFrame:
    chosen = prepare.units_of_region(data.departments(spark, sf), ["00", "01"])
    unnamed = data.parcels(spark, sf).withColumn("feature", F.lit(None).cast("string"))  # sampled by year, region and id
    layer = sampling.sample_layer(unnamed, chosen, 0.1)
    return layer.select("layer", "id", "CODE_GROUP", F.expr(G.polygon_area("rings")).alias("area_m2"))


# ---------------------------------------------------------------- tables and reports


def border_merge_reference(spark: SparkSession, sf: str) -> DataFrame:
    return compiled(spark, sf)


def border_merge_complete(spark: SparkSession, sf: str) -> DataFrame:
    return communes.merge_border_communes(commune_crop(spark, sf), mode="complete")


def national_share_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(
        analysis.national_crop_share(saved_compiled(spark, sf), REPORT_YEAR), "surf_cult_perc", "parcel_cult_perc"
    )


def national_share_unit(spark: SparkSession, sf: str) -> DataFrame:
    shares = analysis.national_crop_share(saved_compiled(spark, sf), REPORT_YEAR, "geo_unit")
    return _rounded(shares, "surf_cult_perc", "parcel_cult_perc")


def national_report(spark: SparkSession, sf: str) -> DataFrame:
    report = charts.national_report(saved_compiled(spark, sf), REPORT_YEAR)
    return _rounded(report, *[h for h in charts.REPORT_HEADINGS.values() if h.startswith("Pourcentage")])


def _top_columns(df: DataFrame) -> DataFrame:
    return df.select("geo_unit", "name", "year", "CODE_GROUP", "cult_label", "surf_cult_perc", "parcel_cult_perc")


def top_crop_by_area(spark: SparkSession, sf: str) -> DataFrame:
    return _top_columns(analysis.top_crop(compiled(spark, sf), ["geo_unit", "year"]))


def top_crop_by_parcels(spark: SparkSession, sf: str) -> DataFrame:
    return _top_columns(analysis.top_crop(compiled(spark, sf), ["geo_unit", "year"], "parcel_cult_perc"))


def top_crop_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return _top_columns(analysis.top_crop(saved_compiled(spark, sf), ["name", "year"]))


def top_crop_by_name_parcels(spark: SparkSession, sf: str) -> DataFrame:
    return _top_columns(analysis.top_crop(saved_compiled(spark, sf), ["name", "year"], "parcel_cult_perc"))


def top_crop_one_year(spark: SparkSession, sf: str) -> DataFrame:
    one = saved_compiled(spark, sf).filter(F.col("year") == REPORT_YEAR)
    return analysis.top_crop(one, ["name"]).select("name", "cult_label")


def crop_richness(spark: SparkSession, sf: str) -> DataFrame:
    some_unknown = compiled(spark, sf).withColumn("cult_label", F.expr("nullif(cult_label, 'Arboriculture')"))
    return analysis.crop_richness(some_unknown, ["name", "year"])


def crop_richness_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Crops per region and year, merged from sketches kept per commune and year."""
    kept = stored(analysis.richness_sketch(compiled(spark, sf), ["geo_unit", "region", "year"]))
    return analysis.estimated_richness(analysis.merge_richness(kept, ["region", "year"]))


def diversity_area(spark: SparkSession, sf: str) -> DataFrame:
    indices = analysis.diversity(compiled(spark, sf), ["geo_unit", "year"], "surf_cult_m2")
    return _rounded(indices, "shannon_diversity", "simpson_diversity")


def diversity_share(spark: SparkSession, sf: str) -> DataFrame:
    indices = analysis.diversity(compiled(spark, sf), ["geo_unit", "year"], "surf_cult_perc")
    return _rounded(indices, "shannon_diversity", "simpson_diversity")


def _outline(df: DataFrame) -> DataFrame:
    """Outlines reduced to comparable numbers."""
    return df.withColumns(
        {"outline_m2": F.expr(G.polygon_area("rings")), "xmin": F.expr(G.bbox("rings"))["xmin"]}
    ).drop("rings")


def attach_geometry(spark: SparkSession, sf: str) -> DataFrame:
    return _outline(charts.map_table(compiled(spark, sf), data.communes(spark, sf)))


def choropleth_top_crop(spark: SparkSession, sf: str) -> DataFrame:
    return _outline(charts.choropleth_table(compiled(spark, sf), data.communes(spark, sf), REPORT_YEAR))


def choropleth_top_crop_by_name(spark: SparkSession, sf: str) -> DataFrame:
    table = charts.choropleth_table(
        saved_compiled(spark, sf), data.communes(spark, sf), REPORT_YEAR, keys=("name",)
    )
    return _outline(table)


def choropleth_shannon(spark: SparkSession, sf: str) -> DataFrame:
    table = charts.choropleth_table(compiled(spark, sf), data.communes(spark, sf), REPORT_YEAR, "shannon")
    return _rounded(_outline(table), "shannon_diversity")


def evolution_table(spark: SparkSession, sf: str) -> DataFrame:
    return charts.evolution_table(saved_compiled(spark, sf), "C3")


def diversity_by_year(spark: SparkSession, sf: str) -> DataFrame:
    points = charts.diversity_by_year(compiled(spark, sf), data.communes(spark, sf))
    return _rounded(points, "shannon_diversity", "simpson_diversity")


def pie_table(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(charts.pie_table(saved_compiled(spark, sf), REPORT_YEAR), "percentage")


# ---------------------------------------------------------------- writing and reading back


def prepared_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared table written by year and region, read back, compiled, written and read again."""
    folder = shared_folder(spark)
    tables.write_prepared(commune_crop(spark, sf), f"{folder}/prepared")
    merged = communes.merge_border_communes(load_prepared(spark, f"{folder}/prepared"))
    tables.write_compiled(merged, f"{folder}/compiled")
    return spark.read.parquet(f"{folder}/compiled")


def whole_job(spark: SparkSession, sf: str) -> DataFrame:
    """From delivered files to the compiled table: both layouts, split files, metres and degrees, crop names from a CSV."""
    root = shared_folder(spark)
    staging.stage_deliveries(spark, sf, root)
    build.prepare_deliveries(spark, f"{root}/raw", f"{root}/communes", f"{root}/crop_groups", f"{root}/out", CELL)
    compiled = build.compile_table(spark, f"{root}/out")
    # a parcel drawn in degrees is exact to a few billionths of a metre
    return compiled.withColumns({c: F.round(c, 3) for c in ("surf_agri_geo_unit_m2", "surf_cult_m2", "max_agri")}).withColumn(
        "surf_cult_perc", F.round("surf_cult_perc", 6)
    )


def crop_group_table(spark: SparkSession, sf: str) -> DataFrame:
    """The published crop table, written as it is delivered and read back."""
    path = shared_folder(spark)
    data.crop_groups(spark, sf).write.csv(path, sep=";", header=True, encoding="UTF-8")
    return read_crop_groups(spark, path)


def shapefile_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Parcels exported as polygon files and read back by record ranges."""
    folder = shared_folder(spark)
    parcels = data.parcels(spark, sf).withColumnsRenamed({"region_code": "region", "surf_parc_ha": "declared"})
    tables.write_features(parcels, folder, layer="PARCELLES_GRAPHIQUES")
    back = read_shapefiles(spark, folder)
    return back.groupBy("region", F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("parcels"),
        F.sum(F.expr(G.polygon_area("rings"))).alias("drawn_m2"),
        F.sum("area_m2").alias("area_m2"),
        F.round(F.sum("declared"), 6).alias("declared_ha"),
        F.count_distinct("CODE_GROUP").alias("codes"),
        F.max("srid").alias("srid"),
    )


def geojson_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    tables.write_features(data.parcels(spark, sf).select("parcel_id", "CODE_GROUP", "rings"), folder, "geojson")
    feature = F.from_json(
        "value",
        "geometry struct<coordinates:array<array<array<array<double>>>>>, "
        "properties struct<parcel_id:string,CODE_GROUP:string>",
    )
    back = spark.read.text(folder).select(feature.alias("f")).select("f.*")
    corners = "transform(flatten(geometry.coordinates), r -> transform(r, p -> struct(p[0] AS x, p[1] AS y)))"
    return back.select("properties.*", F.expr(G.polygon_area(corners)).alias("area_m2"))


def holed_stars_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Stars with holes through each of the three formats: area and number of rings as read back."""
    folder = shared_folder(spark)
    drawn = stored(data.holed_stars(spark, sf).select("vec_id", "rings"))
    for name in ("shapefile", "wkb", "geojson"):
        tables.write_features(drawn, f"{folder}/{name}", name)
    feature = F.from_json("value", "geometry struct<coordinates:array<array<array<array<double>>>>>, properties struct<vec_id:bigint>")
    lines = spark.read.text(f"{folder}/geojson").select(feature.alias("f")).select("f.properties.vec_id", "f.geometry")
    corners = "transform(flatten(geometry.coordinates), r -> transform(r, p -> struct(p[0] AS x, p[1] AS y)))"
    back = {
        "shapefile": read_shapefiles(spark, f"{folder}/shapefile").select("vec_id", "rings"),
        "wkb": with_rings(spark.read.parquet(f"{folder}/wkb")).select("vec_id", "rings"),
        "geojson": lines.select("vec_id", F.expr(corners).alias("rings")),
    }
    measured = [
        df.select("vec_id", F.lit(name).alias("format"), F.size("rings").alias("n_rings"), F.round(F.expr(G.polygon_area("rings")), 5).alias("area_m2"))
        for name, df in back.items()
    ]
    return measured[0].unionByName(measured[1]).unionByName(measured[2])


def wkb_features(spark: SparkSession, sf: str) -> DataFrame:
    """Parcels written as WKB, read back and measured."""
    path = shared_folder(spark)
    tables.write_features(data.parcels(spark, sf).select("parcel_id", "rings"), path, "wkb")
    back = with_rings(spark.read.parquet(path).withColumn("bytes", F.octet_length("wkb")))
    back = back.withColumn("box", F.expr(G.bbox("rings")))
    return back.select("parcel_id", "bytes", "box.*", F.expr(G.signed_area("rings")).alias("area_m2"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        commune_crop,
        border_merge_reference,
        border_merge_complete,
        national_share_rows,
        national_share_unit,
        national_report,
        top_crop_by_area,
        top_crop_by_parcels,
        top_crop_by_name,
        top_crop_by_name_parcels,
        top_crop_one_year,
        crop_richness,
        crop_richness_sketch,
        diversity_area,
        diversity_share,
        attach_geometry,
        choropleth_top_crop,
        choropleth_top_crop_by_name,
        choropleth_shannon,
        evolution_table,
        diversity_by_year,
        pie_table,
        normalized_parcels,
        labelled_parcels,
        crop_label_dim,
        numbers_cleaned,
        units_stripped,
        extract_links,
        extract_links_of_block,
        link_catalog,
        region_year_grid,
        missing_files,
        layer_choice,
        polygon_area,
        star_boxes,
        to_lambert93,
        projected_rings,
        invalid_rings,
        cleaned_rings,
        repaired_area,
        spatial_candidates,
        candidate_counts,
        spatial_largest,
        spatial_intersects,
        repeated_ids_largest,
        repeated_ids_intersects,
        overlap_area,
        star_largest,
        department_crop_of_regions,
        whole_job,
        crop_group_table,
        dissolved_department_crop,
        department_crop_outlines,
        dissolved_stars,
        repaired_outlines,
        parcels_on_stars,
        department_crop,
        department_crop_units_first,
        units_of_region,
        parcels_of_region,
        value_counts,
        area_check,
        area_check_by_delivery,
        sample_exact,
        sample_hundred,
        sample_layer,
        prepared_roundtrip,
        shapefile_roundtrip,
        geojson_roundtrip,
        wkb_features,
        holed_stars_roundtrip,
    )
}
