"""Parcels, outlines and links derived from the general-purpose test tables.

The test tables hold no polygons. Every order becomes a rectangular parcel, every nation a
square commune, every region a department, every embedding a star-shaped polygon with 64
corners. The SQL twins in `oracle.py` start from the same definitions.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropmosaic.functions import geometry as G
from cropmosaic.operators.prepare import crop_label_dim, normalize_parcels

CELL_SIZE = 95.0
YEAR_OF_PARCELS = 1998  # orders before it play the older block layout


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal narrow rows out evenly before costly geometry is built from them.

    A few megabytes of keys arrive in one scan task although their polygons are work for all
    cores.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *keys)


def parcel_layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two delivered layouts: parcels with declared area, and older blocks."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("year")
    )
    x0, y0 = "(o_orderkey * 37) % 1000", "(o_custkey * 53) % 1000"
    w, h = "(5 + o_orderkey % 20)", "(5 + o_custkey % 15)"
    code = F.expr("lpad(CAST(1 + (o_custkey * 7 + o_orderkey) % 28 AS STRING), 2, '0')")
    drawn = F.expr(G.box_rings(x0, y0, w, h)).alias("rings")
    region = F.expr(f"CASE WHEN {x0} < 500 THEN 'R84' ELSE 'R27' END").alias("region_code")
    # one row of the table is one feature: its name does not depend on where a task finds it
    feature = F.concat(F.lit("orders#"), F.col("o_orderkey").cast("string")).alias("feature")
    parcels = orders.filter(F.col("year") >= YEAR_OF_PARCELS)
    blocks = orders.filter(F.col("year") < YEAR_OF_PARCELS)
    declared = F.expr(f"{w} * {h} * (95 + o_orderkey % 11) / 1000000D")
    return (
        spread(parcels, "o_orderkey").select(
            F.col("o_orderkey").cast("string").alias("ID_PARCEL"),
            feature,
            code.alias("CODE_GROUP"),
            declared.alias("SURF_PARC"),
            drawn,
            region,
            "year",
        ),
        spread(blocks, "o_orderkey").select(
            F.col("o_orderkey").cast("string").alias("NUM_ILOT"), feature, code.alias("CODE_CULTU"), drawn, region, "year"
        ),
    )


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    pg, ia = parcel_layers(spark, sf_dir)
    return normalize_parcels(pg, "pg").unionByName(normalize_parcels(ia, "ia"))


def communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.expr("lpad(CAST(n_nationkey AS STRING), 2, '0')").alias("geo_unit"),
        F.expr("concat('C', CAST(n_nationkey % 20 AS STRING))").alias("nom"),
        F.lit(3.61).alias("surf_ha"),
        F.expr(G.box_rings("(n_nationkey % 5) * 190", "(n_nationkey div 5) * 190", "190", "190")).alias("rings"),
    )


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertical strips; the last one lies far away from all parcels."""
    x0 = "CASE WHEN r_regionkey = 4 THEN 5000 ELSE r_regionkey * 190 END"
    return table(spark, sf_dir, "region").select(
        F.expr("lpad(CAST(r_regionkey AS STRING), 2, '0')").alias("geo_unit"),
        F.expr(G.box_rings(f"({x0})", "0", "190", "950")).alias("rings"),
    )


def stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, rings: one counter-clockwise ring of 64 corners per embedding."""
    radius = "20 * (1 + abs(CAST(embedding[i - 1] AS DOUBLE)))"
    ring = (
        "transform(sequence(1, size(embedding)), i -> struct("
        f"(vec_id * 37) % 950 + {radius} * cos(2 * pi() * (i - 1) / size(embedding)) AS x, "
        f"(vec_id * 53) % 950 + {radius} * sin(2 * pi() * (i - 1) / size(embedding)) AS y))"
    )
    return spread(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id").select(
        "vec_id", F.expr(f"array({ring})").alias("rings")
    )


def holed_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, rings: stars with a hole of their own shape, three tenths as wide, drawn in the same direction as the shell."""
    x, y = "((vec_id * 37) % 950)", "((vec_id * 53) % 950)"
    hole = f"transform(rings[0], p -> struct({x} + 0.3D * (p.x - {x}) AS x, {y} + 0.3D * (p.y - {y}) AS y))"
    return stars(spark, sf_dir).withColumn("rings", F.expr(f"array(rings[0], {hole})"))


def paired_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pair_id, rings: two stars of neighbouring numbers drawn over each other, the second one 13 m further right."""
    radius = "20 * (1 + abs(CAST(embedding[i - 1] AS DOUBLE)))"
    even = "(vec_id - vec_id % 2)"
    ring = (
        "transform(sequence(1, size(embedding)), i -> struct("
        f"({even} * 37) % 950 + (vec_id % 2) * 13 + {radius} * cos(2 * pi() * (i - 1) / size(embedding)) AS x, "
        f"({even} * 53) % 950 + {radius} * sin(2 * pi() * (i - 1) / size(embedding)) AS y))"
    )
    return spread(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id").select(
        F.expr("vec_id div 2").alias("pair_id"), F.expr(f"array({ring})").alias("rings")
    )


def damaged_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stars with made-up defects by vec_id: none, clockwise, crossing, or with a repeated point.

    Only the undamaged quarter is closed.
    """
    ring = "rings[0]"
    return stars(spark, sf_dir).withColumn(
        "rings",
        F.expr(
            "CASE vec_id % 4 "
            f"WHEN 0 THEN array(concat({ring}, slice({ring}, 1, 1))) "
            f"WHEN 1 THEN array(reverse({ring})) "
            f"WHEN 2 THEN array(concat(slice({ring}, 1, 10), slice({ring}, 40, 1), slice({ring}, 12, 53))) "
            f"ELSE array(concat(slice({ring}, 1, 10), slice({ring}, 10, 55))) END"
        ),
    )


def crop_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crop table in the published layout: every part is a crop of one of the 24 published groups."""
    k = "(p_partkey % 24)"
    group = f"CASE WHEN {k} < 9 THEN {k} + 1 WHEN {k} = 9 THEN 11 WHEN {k} < 23 THEN {k} + 4 ELSE 28 END"
    return table(spark, sf_dir, "part").select(
        F.expr("lpad(CAST(p_partkey AS STRING), 10, '0')").alias("CODE_CULTURE"),
        F.col("p_name").alias("LIBELLE_CULTURE"),
        F.expr(f"CAST({group} AS INT)").alias("CODE_GROUPE_CULTURE"),
        F.col("p_type").alias("LIBELLE_GROUPE_CULTURE"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crop_label_dim(crop_groups(spark, sf_dir))


def file_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One download link per order; some name an unknown region, every second year is absent."""
    codes = "array('R84', 'R27', 'R53', 'R24', 'R94', 'R44', 'R32', 'R11', 'R28', 'R75', 'R76', 'R52', 'R93', 'D01')"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    return spread(orders, "o_orderkey").select(
        F.expr(
            f"concat('https://example.org/parcels/', {codes}[o_custkey % 14], '-', "
            "CAST(2007 + (year - 1995) * 2 AS STRING), '_', CAST(o_orderkey AS STRING), '.7z\\n')"
        ).alias("url")
    )


def layer_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of delivered layers: blocks for every order, parcels too for later years."""
    region = "CASE WHEN (o_orderkey * 37) % 1000 < 500 THEN 'R84' ELSE 'R27' END"
    folder = f"concat('/raw/delivery_', {region}, '_', CAST(year(o_orderdate) AS STRING), '/', CAST(o_custkey % 7 AS STRING), '/')"
    names = f"CASE WHEN year(o_orderdate) >= {YEAR_OF_PARCELS} AND o_custkey % 7 > 2 THEN 'PARCELLES_GRAPHIQUES.shp' ELSE 'ILOTS_ANONYMES.shp' END"
    return table(spark, sf_dir, "orders").select(F.expr(f"concat({folder}, {names})").alias("path"))


def lonlat_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """c_custkey, lon, lat over metropolitan France."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.expr("-5 + (c_custkey * 37) % 1400 / 100D").alias("lon"),
        F.expr("42 + (c_custkey * 53) % 900 / 100D").alias("lat"),
    )


def number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as text with a unit, among them texts that are no numbers."""
    text = (
        "CASE l_linenumber WHEN 1 THEN '. [1]' WHEN 2 THEN 'n/a' WHEN 3 THEN CAST(NULL AS STRING) "
        "ELSE concat(CAST(l_discount AS STRING), ' [1]') END"
    )
    return table(spark, sf_dir, "lineitem").select(F.expr(text).alias("text"))


