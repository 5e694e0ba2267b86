"""Choice of the layer to read in each delivery folder."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# File names of the two layouts, the preferred one first.
LAYER_FILES = [("pg", "PARCELLES_GRAPHIQUES.shp"), ("ia", "ILOTS_ANONYMES.shp")]
FOLDER_PATTERN = r"_(R[0-9]{2})_([0-9]{4})/"


def list_layers(spark: SparkSession, root: str) -> DataFrame:
    """Paths of all .shp files below a folder. Only the listing is used, no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.shp")
        .load(root)
        .select("path")
    )


def pick_layer(paths: DataFrame, folder_pattern: str = FOLDER_PATTERN, files: str = "all") -> DataFrame:
    """The files of each delivery: region_code, year, kind, path.

    The folder name gives region and year. Parcels win over blocks. A layer may be split into
    many files: all are returned, or with files="first" the first path only.
    """
    if files not in ("all", "first"):
        raise ValueError("files must be all or first")
    kind = F.lit(None).cast("struct<rank:int,kind:string>")
    for rank, (name, file) in reversed(list(enumerate(LAYER_FILES))):
        found = F.struct(F.lit(rank).alias("rank"), F.lit(name).alias("kind"))
        kind = F.when(F.col("path").endswith(file), found).otherwise(kind)
    found = paths.select(
        F.regexp_extract("path", folder_pattern, 1).alias("region_code"),
        F.regexp_extract("path", folder_pattern, 2).try_cast("int").alias("year"),
        kind.alias("k"),
        "path",
    ).filter(F.col("k").isNotNull() & F.col("year").isNotNull())
    delivery = ["region_code", "year"]
    if files == "first":
        chosen = found.groupBy(*delivery).agg(F.min(F.struct("k", "path")).alias("c")).select(*delivery, "c.k", "c.path")
    else:
        best = found.groupBy(*delivery).agg(F.min("k.rank").alias("rank"))
        chosen = found.join(best, delivery).filter(F.col("k.rank") == F.col("rank"))
    return chosen.select(*delivery, F.col("k.kind").alias("kind"), "path")
