"""Code tables and prepared tables."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cropmosaic.schemas import CATCH_CROPS_CSV, CROP_GROUPS_CSV


def _read_codes(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.csv(path, sep=";", header=True, schema=schema, encoding="UTF-8", enforceSchema=False)


def read_crop_groups(spark: SparkSession, path: str) -> DataFrame:
    """Published table of crops and crop groups."""
    return _read_codes(spark, path, CROP_GROUPS_CSV)


def read_catch_crops(spark: SparkSession, path: str) -> DataFrame:
    """Published table of catch crops."""
    return _read_codes(spark, path, CATCH_CROPS_CSV)


def load_prepared(spark: SparkSession, root: str) -> DataFrame:
    """All prepared deliveries below a folder; filters on year and region prune whole folders."""
    return spark.read.parquet(root)


def stack(frames: list[DataFrame]) -> DataFrame:
    """Loose prepared frames under each other, matched by column name."""
    return reduce(DataFrame.unionByName, frames)
