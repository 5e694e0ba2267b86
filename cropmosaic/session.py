"""Shared working folder and tables written on the way."""

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="cropmosaic-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in spark.checkpoint.dir.

    Without that setting only a local session gets one, in a temporary folder of the process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/cropmosaic-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """The frame written once as a table and read back.

    For results used more than once or measured before use: they are computed once, and a
    lost executor costs no recomputation of what came before.
    """
    path = path or shared_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
