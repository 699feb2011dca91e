"""Stage an intermediate table in the shared folder, so that later passes read it back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one only where the setting is missing on a local master (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local") or "local-cluster" in spark.conf.get("spark.master", ""):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="postmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame) -> DataFrame:
    """Write a table once as Parquet and return a reader for it.

    Unlike a cached table it outlives lost executors, and readers still prune columns.
    """
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/postmill-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
