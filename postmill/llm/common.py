"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postmill.sources.staging import staging_folder

#: Rows up to which a side may be broadcast once it has been counted; each is at most some 100 bytes.
BROADCAST_ROWS = 1_000_000
#: Bytes and rows in an Arrow batch sent to Python; a task holds a batch on both sides, and its copies.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 1_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package, wherever the driver was started."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's limits of an Arrow batch to the above; smaller ones stay. A longer text is a batch by itself."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key).lower().removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, most)


def kept(df: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(staging_folder(spark))
    return df.checkpoint()


def hinted(df: DataFrame, rows: int) -> DataFrame:
    """A counted narrow table with a broadcast hint while it is small; Spark chooses the join beyond that."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text modulo a divisor; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def text_bytes(docs: DataFrame) -> int:
    """Bytes in all texts: one narrow aggregate, used only to choose numbers of blocks."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
