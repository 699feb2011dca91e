"""A corpus pipeline over ``documents``: reject bad texts, drop repeated lines, near copies and benchmark items, encode."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from postmill.llm import decontam_templates, line_windows, nbsvm, piece_fst, simhash_mih
from postmill.llm.common import fresh, importable, read
from postmill.sources.staging import staging_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; copies of a text share their fate. Columns of its own names pass through."""
    taken = ("score", "held_out", "predicted")
    names = {c: fresh(docs, f"given_{c}") if c.lower() in taken else c for c in docs.columns}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    scored = nbsvm.score(renamed, read(spark, sf_dir, "labels"), columns=renamed.columns)
    return scored.where("predicted = 1").select(*[F.col(f"`{n}`").alias(c) for c, n in names.items()])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that earlier documents, or earlier places, hold already."""
    out = line_windows.dedup_lines(docs)
    changed = F.col(out.columns[-1]) > 0
    return out.select(*[
        F.when(changed, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
        for c in docs.columns
    ])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group that SimHash near-dedup links: four-word shingles, four bits."""
    return simhash_mih.one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontam_templates.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece numbers."""
    return piece_fst.encode(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_free),
    ("SentencePiece encoding", encoded),
]

#: SQL cannot express the classifier and the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    importable(spark)
    docs = read(spark, sf_dir, "documents")
    folder = f"{staging_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{i}")
            docs = spark.read.parquet(f"{folder}/{i}")
    return docs
