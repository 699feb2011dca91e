"""Duplicate detection and removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from postmill.functions.text import as_text


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of a whole row. Each value carries its length, so no two rows share a text."""
    texts = [as_text(F.col(f"`{name}`"), df.schema[name].dataType) for name in columns]
    marked = F.transform(
        F.array(*texts),
        lambda t: F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")),
    )
    return F.sha2(F.array_join(marked, ""), 256)


def count_exact_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each group of equal rows (NULLs equal), as one row.

    Only 32-byte digests are shuffled, never the rows, and copies collapse before the
    shuffle, so a row repeated any number of times costs one record per task.
    """
    digest = F.unhex(row_digest(df, columns or df.columns))
    groups = df.select(digest.alias("digest")).groupBy("digest").agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("exact_duplicates"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given order; NULL keys form groups of their own.

    The rank filter is applied within each task before the shuffle, so a key that holds a
    large share of the rows sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def count_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of distinct keys and number of rows beyond the first per key."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(
        F.count("*").alias("groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("repeats"),
    )
