"""Frequency tables, top lists and cross tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from postmill.functions.numeric import percentage
from postmill.functions.text import is_missing_exact, strip


def row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery."""
    return df.agg(F.count("*")).scalar()


def stacked(df: DataFrame, columns: Sequence[str], clean=lambda c: c) -> DataFrame:
    """One row per cell of the given columns: (dimension, value). Read in a single scan."""
    cells = [F.struct(F.lit(c).alias("dimension"), clean(F.col(c).cast("string")).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells)))


def distributions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and percentage of all rows per value of several columns at once.

    Columns: dimension, value, count, percentage. NULL is not a value, "Unknown" is.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame(
            [], "dimension string, value string, count bigint, percentage double"
        )
    counts = stacked(df, present).dropna().groupBy("dimension", "value").agg(F.count("*").alias("count"))
    return counts.withColumn("percentage", percentage(F.col("count"), row_count(df)))


def top_values(df: DataFrame, column: str, limit: int, drop=is_missing_exact) -> DataFrame:
    """Most frequent values with count and percentage of all rows; ties by value.

    Values are stripped, and those for which ``drop`` holds are left out.
    """
    text = df.select(strip(F.col(column).cast("string")).alias(column))
    counts = text.where(~drop(F.col(column))).groupBy(column).agg(F.count("*").alias("count"))
    top = counts.orderBy(F.col("count").desc(), F.col(column).asc()).limit(limit)
    return top.withColumn("percentage", percentage(F.col("count"), row_count(df)))


def top_values_per_column(df: DataFrame, columns: Sequence[str], limit: int) -> DataFrame:
    """Top values of several columns in one pass: (dimension, value, count, percentage, place).

    Ranking is cut to ``limit`` within each task before the shuffle, so a column with many
    distinct values does not gather them in one place.
    """
    cells = stacked(df, [c for c in columns if c in df.columns], strip)
    counts = (
        cells.where(~is_missing_exact(F.col("value")))
        .groupBy("dimension", "value")
        .agg(F.count("*").alias("count"))
    )
    place = F.row_number().over(
        Window.partitionBy("dimension").orderBy(F.col("count").desc(), F.col("value").asc())
    )
    top = counts.withColumn("place", place).where(F.col("place") <= limit)
    share = percentage(F.col("count"), row_count(df))
    return top.select("dimension", "value", "count", share.alias("percentage"), "place")


def cross_table(df: DataFrame, row: str, column: str, column_values: Sequence[str], limit: int = 10) -> DataFrame:
    """Counts of one column's values for the most frequent values of another, 0 where none.

    A row of the result needs at least one row with a non-NULL column value. Values outside the list are
    counted in the column ``other``.
    """
    top = top_values(df, row, limit).select(row)
    cells = df.select(row, column).where(F.col(column).isNotNull())
    kept = cells.join(F.broadcast(top), row, "left_semi")  # top holds at most `limit` rows
    counts = [F.count_if(F.col(column) == v).alias(v) for v in column_values]
    return kept.groupBy(row).agg(*counts, F.count_if(~F.col(column).isin(*column_values)).alias("other"))
