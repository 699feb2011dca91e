"""Write clean tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def write_clean(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Clean postings as Parquet, optionally partitioned (for example by posted_year)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_clean_csv(df: DataFrame, path: str) -> None:
    """Clean postings as CSV; arrays are written as comma-separated text."""
    columns = [
        (F.array_join(F.col(f"`{f.name}`"), ", ") if isinstance(f.dataType, T.ArrayType) else F.col(f"`{f.name}`"))
        .alias(f.name)
        for f in df.schema.fields
    ]
    df.select(*columns).write.mode("overwrite").csv(path, header=True, escape='"')


def write_table(df: DataFrame, path: str, bounded: bool = True) -> None:
    """A report table as one CSV file, or as many files where its length grows with the data."""
    (df.repartition(1) if bounded else df).write.mode("overwrite").csv(path, header=True, escape='"')


def write_summary(df: DataFrame, path: str) -> None:
    """A one-row nested report as one JSON file."""
    df.repartition(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
