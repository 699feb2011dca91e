"""Read raw postings and clean tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from postmill.functions.text import null_tokens
from postmill.operators.mapping import rename_columns
from postmill.schema import ORDER_COLUMN

# Cell texts that mean NULL in delimited files.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
               "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def nulled(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Replace null tokens in all text columns, in one projection."""
    return df.select(
        *[
            (null_tokens(F.col(f"`{f.name}`"), tokens) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`"))
            .alias(f.name)
            for f in df.schema.fields
        ]
    )


def spread(scan: DataFrame, partitions: int | None) -> DataFrame:
    """Deal the rows of a scan out anew where it has too few splits for the cluster; None leaves it alone."""
    return scan if partitions is None else scan.repartition(partitions)


def _ordered(df: DataFrame) -> DataFrame:
    """Attach the position of each row: file, block, then row within the task."""
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", position.alias(ORDER_COLUMN))


def read_raw(spark: SparkSession, path: str | Sequence[str], file_format: str = "csv",
             multi_line: bool = True, partitions: int | None = None) -> DataFrame | None:
    """Raw postings from all CSV, JSON or Parquet files under a path; None if there are none.

    CSV cells stay text and null tokens become NULL. Files of one call must share a header;
    see ``read_raw_sources`` for others. With ``multi_line`` a CSV file is one task because
    quoted cells may hold line breaks; turn it off for large files without such cells, or name a number of
    ``partitions`` to deal the rows out after the read.
    """
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.options(
            header=True, multiLine=multi_line, escape='"', inferSchema=False, enforceSchema=False,
            pathGlobFilter="*.csv",
        )
    elif file_format == "json":
        reader = reader.options(multiLine=False)
    try:
        df = reader.load(path if isinstance(path, str) else list(path))
    except AnalysisException as e:
        if e.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            return None
        raise
    df = spread(_ordered(df), partitions)
    return nulled(df) if file_format == "csv" else df


def read_raw_sources(spark: SparkSession, paths: Sequence[str], file_format: str = "csv",
                     custom_mapping: Mapping[str, str] | None = None, multi_line: bool = True,
                     partitions: int | None = None) -> DataFrame | None:
    """Raw postings from sources with different headers: each is renamed, then all are united.

    Rows keep their order by source file. All values are text afterwards.
    """
    out = None
    for path in paths:
        df = read_raw(spark, path, file_format, multi_line, partitions)
        if df is None:
            continue
        named = rename_columns(df, custom_mapping)
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out


def read_clean(spark: SparkSession, path: str) -> DataFrame | None:
    """Clean postings written earlier as Parquet, or None."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            return None
        raise
