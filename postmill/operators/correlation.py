"""Pearson and Spearman correlation matrices after dropping incomplete rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from postmill.functions.numeric import round_even, to_number

# Number of keys over which the rows of a hot value are spread.
_SPREAD_KEYS = 4_096


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[to_number(F.col(c), df.schema[c].dataType).alias(c) for c in columns]).dropna()


def _long(row: DataFrame, columns: Sequence[str], value) -> DataFrame:
    cells = [
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), round_even(value(a, b), 4).alias("corr"))
        for a in columns
        for b in columns
    ]
    return row.where(F.col("n") > 0).select(F.inline(F.array(*cells)))


def _pearson(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = rows.agg(
        F.count("*").alias("n"), *[F.covar_samp(a, b).alias(f"{a}|{b}") for a, b in pairs]
    )

    def value(a: str, b: str) -> Column:
        name = f"{a}|{b}" if (a, b) in pairs else f"{b}|{a}"
        spread = F.sqrt(F.col(f"`{a}|{a}`")) * F.sqrt(F.col(f"`{b}|{b}`"))
        return F.try_divide(F.col(f"`{name}`"), spread)

    return _long(row, columns, value)


def _ranges(splits: Sequence[float]) -> tuple[list[float], list[int]]:
    """Range edges for sorted row quantiles, and the ranges that hold one hot value only.

    A value that is more than one quantile holds many rows; it gets a range of its own.
    Every other range holds about one quantile step of the rows.
    """
    hot = {a for a, b in zip(splits, splits[1:]) if a == b}
    inner = {x for x in splits} | {math.nextafter(x, math.inf) for x in hot}
    edges = sorted({-math.inf, math.inf, *(inner or {0.0})})  # without rows there are no splits
    return edges, [i for i, x in enumerate(edges) if x in hot]


def with_average_rank(rows: DataFrame, plain: DataFrame, column: str, name: str,
                      splits: Sequence[float]) -> DataFrame:
    """Add the average rank of a column to weighted rows (weight column ``w``).

    Ranges of values are ranked side by side. Rows of a hot value share one known rank, so
    they need no sorting and are spread over many keys. ``plain`` holds the same rows before
    counting; range sizes come from a scan of it rather than from the ranked rows.
    """
    edges, hot = _ranges(splits)
    ranges = Bucketizer(splits=edges, inputCol=column, outputCol="range")
    ranged = ranges.transform(rows)
    sizes = ranges.transform(plain.select(column)).groupBy("range").agg(F.count("*").alias("size"))
    start = F.sum("size").over(Window.partitionBy(F.lit(0)).orderBy("range")) - F.col("size")
    starts = sizes.select("range", "size", start.alias("start"))

    is_hot = F.col("range").isin(*[float(i) for i in hot]) if hot else F.lit(False)
    spread = F.when(is_hot, F.pmod(F.xxhash64(*rows.columns), F.lit(_SPREAD_KEYS))).otherwise(F.lit(0))
    ranged = ranged.withColumn("part", spread)
    upto = F.sum("w").over(Window.partitionBy("range", "part").orderBy(column))
    ties = F.sum("w").over(Window.partitionBy("range", "part", column))
    ranged = ranged.withColumn("upto", upto).withColumn("ties", ties)
    # One record per range, so the broadcast side is as long as the list of splits.
    ranged = ranged.join(F.broadcast(starts), "range")
    inside = F.when(is_hot, (F.col("size") + 1) / 2).otherwise(F.col("upto") - (F.col("ties") - 1) / 2)
    return ranged.select(*rows.columns, (F.col("start") + inside).alias(name))


def _spearman(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    # Equal rows are counted first, so repeated combinations collapse before any shuffle.
    ranked = rows.groupBy(*columns).agg(F.count("*").alias("w"))
    total = rows.agg(F.count("*")).scalar()

    # Row quantiles at fixed steps: a sketch merged on the executors, a fixed list of numbers.
    parts = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / parts for i in range(1, parts)]
    splits = rows.approxQuantile(list(columns), steps, 0.5 / parts)
    for column, cut in zip(columns, splits):
        ranked = with_average_rank(ranked, rows, column, f"rank of {column}", cut)

    # The mean rank is known, so plain weighted sums of deviations lose no precision.
    ranked = ranked.withColumn("total", total)
    middle = (F.col("total") + 1) / 2
    off = {c: F.col(f"`rank of {c}`") - middle for c in columns}
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = ranked.agg(
        F.coalesce(F.sum("w"), F.lit(0)).alias("n"),
        *[F.sum(F.col("w") * off[a] * off[b]).alias(f"{a}|{b}") for a, b in pairs],
    )

    def value(a: str, b: str) -> Column:
        name = f"{a}|{b}" if (a, b) in pairs else f"{b}|{a}"
        spread = F.sqrt(F.col(f"`{a}|{a}`")) * F.sqrt(F.col(f"`{b}|{b}`"))
        return F.try_divide(F.col(f"`{name}`"), spread)

    return _long(row, columns, value)


def correlations(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """Correlation matrix in long form (col_a, col_b, corr), rounded to 4 digits.

    Columns the frame lacks are skipped and text is read as numbers. Fewer than two columns
    or no complete row give an empty result; a constant column correlates as NULL.
    """
    present = [c for c in columns if c in df.columns]
    if len(present) < 2:
        schema = "col_a string, col_b string, corr double"
        return df.sparkSession.createDataFrame([], schema)
    rows = _complete(df, present)
    if method == "pearson":
        return _pearson(rows, present)
    if method == "spearman":
        return _spearman(rows, present)
    raise ValueError(f"unknown correlation method: {method}")


def correlation_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """Wide form: one row per column with one correlation column per column."""
    present = [c for c in columns if c in df.columns]
    long = correlations(df, present, method)
    return long.groupBy(F.col("col_a").alias("column")).pivot("col_b", present).agg(F.first("corr"))


def metric_columns(df: DataFrame) -> list[str]:
    """Numeric columns other than the parts of the posting date."""
    dates = {"posted_year", "posted_month", "posted_day"}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in dates]
