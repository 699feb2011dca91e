"""Descriptive statistics of numeric and categorical columns, overall and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postmill.functions.numeric import percentage, round_even, to_number
from postmill.functions.text import is_missing_exact, strip
from postmill.operators.quantiles import exact_quantiles, smallest_mode, value_counts

NUMERIC_STATS = ["count", "mean", "median", "mode", "min", "max", "std", "variance", "q1", "q2", "q3", "iqr"]
GROUP_STATS = ["count", "mean", "median", "std", "min", "max"]


def _number(df: DataFrame, column: str) -> Column:
    return to_number(F.col(column), df.schema[column].dataType)


def numeric_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, median, mode, min, max, std, variance, q1, q2, q3, iqr.

    Values that are not numbers are left out. Rounded to 4 digits; without values the count
    is 0 and the rest NULL. std and variance are those of a sample, 0 for a single value.
    """
    values = df.select(_number(df, column).alias("v"))
    counts = value_counts(values, F.col("v"))
    moments = values.agg(*_moments())
    quartiles = exact_quantiles(values, F.col("v"), [0.25, 0.5, 0.75], counts=counts)
    row = moments.select(
        "*",
        quartiles.select("q").scalar().alias("q"),
        smallest_mode(counts).select("v").scalar().alias("mode"),
    )
    return row.select("count", *_numeric_columns())


def numeric_stats_of(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same statistics for several columns, told apart by ``field``, in shared passes."""
    cells = [F.struct(F.lit(c).alias("field"), _number(df, c).alias("v")) for c in columns]
    values = df.select(F.inline(F.array(*cells)))
    present = values.dropna()
    fields = df.sparkSession.createDataFrame([(c,) for c in columns], "field string")
    moments = present.groupBy("field").agg(*_moments())
    quartiles = exact_quantiles(present, F.col("v"), [0.25, 0.5, 0.75], by=["field"], few_groups=True)
    counts = value_counts(present, F.col("v"), ["field"])
    modes = counts.groupBy("field").agg(F.max_by("v", F.struct("n", -F.col("v"))).alias("mode"))
    # One record per column on every side.
    row = fields
    for side in (moments, quartiles, modes):
        row = row.join(F.broadcast(side), "field", "left")
    row = row.withColumn("count", F.coalesce("count", F.lit(0)))
    return row.select("field", "count", *_numeric_columns())


def _moments() -> list[Column]:
    return [
        F.count("v").alias("count"),
        F.avg("v").alias("mean"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.stddev_samp("v").alias("std"),
        F.var_samp("v").alias("variance"),
    ]


def _numeric_columns() -> list[Column]:
    """Rounded statistics from the moments, the quartiles ``q`` and the mode."""
    some = F.col("count") > 0
    spread = {c: F.when(some, F.coalesce(F.col(c), F.lit(0.0))) for c in ("std", "variance")}
    q1, q2, q3 = (F.get("q", F.lit(i)) for i in range(3))
    parts = {
        "mean": F.col("mean"), "median": q2, "mode": F.col("mode"), "min": F.col("min"), "max": F.col("max"),
        **spread, "q1": q1, "q2": q2, "q3": q3, "iqr": q3 - q1,
    }
    return [round_even(parts[c], 4).alias(c) for c in NUMERIC_STATS[1:]]


def categorical_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: count of all rows, non_null_count, unique, top, freq, percentage of all rows.

    Missing tokens are left out of all but the first. Ties for the top go to the smallest
    value; without values the top is "N/A".
    """
    text = strip(F.col(column).cast("string"))
    counts = df.groupBy(text.alias("v")).agg(F.count("*").alias("n"))
    present = ~is_missing_exact(F.col("v"))
    top = counts.where(present).orderBy(F.col("n").desc(), F.col("v").asc()).limit(1)
    row = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("non_null_count"),
        F.count_if(present).alias("unique"),
    ).withColumn("top_row", top.select(F.struct("v", "n")).scalar())
    freq = F.coalesce(F.col("top_row.n"), F.lit(0))
    return row.select(
        "count",
        "non_null_count",
        "unique",
        F.coalesce(F.col("top_row.v"), F.lit("N/A")).alias("top"),
        freq.alias("freq"),
        percentage(freq, F.col("count")).alias("percentage"),
    )


def grouped_stats(df: DataFrame, group: str | list[str], target: str, min_group_size: int = 1) -> DataFrame:
    """Per group: count, mean, median, std, min, max of the target, rounded to 2 digits.

    NULL groups and values that are not numbers are left out, as are groups with fewer than
    ``min_group_size`` values. A single value has std 0. Several group columns are allowed.
    A column the frame lacks gives an empty result.
    """
    groups = [group] if isinstance(group, str) else list(group)
    if not {*groups, target} <= set(df.columns):
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        names = [f"`{g}` {kinds.get(g, 'string')}" for g in groups]
        return df.sparkSession.createDataFrame([], ", ".join([*names, "count bigint", *[f"{c} double" for c in GROUP_STATS[1:]]]))
    rows = df.select(*groups, _number(df, target).alias("v")).dropna()
    stats = rows.groupBy(*groups).agg(
        F.count("v").alias("count"),
        F.avg("v").alias("mean"),
        F.coalesce(F.stddev_samp("v"), F.lit(0.0)).alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    if min_group_size > 1:
        stats = stats.where(F.col("count") >= min_group_size)
    medians = exact_quantiles(rows, F.col("v"), [0.5], by=groups)
    joined = stats.join(medians, groups).withColumn("median", F.get("q", F.lit(0)))
    return joined.select(*groups, "count", *[round_even(F.col(c), 2).alias(c) for c in GROUP_STATS[1:]])
