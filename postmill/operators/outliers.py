"""Outliers by quartile fences and by standard score: summaries and row flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from postmill.functions.numeric import percentage, round_even, to_number
from postmill.operators.quantiles import exact_quantiles


def _fences(q, factor: float):
    q1, q3 = F.get(q, F.lit(0)), F.get(q, F.lit(1))
    spread = q3 - q1
    return q1, q3, spread, q1 - factor * spread, q3 + factor * spread


def iqr_outliers(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """One row: quartiles, fences and the number of values strictly outside them."""
    values = df.select(to_number(F.col(column), df.schema[column].dataType).alias("v"))
    quartiles = exact_quantiles(values, F.col("v"), [0.25, 0.75]).select("q").scalar()
    *_, lower, upper = _fences(F.col("q"), factor)
    row = (
        values.withColumn("q", quartiles)
        .agg(
            F.count("v").alias("total"),
            F.count_if(F.col("v") < lower).alias("low"),
            F.count_if(F.col("v") > upper).alias("high"),
        )
        .withColumn("q", quartiles)
    )
    q1, q3, spread, lower, upper = _fences(F.col("q"), factor)
    outliers = F.col("low") + F.col("high")
    return row.select(
        F.lit("IQR").alias("method"),
        F.lit(float(factor)).alias("factor"),
        F.col("total").alias("total_records"),
        *[
            round_even(c, 4).alias(name)
            for name, c in [("q1", q1), ("q3", q3), ("iqr", spread), ("lower_bound", lower), ("upper_bound", upper)]
        ],
        outliers.alias("outlier_count"),
        percentage(outliers, F.col("total")).alias("outlier_percentage"),
        F.col("low").alias("low_outlier_count"),
        F.col("high").alias("high_outlier_count"),
    )


def zscore_outliers(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    """One row: mean, sample std and the number of values with |z| above the threshold.

    Fewer than two values give NULL mean and std; a constant column has no outliers.
    """
    values = df.select(to_number(F.col(column), df.schema[column].dataType).alias("v"))
    moments = values.agg(
        F.struct(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"))
    ).scalar()
    scored = values.select("v", moments.alias("m"))
    z = F.abs(F.try_divide(F.col("v") - F.col("m.mean"), F.col("m.std")))
    row = scored.agg(F.count_if(z > threshold).alias("outliers")).withColumn("m", moments)
    enough = F.col("m.n") >= 2
    return row.select(
        F.lit("Z-Score").alias("method"),
        F.lit(float(threshold)).alias("threshold"),
        F.col("m.n").alias("total_records"),
        F.when(enough, round_even(F.col("m.mean"), 4)).alias("mean"),
        F.when(enough, round_even(F.col("m.std"), 4)).alias("std"),
        F.col("outliers").alias("outlier_count"),
        percentage(F.col("outliers"), F.col("m.n")).alias("outlier_percentage"),
    )


def flag_outliers(df: DataFrame, column: str, factor: float = 1.5, flag: str = "is_outlier") -> DataFrame:
    """All rows with a flag for values outside the quartile fences; NULL stays unflagged."""
    number = to_number(F.col(column), df.schema[column].dataType)
    quartiles = exact_quantiles(df.select(number.alias("v")), F.col("v"), [0.25, 0.75])
    *_, lower, upper = _fences(F.col("_q"), factor)
    outside = F.coalesce((number < lower) | (number > upper), F.lit(False))
    return df.withColumn("_q", quartiles.select("q").scalar()).withColumn(flag, outside).drop("_q")
