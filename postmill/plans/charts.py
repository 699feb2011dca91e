"""Chart inputs as small result tables; drawing is left to the reader's plotting tool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postmill.functions.numeric import to_number
from postmill.functions.text import UNKNOWN
from postmill.operators.correlation import correlations, metric_columns
from postmill.operators.frequency import distributions, top_values
from postmill.operators.quantiles import exact_quantiles, join_salted, value_counts
from postmill.plans.profile import experience_levels, salary_target, top_companies, top_titles

HISTOGRAM_BINS = 20
DENSITY_POINTS = 200
DENSITY_BINS = 2_048


def shares(df: DataFrame, column: str) -> DataFrame:
    """Value, count and percentage of one categorical column (pie and bar charts)."""
    return distributions(df, [column]).drop("dimension")


def _bin(v: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based number of an equal-width bin; the last bin includes the upper end."""
    place = F.coalesce(F.try_divide(v - low, high - low), F.lit(0.0)) * bins
    return F.least(F.floor(place), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram: bin, low, high, count, with empty bins; none for fewer than 2 values."""
    values = df.select(to_number(F.col(column), df.schema[column].dataType).alias("v")).dropna()
    ends = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"))).scalar()
    placed = values.withColumn("e", ends).select(_bin(F.col("v"), F.col("e.low"), F.col("e.high"), bins).alias("bin"))
    counts = placed.groupBy("bin").agg(F.count("*").alias("count"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), ends.alias("e"))
    frame = frame.where(F.col("e.n") > 1).join(counts, "bin", "left")
    width = (F.col("e.high") - F.col("e.low")) / bins
    return frame.select(
        "bin",
        (F.col("e.low") + F.col("bin") * width).alias("low"),
        (F.col("e.low") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def density(df: DataFrame, column: str, points: int = DENSITY_POINTS, bins: int = DENSITY_BINS) -> DataFrame:
    """Gaussian density curve over the range of the values: x, density.

    Values are first counted in ``bins`` fine bins and stand at the mean of their bin, so the curve costs a
    fixed amount of work beyond one pass. The bandwidth h is n^(-1/5) sample standard deviations; as the first
    order cancels, each value moves its kernel by at most (w/h)^2/8 of the kernel's height, w being a bin's width.
    """
    values = df.select(to_number(F.col(column), df.schema[column].dataType).alias("v")).dropna()
    ends = values.agg(
        F.struct(
            F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"),
            F.stddev_samp("v").alias("std"),
        )
    ).scalar()
    fine = values.withColumn("e", ends)
    fine = fine.groupBy(_bin(F.col("v"), F.col("e.low"), F.col("e.high"), bins).alias("bin")).agg(
        F.avg("v").alias("center"), F.count("*").alias("weight")
    )
    step = (F.col("e.high") - F.col("e.low")) / (points - 1)
    fine = fine.withColumn("e", ends).where(F.col("e.std") > 0)
    curve = fine.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")).withColumn(
        "x", F.col("e.low") + F.col("i") * step
    )
    bandwidth = F.col("e.std") * F.pow(F.col("e.n"), F.lit(-0.2))
    z = (F.col("x") - F.col("center")) / bandwidth
    height = F.col("weight") * F.exp(-0.5 * z * z) / (F.sqrt(2 * F.pi()) * bandwidth * F.col("e.n"))
    return curve.groupBy("i").agg(F.first("x").alias("x"), F.sum(height).alias("density")).drop("i")


def box_plot(df: DataFrame, group: str, column: str) -> DataFrame:
    """Per group (Unknown and NULL out): count, q1, median, q3, whiskers, outliers.

    Whiskers end at the last value within 1.5 interquartile ranges of the box.
    """
    number = to_number(F.col(column), df.schema[column].dataType)
    rows = df.select(F.col(group), number.alias("v")).dropna().where(F.col(group) != UNKNOWN)
    boxes = exact_quantiles(rows, F.col("v"), [0.25, 0.5, 0.75], by=[group])
    q1, median, q3 = (F.get("q", F.lit(i)) for i in range(3))
    reach = 1.5 * (q3 - q1)
    within = F.col("v").between(q1 - reach, q3 + reach)
    # Equal values are counted before the join, so a hot group sends its distinct values only.
    counts = join_salted(value_counts(rows, F.col("v"), [group]), boxes, [group])
    return counts.groupBy(group).agg(
        F.sum("n").alias("count"),
        F.first(q1).alias("q1"),
        F.first(median).alias("median"),
        F.first(q3).alias("q3"),
        F.min(F.when(within, F.col("v"))).alias("whisker_low"),
        F.max(F.when(within, F.col("v"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~within, F.col("n"))), F.lit(0)).alias("outliers"),
    )


def correlation_heatmap(df: DataFrame) -> DataFrame:
    """Pearson matrix over all numeric metrics in long form; none below 3 complete rows."""
    columns = metric_columns(df)
    matrix = correlations(df, columns)
    complete = df.select(*columns).dropna().agg(F.count("*")).scalar() if columns else F.lit(0)
    return matrix.where(complete >= 3)


def chart_tables(df: DataFrame) -> dict[str, DataFrame]:
    """All chart inputs of a clean postings table by chart name."""
    tables = {}
    has = set(df.columns)
    if "remote_type" in has:
        tables["remote_work_distribution"] = shares(df, "remote_type")
    if "employment_type" in has:
        tables["employment_type_distribution"] = shares(df, "employment_type")
    if "job_title" in has:
        tables["top_job_titles"] = top_titles(df, 15)
    if "company" in has:
        tables["top_companies"] = top_companies(df, 15)
    if "city" in has:
        tables["top_locations"] = top_values(df, "city", 15)
    if "experience_level" in has:
        tables["experience_distribution"] = experience_levels(df)
    if "salary_min" in has:
        chosen, _ = salary_target(df)
        tables["salary_histogram"] = histogram(chosen, "_salary")
        tables["salary_density"] = density(chosen, "_salary")
        if "experience_level" in has:
            tables["salary_box_experience"] = box_plot(chosen, "experience_level", "_salary")
    if len(metric_columns(df)) >= 2:
        tables["correlation_heatmap"] = correlation_heatmap(df)
    return tables
