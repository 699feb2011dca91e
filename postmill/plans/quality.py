"""Data-quality tables: missing values, the four-part score, before/after, full report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from postmill.functions.numeric import fixed_percent, percentage, round_even
from postmill.functions.text import is_known, is_missing, is_missing_exact

# Fields and weights of the score.
COMPLETENESS_FIELDS = ["job_title", "company", "location", "salary_min", "experience_level", "description_clean",
                       "skills_formatted"]
CONSISTENCY_FIELDS = ["seniority_level", "remote_type", "employment_type", "experience_level"]
SCORE_WEIGHTS = {"completeness": 0.35, "validity": 0.25, "uniqueness": 0.20, "consistency": 0.20}


def missing_values(df: DataFrame) -> DataFrame:
    """Per column: Column, Non_Null_Count, Missing_Count, Missing_Percentage. One pass."""
    fields = df.schema.fields
    missing = [F.count_if(is_missing(F.col(f"`{f.name}`"), f.dataType)) for f in fields]
    row = df.agg(F.count("*").alias("total"), F.array(*missing).alias("missing"))
    records = []
    for i, f in enumerate(fields):
        n = F.get("missing", F.lit(i))
        records.append(
            F.struct(
                F.lit(f.name).alias("Column"),
                (F.col("total") - n).alias("Non_Null_Count"),
                n.alias("Missing_Count"),
                percentage(n, F.col("total")).alias("Missing_Percentage"),
            )
        )
    return row.select(F.inline(F.array(*records)))


def _mean(parts: list[Column], empty: float = 0.0) -> Column:
    if not parts:
        return F.lit(empty)
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total / len(parts)


def quality_scores(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """One row: completeness, validity, uniqueness, consistency, overall_quality_score.

    Key fields and enumerations the frame lacks are left out of their means. Uniqueness
    comes from the one-row cleaning counts; without them nothing counts as a duplicate. An
    empty frame scores 0 throughout.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    complete = [c for c in COMPLETENESS_FIELDS if c in types]
    consistent = [c for c in CONSISTENCY_FIELDS if c in types]
    aggregates = [F.count("*").alias("total")]
    aggregates += [F.count_if(is_missing_exact(F.col(c), types[c])).alias(f"missing {c}") for c in complete]
    aggregates += [F.count_if(is_known(F.col(c))).alias(f"known {c}") for c in consistent]
    if "validation_flags" in types:
        aggregates.append(F.count_if(F.col("validation_flags") == "VALID").alias("valid"))
    row = df.agg(*aggregates)

    total = F.col("total")
    share = lambda name: F.try_divide(F.col(f"`{name}`"), total) * 100.0
    duplicates = F.lit(0.0)
    if counts is not None:
        row = row.withColumn(
            "counts", counts.select(F.struct("initial_rows", "exact_duplicates", "likely_duplicates")).scalar()
        )
        both = F.col("counts.exact_duplicates") + F.col("counts.likely_duplicates")
        duplicates = F.coalesce(F.try_divide(both, F.col("counts.initial_rows")) * 100.0, F.lit(0.0))
    parts = {
        "completeness": _mean([100.0 - share(f"missing {c}") for c in complete]),
        "validity": share("valid") if "validation_flags" in types else F.lit(100.0),
        "uniqueness": F.greatest(F.lit(0.0), 100.0 - duplicates),
        "consistency": _mean([share(f"known {c}") for c in consistent]),
    }
    row = row.select(
        *[F.when(total > 0, round_even(c, 2)).otherwise(0.0).alias(name) for name, c in parts.items()]
    )
    overall = None
    for name, weight in SCORE_WEIGHTS.items():
        term = F.lit(weight) * F.col(name)
        overall = term if overall is None else overall + term
    return row.withColumn("overall_quality_score", round_even(overall, 2))


def before_after(df: DataFrame, counts: DataFrame) -> DataFrame:
    """Seven rows (Metric, Before, After) as text."""
    place = F.col("location").eqNullSafe(F.lit("Unknown"))
    row = df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("salary_min").isNull()).alias("no_salary"),
        F.count_if(place).alias("no_location"),
    ).withColumn("c", counts.select(F.struct("*")).scalar())
    share = lambda c: fixed_percent(F.coalesce(F.try_divide(F.col(c), F.col("total")) * 100.0, F.lit(0.0)))
    zero, none = F.lit("0"), F.lit("N/A")
    table = [
        ("Rows", F.col("c.initial_rows"), F.col("total")),
        ("Exact Duplicates", F.col("c.exact_duplicates"), zero),
        ("Likely Duplicates", F.col("c.likely_duplicates"), zero),
        ("Missing Salary %", none, share("no_salary")),
        ("Missing Location %", none, share("no_location")),
        ("Invalid Salary", F.col("c.invalid_salaries"), zero),
        ("Invalid Dates", F.col("c.invalid_dates"), zero),
    ]
    records = [
        F.struct(
            F.lit(metric).alias("Metric"), b.cast("string").alias("Before"), a.cast("string").alias("After")
        )
        for metric, b, a in table
    ]
    return row.select(F.inline(F.array(*records)))


def quality_report(df: DataFrame, counts: DataFrame) -> DataFrame:
    """Full report as one nested row; the table of columns is as long as the schema."""
    missing = missing_values(df)
    return df.agg(F.count("*").alias("total_rows")).select(
        "total_rows",
        F.lit(len(df.columns)).alias("total_columns"),
        missing.agg(F.collect_list(F.struct("*"))).scalar().alias("missing_value_analysis"),
        quality_scores(df, counts).select(F.struct("*")).scalar().alias("data_quality_scores"),
        counts.select(F.struct("*")).scalar().alias("cleaning_statistics"),
    )


def cleaning_summary(df: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts, scores and the before/after table as one nested row."""
    return counts.select(
        F.struct("*").alias("cleaning_statistics"),
        quality_scores(df, counts).select(F.struct("*")).scalar().alias("data_quality_scores"),
        before_after(df, counts).agg(F.collect_list(F.struct("*"))).scalar().alias("before_after_comparison"),
    )


def top_missing(df: DataFrame, limit: int = 12) -> DataFrame:
    """Columns with the largest share of missing values: Column, Missing_Pct.

    Exact tokens count for text, NaN for fractions, and only NULL for other types, arrays included.
    """
    fields = df.schema.fields
    missing = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        textual = isinstance(f.dataType, (T.StringType, T.DoubleType, T.FloatType))
        missing.append(F.count_if(is_missing_exact(c, f.dataType) if textual else c.isNull()))
    row = df.agg(F.count("*").alias("total"), F.array(*missing).alias("missing"))
    records = []
    for i, f in enumerate(fields):
        share = F.try_divide(F.get("missing", F.lit(i)), F.col("total")) * 100.0
        records.append(
            F.struct(F.lit(f.name).alias("Column"), F.coalesce(share, F.lit(0.0)).alias("Missing_Pct"))
        )
    table = row.select(F.inline(F.array(*records)))
    return table.orderBy(F.col("Missing_Pct").desc(), "Column").limit(limit)


def score_breakdown(scores: DataFrame) -> DataFrame:
    """Scores as five rows (Dimension, Score)."""
    names = {
        "Completeness": "completeness", "Validity": "validity", "Uniqueness": "uniqueness",
        "Consistency": "consistency", "OVERALL": "overall_quality_score",
    }
    records = [F.struct(F.lit(k).alias("Dimension"), F.col(v).alias("Score")) for k, v in names.items()]
    return scores.select(F.inline(F.array(*records)))
