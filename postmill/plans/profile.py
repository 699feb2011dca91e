"""Profile of a clean postings table: every function returns lazy result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from postmill.functions.postings import posted_date
from postmill.functions.numeric import number_text, percentage, round_even, to_number
from postmill.functions.text import UNKNOWN, is_known, is_missing_exact, strip
from postmill.operators.describe import GROUP_STATS, grouped_stats, numeric_stats, numeric_stats_of
from postmill.operators.frequency import (
    cross_table,
    distributions,
    top_values,
    top_values_per_column,
)
from postmill.operators.outliers import iqr_outliers, zscore_outliers
from postmill.schema import REMOTE_TYPES

DISTRIBUTION_COLUMNS = {
    "employment_type": "by_employment_type",
    "remote_type": "by_remote_type",
    "seniority_level": "by_seniority",
    "posted_year": "by_posted_year",
}
SALARY_GROUPS = {
    "by_experience": ("experience_level", 1),
    "by_remote_type": ("remote_type", 1),
    "by_seniority": ("seniority_level", 1),
    "by_city": ("city", 2),
}
PLACE_LEVELS = ["city", "state", "country"]


def _one_row(df: DataFrame) -> DataFrame:
    return df.sparkSession.range(1)


def overview(df: DataFrame) -> DataFrame:
    """One row of totals: postings, distinct names and skills, dates, shares.

    "Unknown" and NULL are not distinct names. Dates are "N/A" when there are none. NULL
    counts as a known experience level.
    """
    names = {"unique_companies": "company", "unique_locations": "location", "unique_job_titles": "job_title"}
    has = set(df.columns)
    date = F.try_to_date(posted_date(F.col("posted_date").cast("string"))["iso"], "yyyy-MM-dd") if "posted_date" in has else None
    aggregates = [F.count("*").alias("total_job_postings")]
    aggregates += [
        (F.count_distinct(F.nullif(F.col(c), F.lit(UNKNOWN))) if c in has else F.lit(0).cast("bigint")).alias(name)
        for name, c in names.items()
    ]
    aggregates += [
        (F.min(date) if date is not None else F.lit(None).cast("date")).alias("min_date"),
        (F.max(date) if date is not None else F.lit(None).cast("date")).alias("max_date"),
        (F.count_if(F.col("remote_type") == "Remote") if "remote_type" in has else F.lit(0)).alias("remote"),
        (F.count("salary_min") if "salary_min" in has else F.lit(0)).alias("salaried"),
        (F.count_if(is_known(F.col("experience_level"))) if "experience_level" in has else F.lit(0)).alias(
            "experienced"
        ),
    ]
    total = F.col("total_job_postings")
    return df.agg(*aggregates).select(
        "total_job_postings",
        *names,
        (distinct_skills(df).scalar() if "skills" in has else F.lit(0).cast("bigint")).alias("unique_skills"),
        F.coalesce(F.date_format("min_date", "yyyy-MM-dd"), F.lit("N/A")).alias("min_date"),
        F.coalesce(F.date_format("max_date", "yyyy-MM-dd"), F.lit("N/A")).alias("max_date"),
        percentage(F.col("remote"), total).alias("remote_job_percentage"),
        percentage(F.col("salaried"), total).alias("salary_completeness_pct"),
        percentage(F.col("experienced"), total).alias("experience_completeness_pct"),
    )


def distinct_skills(df: DataFrame) -> DataFrame:
    """One row: number of distinct skills, from arrays or from comma-separated text."""
    c = F.col("skills")
    if not isinstance(df.schema["skills"].dataType, T.ArrayType):
        c = F.split(c, ",")
    skills = df.select(F.explode(c).alias("skill")).select(strip(F.col("skill")).alias("skill"))
    skills = skills.where(F.col("skill") != "").distinct()
    return skills.agg(F.count("*").alias("unique_skills"))


def job_distributions(df: DataFrame) -> DataFrame:
    """Counts by contract type, modality, seniority and year: (dimension, value, count, percentage)."""
    return distributions(df, list(DISTRIBUTION_COLUMNS))


def top_titles(df: DataFrame, limit: int = 20) -> DataFrame:
    """Most frequent titles; only NULL and "Unknown" are left out."""
    return top_values(df, "job_title", limit, drop=lambda c: c.isNull() | (c == UNKNOWN))


def top_companies(df: DataFrame, limit: int = 15) -> DataFrame:
    return top_values(df, "company", limit)


def company_summary(df: DataFrame, column: str = "company") -> DataFrame:
    """One row: number of companies, mean and median postings per company.

    The median is taken over counts of counts: however many companies there are, the number
    of different sizes grows only with the square root of the number of postings.
    """
    name = strip(F.col(column).cast("string"))
    sizes = (
        df.select(name.alias("name"))
        .where(~is_missing_exact(F.col("name")))
        .groupBy("name")
        .agg(F.count("*").alias("size"))
        .groupBy("size")
        .agg(F.count("*").alias("n"))
    )
    mean = F.try_divide(F.sum(F.col("size") * F.col("n")).cast("double"), F.sum("n").cast("double"))
    median = F.percentile(F.col("size"), F.lit(0.5), F.col("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_unique_companies"),
        round_even(F.coalesce(mean, F.lit(0.0)), 2).alias("mean_postings_per_company"),
        round_even(F.coalesce(median, F.lit(0.0)), 2).alias("median_postings_per_company"),
    )


def top_places(df: DataFrame, limit: int = 15) -> DataFrame:
    """Top cities, states and countries in one pass: (dimension, value, count, percentage, place)."""
    return top_values_per_column(df, PLACE_LEVELS, limit)


def remote_by_city(df: DataFrame, limit: int = 10, remote_types: list[str] = REMOTE_TYPES) -> DataFrame:
    """Modality counts for the top cities, one column per modality."""
    return cross_table(df, "city", "remote_type", remote_types, limit)


@dataclass(frozen=True)
class SalaryProfile:
    target: DataFrame  # total_salary_records, target_column_used
    overall: DataFrame
    outliers_iqr: DataFrame
    outliers_zscore: DataFrame
    groups: DataFrame  # dimension, value, count, mean, median, std, min, max

    def by(self, name: str) -> DataFrame:
        """One of by_experience, by_remote_type, by_seniority, by_city under its own column name."""
        column, _ = SALARY_GROUPS[name]
        rows = self.groups.where(F.col("dimension") == column).drop("dimension")
        return rows.withColumnRenamed("value", column)


def salary_target(df: DataFrame) -> tuple[DataFrame, Column]:
    """Frame with ``_salary`` (midpoint if any is present, else minimum) and the name used."""
    low = to_number(F.col("salary_min"), df.schema["salary_min"].dataType)
    if "salary_midpoint" not in df.columns:
        return df.withColumn("_salary", low), F.lit("salary_min")
    mid = to_number(F.col("salary_midpoint"), df.schema["salary_midpoint"].dataType)
    any_mid = df.agg(F.count("salary_midpoint") > 0).scalar()
    used = F.when(any_mid, "salary_midpoint").otherwise("salary_min")
    return df.withColumn("_salary", F.when(any_mid, mid).otherwise(low)), used


def salary_groups(df: DataFrame, groupings: dict[str, int], target: str = "_salary") -> DataFrame:
    """Grouped statistics of a target for several columns at once: dimension, value, statistics.

    All groupings share the passes over the table; ``groupings`` gives the minimum size.
    """
    cells = [
        F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value"), F.col(target).alias("v"))
        for c in groupings
        if c in df.columns
    ]
    if not cells:
        names = ["count bigint", *[f"{c} double" for c in GROUP_STATS[1:]]]
        return df.sparkSession.createDataFrame([], ", ".join(["dimension string", "value string", *names]))
    stacked = df.where(F.col(target).isNotNull()).select(F.inline(F.array(*cells)))
    stats = grouped_stats(stacked, ["dimension", "value"], "v")
    least = F.lit(1)
    for column, size in groupings.items():
        if size > 1:
            least = F.when(F.col("dimension") == column, size).otherwise(least)
    return stats.where(F.col("count") >= least)


def salary_profile(df: DataFrame) -> SalaryProfile:
    """Salary statistics, outliers and breakdowns by experience, modality, seniority, city."""
    if "salary_min" not in df.columns:
        df = df.withColumn("salary_min", F.lit(None).cast("double"))
    chosen, used = salary_target(df)
    narrow = chosen.select("_salary", *[c for c, _ in SALARY_GROUPS.values() if c in df.columns])
    target = narrow.agg(F.count("_salary").alias("total_salary_records")).withColumn("target_column_used", used)
    return SalaryProfile(
        target,
        numeric_stats(narrow, "_salary"),
        iqr_outliers(narrow, "_salary"),
        zscore_outliers(narrow, "_salary"),
        salary_groups(narrow, dict(SALARY_GROUPS.values())),
    )


def experience_levels(df: DataFrame) -> DataFrame:
    """Level distribution: (value, count, percentage)."""
    return distributions(df, ["experience_level"]).drop("dimension")


def experience_years(df: DataFrame) -> DataFrame:
    """Statistics of the minimum and maximum years: two rows told apart by ``field``."""
    fields = ["experience_min_years", "experience_max_years"]
    df = df.withColumns({c: F.lit(None).cast("double") for c in fields if c not in df.columns})
    return numeric_stats_of(df, fields)


def insights(df: DataFrame) -> DataFrame:
    """Up to three rule-based findings: topic, finding, evidence, interpretation, limitation."""
    titles = top_titles(df, 1).select(F.struct("*")).scalar()
    salaries = salary_profile(df)
    row = overview(df).where(F.col("total_job_postings") > 0).select(
        F.col("total_job_postings").alias("total"),
        F.col("remote_job_percentage").alias("remote"),
        F.col("salary_completeness_pct").alias("disclosed"),
        titles.alias("top"),
        salaries.overall.select(F.struct("count", "median")).scalar().alias("salary"),
    )
    return row.select(F.inline(F.filter(F.array(*_findings()), lambda x: x["topic"].isNotNull())))


def _findings() -> list[Column]:
    total = F.col("total").cast("string")
    title, title_count = F.col("top.job_title"), F.col("top.count").cast("string")
    lit = F.lit
    findings = [
        (
            F.when(title.isNotNull(), lit("Most frequent title")),
            F.concat(lit("'"), title, lit("' is the title that occurs most often.")),
            F.concat(title_count, lit(" of "), total, lit(" postings carry it ("), number_text(F.col("top.percentage")), lit("%).")),
            lit("Demand in this table centres on that title."),
            lit("Holds for the postings at hand, not for a whole market."),
        ),
        (
            lit("Remote share"),
            F.concat(number_text(F.col("remote")), lit("% of the postings are remote.")),
            F.concat(lit("Counted over "), total, lit(" postings.")),
            lit("Shows how common remote work is here."),
            lit("A posting that names no modality does not count as remote."),
        ),
        (
            lit("Stated pay"),
            F.concat(number_text(F.col("disclosed")), lit("% of the postings state a salary; the median is "),
                     number_text(F.col("salary.median")), lit(".")),
            F.concat(F.col("salary.count").cast("string"), lit(" of "), total, lit(" postings have a usable amount.")),
            lit("Gives a first point of reference for pay."),
            lit("Employers choose whether to state pay, so the median may be biased."),
        ),
    ]
    names = ["topic", "finding", "evidence", "interpretation", "limitation"]
    return [F.struct(*[c.alias(n) for n, c in zip(names, f)]) for f in findings]


def _records(table: DataFrame, *columns: str) -> Column:
    """A small result table (bounded by a limit or an enumeration) as an array of structs."""
    return table.agg(F.sort_array(F.collect_list(F.struct(*(columns or table.columns))))).scalar()


def _ranked(table: DataFrame, key: str) -> Column:
    """A top list as an array in its order: count descending, then name."""
    order = F.struct((-F.col("count")).alias("order"), F.col(key), "count", "percentage")
    rows = table.agg(F.sort_array(F.collect_list(order)).alias("rows"))
    fields = [key, "count", "percentage"]
    return rows.select(F.transform("rows", lambda r: F.struct(*[r[f].alias(f) for f in fields]))).scalar()


def profile_summary(df: DataFrame) -> DataFrame:
    """The whole profile as one nested row with six sections."""
    salaries = salary_profile(df)
    one = lambda t: t.select(F.struct("*")).scalar()
    places = top_places(df)
    dist = job_distributions(df)
    years = experience_years(df)
    sections = {
        "dataset_overview": one(overview(df)),
        "job_distributions": F.struct(
            *[
                _records(dist.where(F.col("dimension") == c), "value", "count", "percentage").alias(name)
                for c, name in DISTRIBUTION_COLUMNS.items()
            ]
        ),
        "company_summary": F.struct(
            one(company_summary(df)).alias("totals"), _ranked(top_companies(df), "company").alias("top_companies")
        ),
        "location_summary": F.struct(
            *[
                _ranked(places.where(F.col("dimension") == level).withColumnRenamed("value", level), level).alias(name)
                for level, name in zip(PLACE_LEVELS, ["top_cities", "top_states", "top_countries"])
            ],
            _records(remote_by_city(df)).alias("remote_by_location"),
        ),
        "salary_summary": F.struct(
            one(salaries.target).alias("target"),
            one(salaries.overall).alias("overall_statistics"),
            one(salaries.outliers_iqr).alias("outlier_analysis_iqr"),
            one(salaries.outliers_zscore).alias("outlier_analysis_zscore"),
        ),
        "experience_summary": F.struct(
            _records(experience_levels(df)).alias("level_distribution"),
            one(years.where(F.col("field") == "experience_min_years").drop("field")).alias("min_years_statistics"),
            one(years.where(F.col("field") == "experience_max_years").drop("field")).alias("max_years_statistics"),
        ),
    }
    return _one_row(df).select(*[c.alias(name) for name, c in sections.items()])
