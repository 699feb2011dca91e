"""End-to-end jobs: clean raw files, profile a clean table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from postmill.plans import charts, profile, quality
from postmill.plans.cleaning import clean_postings
from postmill.sources import readers, writers


def run_cleaning(spark: SparkSession, raw_path: str | Sequence[str], out_path: str, file_format: str = "csv",
                 custom_mapping: Mapping[str, str] | None = None, clean_csv: bool = False, multi_line: bool = True,
                 partitions: int | None = None, order_by: Sequence[str] | None = None, strict: bool = False,
                 id_hex_digits: int = 64, partition_by: str | None = None) -> DataFrame | None:
    """Clean raw files and write the clean table and its quality reports; None without input.

    A list of paths names sources with headers of their own. Writes clean/ (Parquet, optionally partitioned),
    quality/data_quality_report (CSV and JSON), cleaning_summary,
    missing_values and quality_score. Reports are computed from the written tables, so raw
    files are parsed for the clean table and for the counts, and not again.
    """
    if isinstance(raw_path, str):
        raw = readers.read_raw(spark, raw_path, file_format, multi_line, partitions)
    else:
        raw = readers.read_raw_sources(spark, raw_path, file_format, custom_mapping, multi_line, partitions)
    if raw is None:
        return None
    cleaned = clean_postings(raw, custom_mapping, order_by, strict, id_hex_digits)
    writers.write_clean(cleaned.postings, f"{out_path}/clean", partition_by)
    cleaned.counts.write.mode("overwrite").parquet(f"{out_path}/counts")

    clean = spark.read.parquet(f"{out_path}/clean")
    counts = spark.read.parquet(f"{out_path}/counts")
    if clean_csv:
        writers.write_clean_csv(clean, f"{out_path}/clean_csv")
    target = f"{out_path}/quality"
    writers.write_table(quality.missing_values(clean), f"{target}/data_quality_report_csv")
    writers.write_summary(quality.cleaning_summary(clean, counts), f"{target}/cleaning_summary")
    writers.write_summary(quality.quality_report(clean, counts), f"{target}/data_quality_report")
    writers.write_table(quality.top_missing(clean), f"{target}/missing_values")
    writers.write_table(
        quality.score_breakdown(quality.quality_scores(clean, counts)), f"{target}/quality_score"
    )
    return clean


def load_or_clean(spark: SparkSession, out_path: str, raw_path: str | Sequence[str], file_format: str = "csv",
                  **options) -> DataFrame | None:
    """The clean table if it was written before, else the result of cleaning the raw files with the given options."""
    clean = readers.read_clean(spark, f"{out_path}/clean")
    return clean if clean is not None else run_cleaning(spark, raw_path, out_path, file_format, **options)


def run_profile(spark: SparkSession, clean: DataFrame | str, out_path: str) -> bool:
    """Write the profile of a clean table: statistics, summary, insights and chart inputs.

    False when there is no clean table. Each report reads only the columns it needs.
    """
    df = readers.read_clean(spark, clean) if isinstance(clean, str) else clean
    if df is None:
        return False
    salaries = profile.salary_profile(df)
    ordered = lambda t: t.orderBy(F.col("count").desc(), t.columns[0])
    statistics = {
        "top_job_titles": profile.top_titles(df, 20),
        "salary_by_experience": ordered(salaries.by("by_experience")),
        "salary_by_remote_type": ordered(salaries.by("by_remote_type")),
        "salary_by_city": ordered(salaries.by("by_city")),
    }
    for name, table in statistics.items():
        writers.write_table(table, f"{out_path}/statistics/{name}", bounded=name != "salary_by_city")
    writers.write_summary(profile.profile_summary(df), f"{out_path}/summaries/eda_summary")
    writers.write_table(profile.insights(df), f"{out_path}/reports/insights")
    for name, table in charts.chart_tables(df).items():
        writers.write_table(table, f"{out_path}/charts/{name}")
    return True
