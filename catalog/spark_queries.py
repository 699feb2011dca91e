"""Every operator bound to the test tables: name -> function of (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalog.bindings import TOLD_SQL, raw_postings, table
from postmill.functions import postings as P
from postmill.functions.numeric import round_even
from postmill.functions.relative_dates import relative_date
from postmill.functions.text import clean_text
from postmill.operators.concordance import kendall
from postmill.operators.cooccurrence import associations
from postmill.operators.correlation import correlation_matrix, correlations
from postmill.operators.describe import categorical_stats, grouped_stats, numeric_stats
from postmill.operators.duplicates import count_exact_duplicates, keep_first
from postmill.operators.frequency import cross_table, distributions, top_values, top_values_per_column
from postmill.operators.inference import chi_square, kruskal_wallis, mann_whitney
from postmill.operators.intervals import group_intervals
from postmill.operators.mapping import normalize_columns
from postmill.operators.outliers import flag_outliers, iqr_outliers, zscore_outliers
from postmill.operators.phrases import demand, find_phrases, opening_words
from postmill.operators.states import merge_states, profile_states, read_states
from postmill.plans import charts, profile, quality
from postmill.plans.cleaning import CleanedPostings, clean_postings
from postmill.sources.staging import staged

Query = Callable[[SparkSession, str], DataFrame]

LINE_METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LANGUAGES = ["de", "en", "es", "fr"]

_staged: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def _on(name: str, run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: run(table(spark, sf_dir, name))


def _cleaned(spark: SparkSession, sf_dir: str) -> CleanedPostings:
    return clean_postings(raw_postings(spark, sf_dir), order_by=["row_no"])


def _clean_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Clean postings and counts as written tables, as the reports read them in a real run."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        cleaned = _cleaned(spark, sf_dir)
        _staged[key] = (staged(cleaned.postings), staged(cleaned.counts))
    return _staged[key]


def _on_clean(run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: run(_clean_table(spark, sf_dir)[0])


def _on_clean_and_counts(run: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: run(*_clean_table(spark, sf_dir))


def _parsed(expression, names: dict[str, str]) -> Query:
    """A struct parser over raw postings: row_no plus the named fields."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = raw_postings(spark, sf_dir)
        parsed = raw.select("row_no", F.transform(F.array(expression()), lambda x: x).alias("p"))
        first = F.try_element_at(F.col("p"), F.lit(1))
        return parsed.select("row_no", *[first[field].alias(name) for field, name in names.items()])

    return run


def _labelled(name: str, expression) -> Query:
    return lambda spark, sf_dir: raw_postings(spark, sf_dir).select("row_no", expression().alias(name))


def _clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table; lists are text."""
    return _cleaned(spark, sf_dir).postings.select(*_CLEAN_COLUMNS)


_CLEAN_COLUMNS = [
    "job_id", "job_title", "seniority_level", "company", "location", "city", "state", "country", "remote_type", "salary_min",
    "salary_max", "salary_currency", "salary_period", "salary_midpoint", "experience_min_years",
    "experience_max_years", "experience_level", "employment_type", "description_clean", "posted_date",
    "posted_year", "posted_month", "posted_day", "validation_flags", "skills_formatted", "raw_salary_string",
]


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    named, _ = normalize_columns(raw_postings(spark, sf_dir))
    return named.select(
        "row_no", "job_id", "job_title", "company", "location", "remote_type", "employment_type", "experience",
        "description", "posted_date", "skills", "raw_salary_string", "salary_min", "country",
    )


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per combination of flags, before duplicates are removed, from the cleaning counts."""
    row = _cleaned(spark, sf_dir).counts
    return row.select("invalid_salaries", "invalid_experiences", "invalid_dates")


def _page_texts(pages: DataFrame) -> DataFrame:
    text = pages.select("page_id", clean_text(F.col("html")).alias("text"))
    return text.select("page_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"))


def _duplicate_documents(documents: DataFrame) -> DataFrame:
    return count_exact_duplicates(documents.drop("doc_id"))


def _nine_digits(stats: DataFrame) -> DataFrame:
    """Statistics with squares as texts of nine significant digits, which is what double sums are good for."""
    return stats.withColumns({c: F.format_string("%.8e", F.col(c)) for c in ("std", "variance")})


def _salary_overall(clean: DataFrame) -> DataFrame:
    p = profile.salary_profile(clean)
    return _nine_digits(p.overall).withColumn("target_column_used", p.target.select("target_column_used").scalar())


def _title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers that differ from canonical names in case only, and two columns for one target."""
    raw = raw_postings(spark, sf_dir).select(
        "row_no", F.col("jobTitle").alias("Job Title"), F.col("jobLocation").alias("Location"),
        F.col("workMode").alias("State"), F.col("jobType").alias("City"), F.col("salaryRange").alias("Salary_Period"))
    named, _ = normalize_columns(raw)
    return named.select("row_no", "job_title", "location", "State__raw", "City__raw", "Salary_Period__raw", "city", "state")


def _density(events: DataFrame) -> DataFrame:
    return charts.density(events, "value").select(
        round_even(F.col("x"), 4).alias("x"), round_even(F.col("density"), 6).alias("density")
    )


def _box(orders: DataFrame) -> DataFrame:
    box = charts.box_plot(orders, "o_orderpriority", "o_totalprice")
    return box.select(
        "o_orderpriority", "count", *[round_even(F.col(c), 4).alias(c) for c in ("q1", "median", "q3")],
        "whisker_low", "whisker_high", "outliers",
    )


def _histogram(orders: DataFrame) -> DataFrame:
    bars = charts.histogram(orders, "o_totalprice")
    return bars.select("bin", round_even(F.col("low"), 2).alias("low"), round_even(F.col("high"), 2).alias("high"), "count")


def _skill_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of two and three words that begin some document, wherever a document has them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    openings = docs.select(F.explode(F.array(*[opening_words(F.col("text"), n) for n in (2, 3)])).alias("w")).where("size(w) > 0")
    phrases = openings.select(F.array_join("w", " ").alias("phrase"), F.get("w", F.lit(0)).alias("label"))
    return find_phrases(docs, "text", phrases, ["doc_id"])


def _listed_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_postings(spark, sf_dir).select(
        "row_no", F.explode_outer(P.skills(F.col("keySkills"), T.StringType())).alias("skill"))


def _skill_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many postings name each skill that some posting lists, in title, list or description."""
    listed = _listed_skills(spark, sf_dir).select(F.col("skill").alias("phrase"), F.col("skill").alias("label")).distinct()
    postings = raw_postings(spark, sf_dir).select("row_no", F.concat_ws(" / ", "jobTitle", "keySkills", "jobDescription").alias("text"))
    return demand(find_phrases(postings, "text", listed, ["row_no"]), "row_no")


def _skill_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = associations(_listed_skills(spark, sf_dir), "row_no", "skill", 20)
    return pairs.select("a", "b", "n_a", "n_b", "n_both", *[round_even(F.col(c), 9).alias(c) for c in (
        "support", "confidence_ab", "confidence_ba", "lift")])


def _bought_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that serve the same orders."""
    pairs = associations(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey", 2)
    return pairs.select("a", "b", "n_both", round_even(F.col("lift"), 6).alias("lift"))


def _told(orders: DataFrame) -> DataFrame:
    told = orders.withColumn("n", F.expr("cast(o_orderkey % 40 + 1 AS string)")).withColumn("told", F.expr(TOLD_SQL))
    told = told.withColumn("day", relative_date(F.col("told"), F.col("o_orderdate")))
    return told.select("o_orderkey", F.col("day.date").cast("string").alias("posted"), F.col("day.at_least").alias("at_least"))


def _rounded(df: DataFrame) -> DataFrame:
    """Test figures as they are compared: doubles to nine digits, chi-square values to six."""
    digits = {"h": 6, "chi_square": 6}
    return df.select(*[
        round_even(F.col(f.name), digits.get(f.name, 9)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _kendall(df: DataFrame, first: str, second: str) -> DataFrame:
    """Pair counts as whole numbers of 64 bits, which the test tables do not exceed."""
    return _rounded(kendall(df, first, second)).withColumns({c: F.col(c).cast("long") for c in ("concordant", "discordant")})


def _intervals(df: DataFrame, group: str, value: str) -> DataFrame:
    out = group_intervals(df, group, value)
    return out.select(*[round_even(F.col(c), 4).alias(c) if c not in (group, "n") else F.col(c) for c in out.columns])


EVENT_COLUMNS = ["value", "user_id", "event_type"]


def _merged_profile(t: DataFrame) -> DataFrame:
    """Profile of all events from the states of their days: exact figures, and whether each sketch keeps to its error."""
    days = profile_states(t.withColumn("day", F.to_date("ts")), EVENT_COLUMNS, ["day"])
    merged = read_states(merge_states(days), [0.5])
    exact = t.agg(F.map_from_arrays(
        F.array(*[F.lit(c) for c in EVENT_COLUMNS]), F.array(*[F.count_distinct(c) for c in EVENT_COLUMNS]),
    )).scalar()
    below = t.agg(F.map_from_arrays(F.array(*[F.lit(c) for c in EVENT_COLUMNS[:2]]), F.array(*[
        F.percentile_approx(F.col(c).cast("double"), [0.45, 0.55], 10_000) for c in EVENT_COLUMNS[:2]
    ]))).scalar()
    middle = F.col("approx_quantiles")[0]
    return merged.withColumns({"exact": exact[F.col("column")], "ends": F.try_element_at(below, F.col("column"))}).select(
        "column", "rows", "missing", round_even(F.col("mean"), 6).alias("mean"), round_even(F.col("std"), 6).alias("std"), "least", "most",
        (F.abs(F.col("approx_distinct") - F.col("exact")) <= F.greatest(0.08 * F.col("exact"), F.lit(1))).alias("distinct_within"),
        ((middle >= F.col("ends")[0]) & (middle <= F.col("ends")[1])).alias("median_within"),
    )


QUERIES: dict[str, Query] = {
    # statistics
    "numerical_stats": _on("lineitem", lambda t: _nine_digits(numeric_stats(t, "l_extendedprice"))),
    "numerical_stats_events": _on("events", lambda t: numeric_stats(t, "value")),
    "categorical_stats": _on("orders", lambda t: categorical_stats(t, "o_orderpriority")),
    "grouped_stats": _on("lineitem", lambda t: grouped_stats(t, "l_returnflag", "l_extendedprice")),
    "grouped_stats_min_size": _on("customer", lambda t: grouped_stats(t, "c_nationkey", "c_acctbal", 60)),
    "outliers_iqr": _on("events", lambda t: iqr_outliers(t, "value")),
    "outliers_iqr_prices": _on("orders", lambda t: iqr_outliers(t, "o_totalprice")),
    "outliers_zscore": _on("events", lambda t: zscore_outliers(t, "value")),
    "outlier_rows": _on(
        "events", lambda t: flag_outliers(t, "value").where("is_outlier").select("event_id", "event_type", "value")
    ),
    "corr_pearson": _on("lineitem", lambda t: correlations(t, LINE_METRICS)),
    "corr_spearman": _on("lineitem", lambda t: correlations(t, LINE_METRICS, "spearman")),
    "corr_matrix": _on("part", lambda t: correlation_matrix(t, ["p_size", "p_retailprice", "p_partkey"])),
    # tests of difference and dependence
    "kruskal_wallis": _on("orders", lambda t: _rounded(kruskal_wallis(t, "o_totalprice", "o_orderpriority"))),
    "kruskal_wallis_ties": _on("lineitem", lambda t: _rounded(kruskal_wallis(t, "l_quantity", "l_returnflag"))),
    "mann_whitney": _on("lineitem", lambda t: _rounded(mann_whitney(t, "l_quantity", "l_linestatus", "F", "O"))),
    "chi_square": _on("orders", lambda t: _rounded(chi_square(t, "o_orderpriority", "o_orderstatus"))),
    "chi_square_sparse": _on("part", lambda t: _rounded(chi_square(t, "p_brand", "p_size"))),
    "kendall": _on("orders", lambda t: _kendall(t, "o_totalprice", "o_custkey")),
    "kendall_ties": _on("lineitem", lambda t: _kendall(t, "l_quantity", "l_discount")),
    "group_intervals": _on("orders", lambda t: _intervals(t, "o_orderpriority", "o_totalprice")),
    "group_intervals_small": _on(
        "part", lambda t: _intervals(t, "p_size", "p_retailprice").drop("mean_low", "mean_high")
    ),
    "merged_profile": _on("events", _merged_profile),
    # frequencies
    "distributions": _on("orders", lambda t: distributions(t, ["o_orderpriority", "o_orderstatus"])),
    "top_values": _on("part", lambda t: top_values(t, "p_brand", 10)),
    "top_values_per_column": _on("part", lambda t: top_values_per_column(t, ["p_type", "p_brand", "p_name"], 5)),
    "crosstab": _on("documents", lambda t: cross_table(t, "source", "lang", LANGUAGES, 10)),
    "group_sizes": _on("orders", lambda t: profile.company_summary(t, "o_custkey")),
    # duplicates
    "exact_duplicates": _on("documents", _duplicate_documents),
    "exact_duplicate_postings": lambda spark, d: count_exact_duplicates(raw_postings(spark, d).drop("row_no")),
    "likely_duplicates": _on(
        "documents", lambda t: keep_first(t, ["text"], ["doc_id"]).select("doc_id", "lang", "source", "n_chars")
    ),
    # schema and field parsers
    "normalize_columns": _normalized,
    "normalize_columns_titlecase": _title_case,
    "clean_text": _on("pages", _page_texts),
    "clean_titles": _labelled("job_title", lambda: clean_text(F.col("jobTitle"))),
    "seniority": _labelled("seniority_level", lambda: P.seniority(F.col("jobTitle"), F.col("jobDescription"))),
    "salary": _parsed(
        lambda: P.salary(F.col("salaryRange")),
        {"min": "salary_min", "max": "salary_max", "currency": "salary_currency", "period": "salary_period",
         "midpoint": "salary_midpoint"},
    ),
    "experience": _parsed(
        lambda: P.experience(F.col("experienceLevel"), F.col("jobTitle"), F.col("jobDescription")),
        {"min": "experience_min_years", "max": "experience_max_years", "level": "experience_level"},
    ),
    "location": _parsed(
        lambda: P.location(F.col("jobLocation")), {"city": "city", "state": "state", "country": "country"}
    ),
    "remote_type": _labelled(
        "remote_type",
        lambda: P.remote_type(F.col("workMode"), F.col("jobLocation"), F.col("jobTitle"), F.col("jobDescription")),
    ),
    "employment_type": _labelled(
        "employment_type", lambda: P.employment_type(F.col("jobType"), F.col("jobDescription"))
    ),
    "posted_date": _parsed(
        lambda: P.posted_date(F.col("postedDate")),
        {"iso": "posted_date", "year": "posted_year", "month": "posted_month", "day": "posted_day"},
    ),
    "skills": _labelled("skills", lambda: F.array_join(P.skills(F.col("keySkills"), T.StringType()), ", ")),
    "validation_counts": _flags,
    # cleaning and quality
    "clean_postings": _clean_rows,
    "cleaning_counts": lambda spark, d: _cleaned(spark, d).counts,
    "missing_values": _on_clean(quality.missing_values),
    "quality_score": _on_clean_and_counts(quality.quality_scores),
    "before_after": _on_clean_and_counts(quality.before_after),
    "top_missing": _on_clean(quality.top_missing),
    "score_breakdown": _on_clean_and_counts(lambda c, n: quality.score_breakdown(quality.quality_scores(c, n))),
    # profile
    "overview": _on_clean(profile.overview),
    "job_distributions": _on_clean(profile.job_distributions),
    "top_titles": _on_clean(profile.top_titles),
    "top_companies": _on_clean(profile.top_companies),
    "company_summary": _on_clean(profile.company_summary),
    "top_places": _on_clean(profile.top_places),
    "remote_by_city": _on_clean(profile.remote_by_city),
    "salary_overall": _on_clean(_salary_overall),
    "salary_by_group": _on_clean(lambda c: profile.salary_profile(c).groups),
    "salary_by_city": _on_clean(lambda c: profile.salary_profile(c).by("by_city")),
    "experience_levels": _on_clean(profile.experience_levels),
    "experience_years": _on_clean(profile.experience_years),
    "insights": _on_clean(profile.insights),
    # skills in texts, and together
    "skill_mentions": _skill_mentions,
    "skill_demand": _skill_demand,
    "skill_pairs": _skill_pairs,
    "relative_dates": _on("orders", _told),
    "suppliers_together": _bought_together,
    # chart inputs
    "chart_shares": _on_clean(lambda c: charts.shares(c, "remote_type")),
    "chart_histogram": _on("orders", _histogram),
    "chart_density": _on("events", _density),
    "chart_box": _on("orders", _box),
    "chart_heatmap": _on("lineitem", charts.correlation_heatmap),
}
