"""Column mapping, the cleaning plan, duplicates and quality tables."""

import pytest
from pyspark.sql import functions as F

from postmill.operators.duplicates import count_exact_duplicates, keep_first
from postmill.operators.mapping import map_columns, normalize_columns
from postmill.plans import quality
from postmill.plans.cleaning import clean_postings
from postmill.schema import (
    CANONICAL_COLUMNS, EMPLOYMENT_TYPES, EXPERIENCE_LEVELS, REMOTE_TYPES, SALARY_PERIODS, SENIORITY_LEVELS,
)

RAW_NAMES = ["jobTitle", "companyName", "jobLocation", "workMode", "salaryRange", "experienceLevel", "jobDescription",
             "keySkills"]


def frame(spark, rows, columns):
    """Rows with an explicit order column."""
    schema = "pos int, " + ", ".join(columns)
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


def texts(*names):
    return [f"{n} string" for n in names]


def test_map_columns():
    m = map_columns(RAW_NAMES)
    assert m.targets == {
        "jobTitle": "job_title", "companyName": "company", "jobLocation": "location", "workMode": "remote_type",
        "experienceLevel": "experience", "jobDescription": "description", "keySkills": "skills",
    }
    assert m.salary_text == "salaryRange"


def test_map_columns_rules():
    assert map_columns(["Job Title", "job-location", "Min.Salary"]).targets == {
        "Job Title": "job_title", "job-location": "location", "Min.Salary": "salary_min"}
    custom = map_columns(["a", "title"], {"a": "job_title", "b": "company", "title": "experience"})
    assert custom.targets == {"a": "job_title"}
    assert map_columns(["min_salary", "max_salary", "pay"]).salary_text is None
    assert map_columns(["min_salary", "pay", "ctc"]).salary_text == "pay"
    assert map_columns(["role", "designation"]).targets == {"role": "job_title"}


def test_names_that_differ_in_case_only(spark):
    df = spark.createDataFrame([("Dev", "Pune", "MH", "x", "Monthly")], "`Job Title` string, Location string, State string, "
                               "City string, Salary_Period string")
    out, m = normalize_columns(df)
    row = out.first()
    assert m.targets == {"Job Title": "job_title", "Location": "location"}
    assert (row["State__raw"], row["City__raw"], row["Salary_Period__raw"], row["city"]) == ("MH", "x", "Monthly", None)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    twice = spark.createDataFrame([("1", "2")], "a string, b string")
    out, m = normalize_columns(twice, {"a": "job_title", "b": "job_title"})
    assert m.targets == {"a": "job_title"} and out.first()["job_title"] == "1" and out.first()["b"] == "2"


def test_order_must_be_named(spark):
    with pytest.raises(ValueError, match="order_by"):
        clean_postings(spark.createDataFrame([("Dev",)], "title string"))


def test_two_columns_for_one_target(spark):
    df = spark.createDataFrame([("Dev", "Engineer", "Pune", "Mumbai, IN")], "title string, job_title string, "
                               "city string, location string")
    out, m = normalize_columns(df)
    assert m.targets == {"job_title": "job_title", "location": "location"}
    row = out.first()
    assert row["job_title"] == "Engineer" and row["location"] == "Mumbai, IN" and row["title"] == "Dev"
    assert len(set(out.columns)) == len(out.columns) and set(CANONICAL_COLUMNS) <= set(out.columns)
    clash = spark.createDataFrame([("x", "y")], "id string, job_id string")
    out, _ = normalize_columns(clash, {"id": "job_id"})
    assert out.first()["job_id"] == "x" and out.first()["job_id__raw"] == "y"


def test_duplicates(spark):
    rows = [("Baker", "Oven & Co", "Ghent", "Early shifts")] * 2 + [
        ("Baker", "Oven & Co", "Ghent", "Late shifts"), ("Florist", "Petal", "Bruges", "Weekend work")]
    df = frame(spark, rows, texts("jobTitle", "companyName", "jobLocation", "jobDescription"))
    out = clean_postings(df, order_by=["pos"])
    counts = out.counts.first().asDict()
    assert counts == {
        "initial_rows": 4, "dropped_missing_title": 0, "exact_duplicates": 1, "likely_duplicates": 2,
        "processed_rows": 2, "invalid_salaries": 0, "invalid_experiences": 0, "invalid_dates": 0,
    }
    kept = {r["description"] for r in out.postings.collect()}
    assert kept == {"Early shifts", "Weekend work"}


def test_exact_duplicates_separate_nulls_and_boundaries(spark):
    df = spark.createDataFrame(
        [("a", None), ("a", None), (None, "a"), ("ab", "c"), ("a", "bc"), ("-", ""), (None, "")], "x string, y string"
    )
    assert count_exact_duplicates(df).first()[0] == 1
    assert count_exact_duplicates(df.where("false")).first()[0] == 0


def test_keep_first_does_not_depend_on_partitioning(spark):
    rows = [("hot" if i % 3 else f"k{i % 7}", None if i % 5 == 0 else "z", i) for i in range(500)]
    df = spark.createDataFrame(rows, "a string, b string, i int")
    expected = {}
    for a, b, i in rows:
        expected.setdefault((a, b), i)
    for parts in (1, 3, 16):
        got = {(r["a"], r["b"]): r["i"] for r in keep_first(df.repartition(parts), ["a", "b"], ["i"]).collect()}
        assert got == expected


def test_pipeline_frame(spark):
    rows = [
        ("<b>Surveyor</b>", "Plumb Line", "bengaluru", "3-5 LPA", "2-4 years", "Hybrid", "Field and office", "CAD, GIS, CAD"),
        ("Senior Chemist", "Retort", "Oslo, Viken, Norway", "$72,500", "6-9 years", "Remote", "Laboratory work", "HPLC"),
        ("Surveyor", "Plumb Line", "bengaluru", "3-5 LPA", "2-4 years", "Hybrid", "Field and office", "CAD, GIS, CAD"),
    ]
    names = ["jobTitle", "companyName", "jobLocation", "salaryRange", "experienceLevel", "workMode",
             "jobDescription", "keySkills"]
    out = clean_postings(frame(spark, rows, texts(*names)), order_by=["pos"])
    counts = out.counts.first()
    assert (counts["initial_rows"], counts["exact_duplicates"], counts["likely_duplicates"]) == (3, 0, 1)
    clean = {r["job_title"]: r for r in out.postings.collect()}
    a = clean["Surveyor"]
    assert len(clean) == 2 and a["company"] == "Plumb Line" and len(a["job_id"]) == 4 + 64
    assert (a["salary_min"], a["salary_max"], a["salary_midpoint"]) == (300000.0, 500000.0, 400000.0)
    assert (a["city"], a["state"], a["country"]) == ("Bangalore", "Karnataka", "India")
    assert a["skills"] == ["CAD", "GIS"] and a["skills_formatted"] == "CAD, GIS"
    assert a["experience_level"] == "Junior" and a["remote_type"] == "Hybrid" and a["validation_flags"] == "VALID"
    b = clean["Senior Chemist"]
    assert b["salary_currency"] == "USD" and b["seniority_level"] == "Senior"
    assert (b["city"], b["country"]) == ("Oslo", "Norway") and a["raw_salary_string"] == "3-5 LPA"


def test_logical_rules(spark):
    df = frame(spark, [("Data Analyst", 100000.0, 50000.0), ("Data Engineer", 50000.0, 80000.0)],
               ["jobTitle string", "salary_min double", "salary_max double"])
    out = clean_postings(df, order_by=["pos"])
    assert out.counts.first()["invalid_salaries"] == 1
    flags = {r["job_title"]: r for r in out.postings.collect()}
    assert flags["Data Analyst"]["validation_flags"] == "INVALID_SALARY_RANGE"
    assert flags["Data Engineer"]["validation_flags"] == "VALID"
    assert flags["Data Engineer"]["salary_midpoint"] == 65000.0
    assert flags["Data Engineer"]["salary_currency"] == "INR" and flags["Data Engineer"]["salary_period"] == "Annual"


def test_flags_titles_and_ids(spark):
    rows = [
        (None, " ", "x", "5-2 years", "Invalid Date"),
        ("7", "Dev", "x", "5-2 years", "Invalid Date"),
        (" ", "Ops", None, None, None),
        (None, "<br>", "y", None, None),
    ]
    df = frame(spark, rows, texts("id", "title", "company", "experience", "posted_date"))
    out = clean_postings(df, order_by=["pos"])
    counts = out.counts.first()
    assert counts["dropped_missing_title"] == 2 and counts["processed_rows"] == 2
    assert counts["invalid_experiences"] == 1 and counts["invalid_dates"] == 1
    clean = {r["job_title"]: r for r in out.postings.collect()}
    assert clean["Dev"]["validation_flags"] == "INVALID_EXPERIENCE_RANGE, INVALID_DATE_FORMAT"
    assert clean["Dev"]["job_id"] == "7" and len(clean["Ops"]["job_id"]) == 68
    assert clean["Ops"]["company"] == "Unknown" and clean["Ops"]["location"] == "Unknown"
    again = {r["job_title"]: r["job_id"] for r in clean_postings(df, order_by=["pos"]).postings.collect()}
    assert again["Ops"] == clean["Ops"]["job_id"]


@pytest.mark.parametrize("bound, from_text", [(None, True), ("7", False)])
def test_salary_text_only_without_any_bound(spark, bound, from_text):
    """One bound has a column of its own: a single value in it turns text parsing off."""
    df = frame(spark, [("Dev", "4-7 LPA", None), ("Ops", "$10", bound)], texts("title", "salary", "min_salary"))
    clean = {r["job_title"]: r for r in clean_postings(df, order_by=["pos"]).postings.collect()}
    if from_text:
        assert clean["Dev"]["salary_max"] == 700000.0 and clean["Ops"]["salary_currency"] == "USD"
    else:
        assert clean["Dev"]["salary_min"] is None and clean["Ops"]["salary_min"] == 7.0
        assert clean["Ops"]["salary_midpoint"] is None and clean["Ops"]["salary_currency"] == "INR"


def test_enumerations_and_strict_columns(spark):
    rows = [("Dev", "remote", "intern", "hello", "1 USD monthly"), ("Lead", "x", None, None, None)]
    df = frame(spark, rows, texts("title", "workMode", "jobType", "note", "pay"))
    clean = clean_postings(df, order_by=["pos"]).postings
    assert "note" in clean.columns
    strict = clean_postings(df, order_by=["pos"], strict=True).postings
    assert "note" not in strict.columns and "pay" not in strict.columns
    for column, allowed in [("remote_type", REMOTE_TYPES), ("employment_type", EMPLOYMENT_TYPES),
                            ("salary_period", SALARY_PERIODS), ("experience_level", EXPERIENCE_LEVELS),
                            ("seniority_level", SENIORITY_LEVELS)]:
        assert {r[0] for r in clean.select(column).collect()} <= set(allowed)


def test_array_skills_are_accepted(spark):
    df = spark.createDataFrame([(0, "Dev", ["SQL", "SQL", "Go"])], "pos int, title string, skills array<string>")
    out = clean_postings(df, order_by=["pos"])
    assert out.postings.first()["skills_formatted"] == "SQL, Go"
    assert out.counts.first()["exact_duplicates"] == 0
    missing = {r["Column"]: r["Missing_Count"] for r in quality.missing_values(out.postings).collect()}
    assert missing["skills"] == 0


def test_missing_values(spark):
    df = spark.createDataFrame([("Data Analyst", 50000.0, "Bangalore"), ("Data Engineer", None, "Unknown"),
                                ("ML Engineer", 80000.0, "")], "job_title string, salary_min double, location string")
    got = {r["Column"]: r for r in quality.missing_values(df).collect()}
    assert got["salary_min"].asDict() == {"Column": "salary_min", "Non_Null_Count": 2, "Missing_Count": 1,
                                          "Missing_Percentage": 33.33}
    assert got["location"]["Missing_Count"] == 2
    top = quality.top_missing(df, 2).collect()
    assert [r["Column"] for r in top] == ["location", "salary_min"]


PERFECT = ("job_title string, company string, location string, salary_min double, experience_level string, "
           "description_clean string, skills_formatted string, seniority_level string, remote_type string, "
           "employment_type string, validation_flags string")


def counts_row(spark, initial, exact, likely):
    return spark.createDataFrame([(initial, 0, exact, likely, 0, 0, 0, 0)], "initial_rows long, "
                                 "dropped_missing_title long, exact_duplicates long, likely_duplicates long, "
                                 "processed_rows long, invalid_salaries long, invalid_experiences long, "
                                 "invalid_dates long")


def test_quality_score(spark):
    rows = [("Tailor", "Hem", "Turin", 21e3, "Junior", "Repairs", "Sewing", "Junior", "Onsite", "Part-time", "VALID"),
            ("Pilot", "Skyway", "Lyon", 9e4, "Lead", "Long haul", "A320, B737", "Lead", "Onsite", "Full-time", "VALID")]
    df = spark.createDataFrame(rows, PERFECT)
    scores = quality.quality_scores(df, counts_row(spark, 2, 0, 0))
    assert set(scores.first().asDict().values()) == {100.0}
    assert [r["Dimension"] for r in quality.score_breakdown(scores).collect()] == [
        "Completeness", "Validity", "Uniqueness", "Consistency", "OVERALL"]
    worse = quality.quality_scores(df.withColumn("remote_type", F.lit("Unknown")), counts_row(spark, 4, 1, 2)).first()
    assert worse["uniqueness"] == 25.0 and worse["consistency"] == 75.0
    assert worse["overall_quality_score"] == pytest.approx(35 + 25 + 5 + 15)
    empty = quality.quality_scores(df.where("false"), counts_row(spark, 0, 0, 0)).first()
    assert set(empty.asDict().values()) == {0.0}
    assert quality.quality_scores(df.select("job_title")).first()["validity"] == 100.0


def test_reports(spark):
    rows = [("job_1", "Data Analyst", "Acme", "Bangalore", 6e5, "VALID"),
            ("job_2", "Data Engineer", "TechCorp", "Unknown", None, "VALID")]
    df = spark.createDataFrame(rows, "job_id string, job_title string, company string, location string, "
                               "salary_min double, validation_flags string")
    counts = counts_row(spark, 3, 1, 1)
    table = {r["Metric"]: (r["Before"], r["After"]) for r in quality.before_after(df, counts).collect()}
    assert table == {
        "Rows": ("3", "2"), "Exact Duplicates": ("1", "0"), "Likely Duplicates": ("1", "0"),
        "Missing Salary %": ("N/A", "50.00%"), "Missing Location %": ("N/A", "50.00%"), "Invalid Salary": ("0", "0"),
        "Invalid Dates": ("0", "0"),
    }
    report = quality.quality_report(df, counts).first()
    assert report["total_rows"] == 2 and report["total_columns"] == 6
    assert len(report["missing_value_analysis"]) == 6
    assert report["data_quality_scores"]["overall_quality_score"] > 0
    summary = quality.cleaning_summary(df, counts).first()
    assert summary["cleaning_statistics"]["initial_rows"] == 3 and len(summary["before_after_comparison"]) == 7
