"""Profile, chart inputs, readers, writers and the two jobs."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from postmill.plans import charts, profile
from postmill.plans.jobs import load_or_clean, run_cleaning, run_profile
from postmill.plans.cleaning import clean_postings
from postmill.sources import readers, staging, writers


def test_overview(eda):
    got = profile.overview(eda).first().asDict()
    assert got == {
        "total_job_postings": 8, "unique_companies": 4, "unique_locations": 3, "unique_job_titles": 4,
        "unique_skills": 8, "min_date": "2025-11-03", "max_date": "2026-03-09", "remote_job_percentage": 25.0,
        "salary_completeness_pct": 100.0, "experience_completeness_pct": 100.0,
    }


def test_overview_without_rows_or_columns(spark, eda):
    empty = profile.overview(eda.where("false")).first()
    assert empty["total_job_postings"] == 0 and empty["min_date"] == "N/A" and empty["remote_job_percentage"] == 0.0
    bare = profile.overview(spark.createDataFrame([("a",), ("Unknown",), (None,)], "company string")).first()
    assert bare["total_job_postings"] == 3 and bare["unique_companies"] == 1 and bare["unique_skills"] == 0
    text = spark.createDataFrame([("a, b",), (" b ,",)], "skills string")
    assert profile.distinct_skills(text).first()[0] == 2
    dated = spark.createDataFrame([("03/02/2024",), ("2024-05-06T10:00:00",), ("soon",)], "posted_date string")
    got = profile.overview(dated).first()
    assert (got["min_date"], got["max_date"]) == ("2024-02-03", "2024-05-06")


def test_distributions_and_titles(eda):
    dist = {(r["dimension"], r["value"]): (r["count"], r["percentage"]) for r in
            profile.job_distributions(eda).collect()}
    assert dist["remote_type", "Remote"] == (2, 25.0) and dist["posted_year", "2026"] == (5, 62.5)
    top = profile.top_titles(eda, 5).collect()
    assert (top[0]["job_title"], top[0]["count"], top[0]["percentage"]) == ("Nurse", 3, 37.5) and len(top) == 4


def test_companies_and_places(eda):
    summary = profile.company_summary(eda).first().asDict()
    assert summary == {"total_unique_companies": 4, "mean_postings_per_company": 2.0,
                       "median_postings_per_company": 2.0}
    assert profile.company_summary(eda.where("false")).first()["total_unique_companies"] == 0
    assert profile.top_companies(eda, 5).first()["company"] == "Lingua"
    places = profile.top_places(eda, 5)
    assert places.where("dimension = 'city'").count() == 3
    table = {r["city"]: (r["Remote"], r["Hybrid"], r["Onsite"], r["Unknown"], r["other"]) for r in
             profile.remote_by_city(eda).collect()}
    assert table == {"Leeds": (1, 0, 2, 0, 0), "Hull": (0, 0, 3, 0, 0), "Porto": (1, 1, 0, 0, 0)}


def test_salaries_and_experience(spark, eda):
    p = profile.salary_profile(eda)
    assert p.target.first().asDict() == {"total_salary_records": 8, "target_column_used": "salary_midpoint"}
    overall = p.overall.first()
    assert overall["min"] == 25000.0 and overall["max"] == 50000.0
    by_level = {r["experience_level"]: r for r in p.by("by_experience").collect()}
    assert by_level["Mid Level"]["count"] == 5 and by_level["Mid Level"]["median"] == 33000.0
    assert {r["city"] for r in p.by("by_city").collect()} == {"Leeds", "Hull", "Porto"}
    one_city = profile.salary_profile(eda.where("job_id in ('p1', 'p2', 'p7')")).by("by_city").collect()
    assert [r["city"] for r in one_city] == ["Leeds"]
    low = profile.salary_profile(eda.withColumn("salary_midpoint", F.lit(None).cast("double")))
    assert low.target.first()["target_column_used"] == "salary_min" and low.overall.first()["max"] == 42000.0
    empty = profile.salary_profile(spark.createDataFrame([("x",)], "a string"))
    assert empty.target.first()["total_salary_records"] == 0 and empty.overall.first()["count"] == 0
    levels = {r["value"]: r["count"] for r in profile.experience_levels(eda).collect()}
    assert levels["Mid Level"] == 5
    years = {r["field"]: r for r in profile.experience_years(eda).collect()}
    assert years["experience_max_years"]["max"] == 10.0 and years["experience_min_years"]["mode"] == 2.0


def test_insights(eda):
    got = profile.insights(eda).collect()
    assert [r["topic"] for r in got] == ["Most frequent title", "Remote share", "Stated pay"]
    assert got[0]["evidence"] == "3 of 8 postings carry it (37.5%)."
    assert "25.0%" in got[1]["finding"] and "33500.0" in got[2]["finding"]
    assert got[2]["evidence"].startswith("8 of 8")
    assert profile.insights(eda.where("false")).count() == 0
    untitled = profile.insights(eda.withColumn("job_title", F.lit("Unknown"))).collect()
    assert len(untitled) == 2


def test_histogram_and_density(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 1, 5, 10]], "x double")
    bars = {r["bin"]: r for r in charts.histogram(df, "x", 10).collect()}
    assert [bars[i]["count"] for i in range(10)] == [1, 2, 0, 0, 0, 1, 0, 0, 0, 1]
    assert (bars[9]["low"], bars[9]["high"]) == (9.0, 10.0)
    assert charts.histogram(df.limit(1), "x").count() == 0
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert sum(r["count"] for r in charts.histogram(same, "x").collect()) == 2
    curve = charts.density(df, "x", 5).orderBy("x").collect()
    assert [r["x"] for r in curve] == [0.0, 2.5, 5.0, 7.5, 10.0]
    values = [0, 1, 1, 5, 10]
    mean = sum(values) / 5
    h = math.sqrt(sum((v - mean) ** 2 for v in values) / 4) * 5 ** -0.2
    for r in curve:
        exact = sum(math.exp(-0.5 * ((r["x"] - v) / h) ** 2) for v in values) / (5 * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(exact, rel=1e-6)


def test_box_plot(spark):
    rows = [("a", float(x)) for x in [10, 12, 14, 15, 16, 18, 20, 1000]] + [("Unknown", 1.0), (None, 2.0), ("b", 4.0)]
    got = {r["g"]: r.asDict() for r in charts.box_plot(spark.createDataFrame(rows, "g string, x double"), "g", "x").collect()}
    assert set(got) == {"a", "b"}
    assert got["a"] == {"g": "a", "count": 8, "q1": 13.5, "median": 15.5, "q3": 18.5, "whisker_low": 10.0,
                        "whisker_high": 20.0, "outliers": 1}


def test_heatmap_and_tables(spark, eda):
    cells = charts.correlation_heatmap(eda).collect()
    assert len(cells) == 25 and not any("posted" in r["col_a"] for r in cells)
    assert charts.correlation_heatmap(eda.limit(2)).count() == 0
    assert set(charts.chart_tables(eda)) == {
        "remote_work_distribution", "employment_type_distribution", "top_job_titles", "top_companies",
        "top_locations", "experience_distribution", "salary_histogram", "salary_density", "salary_box_experience",
        "correlation_heatmap"}


RAW_CSV = '''jobId,jobTitle,companyName,jobLocation,salaryRange,experienceLevel,jobDescription,postedDate,keySkills
7,"Data, Analyst",Acme,Bangalore,4-7 LPA,1-3 years,"Line one
says ""hybrid""",2026-03-15,"Python, SQL"
NA,Engineer,N/A,"London, England, UK",Not Disclosed,,<p>Spark &amp; SQL</p>,15-03-2026,Spark|AWS
NA,Engineer,N/A,"London, England, UK",Not Disclosed,,<p>Spark &amp; SQL</p>,15-03-2026,Spark|AWS
,nan,Acme,Pune,,,,bad,
'''


@pytest.fixture
def raw_dir(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text(RAW_CSV)
    return raw


def test_read_raw(spark, raw_dir, tmp_path):
    df = readers.read_raw(spark, str(raw_dir))
    rows = df.orderBy("_ord").collect()
    assert len(rows) == 4 and rows[0]["jobDescription"] == 'Line one\nsays "hybrid"'
    assert rows[1]["jobId"] is None and rows[1]["companyName"] is None and rows[3]["jobTitle"] is None
    (tmp_path / "none").mkdir()
    assert readers.read_raw(spark, str(tmp_path / "none")) is None
    assert readers.read_raw(spark, str(tmp_path / "absent")) is None


def test_read_json_and_parquet(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"title": "Dev", "skills": ["a", "b"]}\n{"title": "Ops"}\n')
    df = readers.read_raw(spark, str(tmp_path / "j"), "json")
    assert df.count() == 2
    df.drop("_ord").write.parquet(str(tmp_path / "p"))
    assert readers.read_raw(spark, str(tmp_path / "p"), "parquet").count() == 2


def test_sources_with_different_headers(spark, raw_dir, tmp_path):
    other = tmp_path / "other"
    other.mkdir()
    (other / "b.csv").write_text("title,employer,extra\nTester,Beta,1\n")
    df = readers.read_raw_sources(spark, [str(raw_dir), str(other), str(tmp_path / "absent")])
    titles = {(r["job_title"], r["company"]) for r in df.collect()}
    assert ("Tester", "Beta") in titles and ("Data, Analyst", "Acme") in titles and df.count() == 5


def json_of(path):
    part = next(p for p in os.listdir(path) if p.startswith("part-"))
    with open(os.path.join(path, part)) as f:
        return json.loads(f.read())


def test_jobs_end_to_end(spark, raw_dir, tmp_path):
    out = str(tmp_path / "out")
    clean = load_or_clean(spark, out, str(raw_dir))
    rows = {r["job_title"]: r for r in clean.collect()}
    assert set(rows) == {"Data, Analyst", "Engineer"}
    assert rows["Data, Analyst"]["remote_type"] == "Hybrid" and rows["Data, Analyst"]["salary_max"] == 700000.0
    assert rows["Engineer"]["description_clean"] == "Spark & SQL" and rows["Engineer"]["company"] == "Unknown"
    summary = json_of(f"{out}/quality/cleaning_summary")
    assert summary["cleaning_statistics"]["initial_rows"] == 4
    assert summary["cleaning_statistics"]["exact_duplicates"] == 1
    assert summary["cleaning_statistics"]["dropped_missing_title"] == 1
    assert json_of(f"{out}/quality/data_quality_report")["total_rows"] == 2
    assert load_or_clean(spark, out, str(tmp_path / "absent")).count() == 2
    assert run_cleaning(spark, str(tmp_path / "absent"), str(tmp_path / "o2")) is None

    target = str(tmp_path / "profile")
    assert run_profile(spark, f"{out}/clean", target)
    nested = json_of(f"{target}/summaries/eda_summary")
    assert set(nested) == {"dataset_overview", "job_distributions", "company_summary", "location_summary",
                           "salary_summary", "experience_summary"}
    assert nested["dataset_overview"]["total_job_postings"] == 2
    titles = spark.read.csv(f"{target}/statistics/top_job_titles", header=True)
    assert titles.count() == 2
    assert os.path.isdir(f"{target}/charts/remote_work_distribution")
    assert not run_profile(spark, str(tmp_path / "absent"), target)


def test_job_options_and_mixed_folders(spark, raw_dir, tmp_path):
    other = tmp_path / "other"
    other.mkdir()
    (other / "b.csv").write_text("role_txt,employer,posted_date\nTester,Beta,2025-01-02\n")
    out = str(tmp_path / "mixed")
    clean = load_or_clean(spark, out, [str(raw_dir), str(other)], custom_mapping={"role_txt": "job_title"},
                          id_hex_digits=12, partition_by="posted_year", multi_line=True, partitions=3)
    rows = {r["job_title"]: r for r in clean.collect()}
    assert set(rows) == {"Data, Analyst", "Engineer", "Tester"} and len(rows["Tester"]["job_id"]) == 16
    assert os.path.isdir(f"{out}/clean/posted_year=2025")


def test_derived_ids_do_not_depend_on_splits(spark, tmp_path):
    lines = [f"Title {i % 40},Firm {i % 9},Town {i}" for i in range(600)]
    raw = tmp_path / "ids"
    raw.mkdir()
    for k in range(3):
        (raw / f"{k}.csv").write_text("title,company,location\n" + "\n".join(lines[k::3]) + "\n")
    seen = []
    for size, parts in (("1000", None), ("128m", 5)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        clean = clean_postings(readers.read_raw(spark, str(raw), multi_line=False, partitions=parts)).postings
        seen.append({(r["job_title"], r["company"], r["location"]): r["job_id"] for r in clean.collect()})
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(seen[0]) == 600 and seen[0] == seen[1] and len(set(seen[0].values())) == 600


def test_staging_refuses_a_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.staging_folder(Session())


def test_clean_csv_export(spark, eda, tmp_path):
    writers.write_clean_csv(eda, str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True)
    assert back.where("job_id = 'p1'").first()["skills"] == "Triage, Charting"
    writers.write_clean(eda, str(tmp_path / "pq"), "posted_year")
    assert readers.read_clean(spark, str(tmp_path / "pq")).count() == 8
