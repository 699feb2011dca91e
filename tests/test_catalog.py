"""Registered queries: each agrees with DuckDB, and plans have the intended shape."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog.bindings import raw_postings, table
from catalog.oracles import ORACLES
from catalog.spark_queries import QUERIES
from compare import connect, difference
from postmill.operators.describe import grouped_stats
from postmill.operators.duplicates import keep_first
from postmill.plans.cleaning import clean_postings
from postmill.plans import profile


@pytest.fixture(scope="module")
def duck(data_dir):
    return connect(data_dir)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_duckdb(spark, duck, data_dir, name):
    assert difference(spark, duck, name, data_dir) is None


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["l_returnflag", "count", "mean", "median", "std", "min", "max"]


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_duplicates_are_cut_before_the_shuffle(spark, data_dir):
    text = plan(keep_first(table(spark, data_dir, "documents"), ["text"], ["doc_id"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_scans_read_only_needed_columns(spark, data_dir):
    text = plan(grouped_stats(table(spark, data_dir, "lineitem"), "l_returnflag", "l_extendedprice"))
    schemas = {line.split("ReadSchema: ")[1] for line in text.splitlines() if "ReadSchema" in line}
    assert schemas == {"struct<l_extendedprice:double,l_returnflag:string>"}
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_profile_of_lazy_clean_table_skips_unused_parsers(spark, data_dir):
    clean = clean_postings(raw_postings(spark, data_dir), order_by=["row_no"]).postings
    text = clean.select("job_id", "city")._jdf.queryExecution().optimizedPlan().toString()
    assert "apprentice" not in text and "telecommute" not in text


def test_repartitioning_does_not_change_results(spark, data_dir):
    raw = raw_postings(spark, data_dir)
    results = []
    for parts in (1, 7):
        clean = clean_postings(raw.repartition(parts), order_by=["row_no"]).postings
        results.append((
            sorted(tuple(r) for r in clean.select("job_id", "job_title", "company", "posted_date").fillna("").collect()),
            sorted(map(tuple, profile.top_places(clean).collect())),
            sorted(map(tuple, profile.remote_by_city(clean).collect())),
        ))
    assert results[0] == results[1]


def test_invariants(spark, data_dir):
    out = clean_postings(raw_postings(spark, data_dir), order_by=["row_no"])
    n = out.postings.count()
    counts = out.counts.first()
    assert counts["processed_rows"] == n
    assert counts["initial_rows"] == n + counts["dropped_missing_title"] + counts["likely_duplicates"]
    totals = profile.job_distributions(out.postings).groupBy("dimension").agg(F.sum("count").alias("n")).collect()
    assert all(r["n"] <= n for r in totals)
