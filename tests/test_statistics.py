"""Statistics operators against hand-written values, pandas-style definitions and brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from postmill.operators.correlation import correlation_matrix, correlations
from postmill.operators.describe import categorical_stats, grouped_stats, numeric_stats
from postmill.operators.frequency import cross_table, distributions, top_values, top_values_per_column
from postmill.operators.outliers import flag_outliers, iqr_outliers, zscore_outliers
from postmill.operators import quantiles
from postmill.plans.charts import box_plot
from postmill.plans.profile import insights, salary_profile
from postmill.operators.quantiles import exact_quantiles


def numbers(spark, values, name="x", kind="double"):
    return spark.createDataFrame([(None if v is None else (float(v) if kind == "double" else v),) for v in values],
                                 f"{name} {kind}")


def linear(values, p):
    values = sorted(values)
    place = (len(values) - 1) * p
    low, high = values[math.floor(place)], values[math.ceil(place)]
    return low + (high - low) * (place - math.floor(place))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_numeric_stats(spark):
    got = one(numeric_stats(numbers(spark, [10, 20, 30, 40, 50, 100]), "x"))
    assert got["count"] == 6 and got["mean"] == 41.6667 and got["median"] == 35.0
    assert (got["q1"], got["q2"], got["q3"], got["iqr"]) == (22.5, 35.0, 47.5, 25.0)
    assert (got["min"], got["max"], got["mode"]) == (10.0, 100.0, 10.0)
    assert got["std"] == 31.8852 and got["variance"] == 1016.6667


def test_numeric_stats_edges(spark):
    empty = one(numeric_stats(numbers(spark, [None, "x"], kind="string"), "x"))
    assert empty.pop("count") == 0 and set(empty.values()) == {None}
    single = one(numeric_stats(numbers(spark, [7]), "x"))
    assert single["count"] == 1 and single["std"] == 0.0 and single["variance"] == 0.0 and single["q3"] == 7.0
    text = one(numeric_stats(numbers(spark, ["5", "3", "3", "bad", None], kind="string"), "x"))
    assert text["count"] == 3 and text["mode"] == 3.0 and text["median"] == 3.0


@pytest.mark.parametrize("seed", range(4))
def test_quantiles_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    shapes = [
        lambda: rng.random(),
        lambda: float(rng.choice([0, 0, 0, 1, 5])),
        lambda: round(rng.expovariate(1), 2),
        lambda: rng.choice([1.0, rng.random() * 1e9]),
    ]
    values = [shapes[seed]() for _ in range(20_000 + seed)]
    df = numbers(spark, values)
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, F.col("x"), ps).first()["q"]
    assert got == pytest.approx([linear(values, p) for p in ps], rel=1e-12)


@pytest.mark.parametrize("few, slices", [(True, 1024), (False, 1024), (False, 4)])
def test_grouped_quantiles_equal_brute_force(spark, few, slices, monkeypatch):
    """Both join forms, with one group holding most rows, and slices that hold many values."""
    monkeypatch.setattr(quantiles, "_SLICES", slices)
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.7 else f"g{rng.randrange(5)}", rng.gauss(0, 1)) for _ in range(15_000)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["q"] for r in exact_quantiles(df, F.col("x"), [0.25, 0.5], by=["g"], few_groups=few).collect()}
    for g in {g for g, _ in rows}:
        values = [x for k, x in rows if k == g]
        assert got[g] == pytest.approx([linear(values, 0.25), linear(values, 0.5)], rel=1e-12)


def test_building_plans_starts_no_job(spark, eda):
    """Jobs get ascending numbers, so a probe before and one after are neighbours."""
    tracker = spark.sparkContext.statusTracker()

    def probe(name):
        spark.sparkContext.setJobGroup(name, name)
        spark.range(1).rdd.count()
        return max(tracker.getJobIdsForGroup(name))

    before = probe("before")
    grouped_stats(eda, "city", "salary_min")
    box_plot(eda, "experience_level", "salary_min")
    salary_profile(eda)
    insights(eda)
    assert probe("after") == before + 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_absent_columns_and_empty_frames(spark, eda):
    assert grouped_stats(eda, "absent", "salary_min").collect() == []
    assert grouped_stats(eda, "city", "absent").columns == ["city", "count", "mean", "median", "std", "min", "max"]
    assert correlations(eda.where("false"), ["salary_min", "salary_max"], "spearman").collect() == []


def test_categorical_stats(spark):
    got = one(categorical_stats(numbers(spark, ["Remote", "Remote", "Hybrid", "Onsite", "Remote"], kind="string"), "x"))
    assert got == {"count": 5, "non_null_count": 5, "unique": 3, "top": "Remote", "freq": 3, "percentage": 60.0}
    got = one(categorical_stats(numbers(spark, ["Unknown", "", None, "nan"], kind="string"), "x"))
    assert got == {"count": 4, "non_null_count": 0, "unique": 0, "top": "N/A", "freq": 0, "percentage": 0.0}
    got = one(categorical_stats(numbers(spark, [" b", "a ", None], kind="string"), "x"))
    assert got["top"] == "a" and got["percentage"] == 33.33


def test_grouped_stats(spark):
    df = spark.createDataFrame(
        [("a", "1"), ("a", "2"), ("a", "x"), ("b", "5"), (None, "9"), ("c", None)], "g string, v string"
    )
    got = {r["g"]: r.asDict() for r in grouped_stats(df, "g", "v").collect()}
    assert set(got) == {"a", "b"}
    assert got["a"] == {"g": "a", "count": 2, "mean": 1.5, "median": 1.5, "std": 0.71, "min": 1.0, "max": 2.0}
    assert got["b"]["std"] == 0.0
    assert [r["g"] for r in grouped_stats(df, "g", "v", min_group_size=2).collect()] == ["a"]


def test_outliers(spark):
    df = numbers(spark, [10, 12, 14, 15, 16, 18, 20, 1000])
    iqr = one(iqr_outliers(df, "x", 1.5))
    assert iqr["method"] == "IQR" and iqr["outlier_count"] == 1 and iqr["high_outlier_count"] == 1
    assert iqr["low_outlier_count"] == 0 and iqr["outlier_percentage"] == 12.5
    assert (iqr["q1"], iqr["q3"], iqr["lower_bound"], iqr["upper_bound"]) == (13.5, 18.5, 6.0, 26.0)
    z = one(zscore_outliers(df, "x", 2.0))
    assert z["method"] == "Z-Score" and z["outlier_count"] == 1
    flagged = [r["x"] for r in flag_outliers(df, "x").where("is_outlier").collect()]
    assert flagged == [1000.0]


def test_outliers_edges(spark):
    none = one(iqr_outliers(numbers(spark, []), "x"))
    assert none["total_records"] == 0 and none["q1"] is None and none["outlier_percentage"] == 0.0
    z = one(zscore_outliers(numbers(spark, [3]), "x"))
    assert z["total_records"] == 1 and z["mean"] is None and z["outlier_count"] == 0
    z = one(zscore_outliers(numbers(spark, [3, 3, 3]), "x"))
    assert z["mean"] == 3.0 and z["std"] == 0.0 and z["outlier_count"] == 0


def average_rank(values):
    return [sum(v < x for v in values) + (sum(v == x for v in values) + 1) / 2 for x in values]


def pearson(a, b):
    ma, mb = sum(a) / len(a), sum(b) / len(b)
    sab = sum((x - ma) * (y - mb) for x, y in zip(a, b))
    saa, sbb = sum((x - ma) ** 2 for x in a), sum((y - mb) ** 2 for y in b)
    return sab / math.sqrt(saa * sbb)


def test_correlations(spark, eda):
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in
           correlations(eda, ["salary_midpoint", "experience_min_years", "absent"]).collect()}
    assert len(got) == 4 and got["salary_midpoint", "experience_min_years"] > 0.5
    assert got["salary_midpoint", "salary_midpoint"] == 1.0
    wide = {r["column"]: r["experience_min_years"] for r in
            correlation_matrix(eda, ["salary_midpoint", "experience_min_years"]).collect()}
    assert wide["salary_midpoint"] == got["salary_midpoint", "experience_min_years"]
    assert correlations(eda, ["salary_midpoint"]).count() == 0


def test_constant_column_correlates_as_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, None)], "a double, b double")
    for method in ("pearson", "spearman"):
        got = {(r["col_a"], r["col_b"]): r["corr"] for r in correlations(df, ["a", "b"], method).collect()}
        assert got["a", "a"] == 1.0 and got["a", "b"] is None and got["b", "b"] is None


def test_spearman_equals_brute_force_with_hot_values(spark):
    rng = random.Random(3)
    a = [0.0 if rng.random() < 0.6 else round(rng.random(), 2) for _ in range(600)]
    b = [x + rng.choice([0.0, 1.0, rng.random()]) for x in a]
    c = [float(rng.randrange(3)) for _ in a]
    df = spark.createDataFrame(list(zip(a, b, c)), "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in correlations(df, ["a", "b", "c"], "spearman").collect()}
    ranks = {"a": average_rank(a), "b": average_rank(b), "c": average_rank(c)}
    for x in "abc":
        for y in "abc":
            assert got[x, y] == pytest.approx(pearson(ranks[x], ranks[y]), abs=6e-5)


def test_frequency_tables(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("b ", "x"), ("b", None), ("Unknown", "x"), (None, "x")], "k string, m string"
    )
    top = [tuple(r) for r in top_values(df, "k", 2).collect()]
    assert top == [("a", 2, 33.33), ("b", 2, 33.33)]
    dist = {(r["dimension"], r["value"]): r["count"] for r in distributions(df, ["k", "m", "absent"]).collect()}
    assert dist["k", "Unknown"] == 1 and dist["m", "x"] == 4 and ("k", None) not in dist
    places = top_values_per_column(df, ["k", "m"], 1).collect()
    assert {(r["dimension"], r["value"], r["count"]) for r in places} == {("k", "a", 2), ("m", "x", 4)}
    table = {r["k"]: (r["x"], r["other"]) for r in cross_table(df, "k", "m", ["x"]).collect()}
    assert table == {"a": (1, 1)}
