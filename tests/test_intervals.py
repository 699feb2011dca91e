"""Intervals of means and medians against brute force, and how often they hold."""

import math
import random
import statistics
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from postmill.functions.tails import t_point
from postmill.operators.intervals import group_intervals


def t_mass(t, df):
    """Mass of Student's t within t of zero, by Simpson's rule."""
    steps = 20_000
    scale = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    heights = [(1 + (t * i / steps) ** 2 / df) ** (-(df + 1) / 2) for i in range(steps + 1)]
    return 2 * scale * t / steps / 3 * (heights[0] + heights[-1] + 4 * sum(heights[1:-1:2]) + 2 * sum(heights[2:-1:2]))


@pytest.mark.parametrize("level", [0.5, 0.95, 0.999])
def test_points_of_t(spark, level):
    sizes = [0, 1, 2, 3, 4, 5, 17, 60, 61, 75, 500, 100_000]
    df = spark.createDataFrame([(k,) for k in sizes], "k long")
    got = {r.k: r.t for r in df.select("k", t_point(F.col("k"), level).alias("t")).collect()}
    assert got.pop(0) is None
    for k, t in got.items():
        assert t_mass(t, k) == pytest.approx(level, abs=1e-7 if t < 200 else 1e-3)


def order_ranks(n, level):
    """Lower rank by adding binomial coefficients, in fractions."""
    rank, error = 0, (1 - Fraction(str(level))) / 2
    while rank < n and Fraction(sum(math.comb(n, h) for h in range(rank + 1)), 2**n) <= error:
        rank += 1
    return rank


@pytest.mark.parametrize("bits", [10, 2])
def test_intervals_equal_brute_force(spark, bits):
    rng = random.Random(bits)
    sizes = {"one": 1, "two": 2, "five": 5, "six": 6, "some": 41, "edge": 200, "hot": 1500}
    rows = [(g, rng.choice([0.0, -0.0, 1.0]) if rng.random() < 0.3 else rng.lognormvariate(0, 2)) for g, n in sizes.items() for _ in range(n)]
    rows += [("same", 3.0)] * 50
    noise = [(None, 1.0), ("some", None), ("some", float("nan")), ("only null", None)]
    groups = defaultdict(list)
    for g, v in rows:
        groups[g].append(v)
    got = group_intervals(spark.createDataFrame(rows + noise, "g string, v double").repartition(4), "g", "v", 0.9, bits).collect()
    assert sorted(r.g for r in got) == sorted(groups)
    for r in got:
        values = sorted(groups[r.g])
        n = len(values)
        assert r.n == n and r["mean"] == pytest.approx(statistics.fmean(values)) and r.median == pytest.approx(statistics.median(values))
        rank = order_ranks(n, 0.9) if n <= 200 else math.floor(n / 2 + 0.5 - statistics.NormalDist().inv_cdf(0.95) * math.sqrt(n) / 2)
        if n > 200:
            assert abs(rank - order_ranks(n, 0.9)) <= 1
        assert (r.median_low, r.median_high) == ((values[rank - 1], values[n - rank]) if rank else (None, None))
        if n == 1:
            assert r.mean_low is None and r.mean_high is None
        else:
            reach = r.mean_high - r["mean"]
            assert reach == pytest.approx(r["mean"] - r.mean_low)
            sd = statistics.stdev(values)
            assert reach == 0 if sd == 0 else t_mass(reach / sd * math.sqrt(n), n - 1) == pytest.approx(0.9, abs=1e-6)


def test_intervals_hold_as_often_as_said(spark):
    rng = random.Random(5)
    rows = [(g, rng.expovariate(1.0)) for g in range(600) for _ in range(15 + g % 30)]
    got = group_intervals(spark.createDataFrame(rows, "g int, v double"), "g", "v").collect()
    assert len(got) == 600
    assert sum(r.median_low <= math.log(2) <= r.median_high for r in got) / 600 > 0.94
    assert sum(r.mean_low <= 1 <= r.mean_high for r in got) / 600 > 0.88  # skewed values cost the mean some of its level


def test_intervals_of_text_and_of_nothing(spark):
    assert group_intervals(spark.createDataFrame([], "g string, v string"), "g", "v").collect() == []
    got = group_intervals(spark.createDataFrame([("a", "2"), ("a", "word"), ("a", "4.0")], "g string, v string"), "g", "v").collect()
    assert [(r.g, r.n, r["mean"], r.median, r.median_low) for r in got] == [("a", 2, 3.0, 3.0, None)]
