"""Rank tests and contingency tests against brute force and closed forms."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from postmill.functions.tails import chi_square_tail, normal_two_sided
from postmill.operators.inference import chi_square, kruskal_wallis, mann_whitney, rank_cells


def tail(x, df):
    """Chi-square tail by its finite sum, terms by the gamma function."""
    h = x / 2
    if df % 2:
        powers, base = [k + 0.5 for k in range((df - 1) // 2)], math.erfc(math.sqrt(h))
    else:
        powers, base = list(range(1, df // 2)), math.exp(-h)
    return base + sum(math.exp(p * math.log(h) - h - math.lgamma(p + 1)) for p in powers)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_tails(spark):
    cases = [(x, d) for x in (1e-9, 0.3, 1.0, 3.84, 7.9, 8.1, 30.0, 900.0, 2500.0) for d in (1, 2, 3, 4, 7, 40, 801, 2000)]
    df = spark.createDataFrame(cases, "x double, d int")
    for r in df.select("x", "d", chi_square_tail(F.col("x"), F.col("d")).alias("p")).collect():
        assert r.p == pytest.approx(min(tail(r.x, r.d), 1.0), rel=1e-9, abs=1e-300)
    zs = spark.createDataFrame([(z,) for z in (0.0, -0.5, 1.96, 2.8284, 2.8285, 4.0, -9.0)], "z double")
    for r in zs.select("z", normal_two_sided(F.col("z")).alias("p")).collect():
        assert r.p == pytest.approx(math.erfc(abs(r.z) / math.sqrt(2)), rel=1e-10)
    odd = spark.createDataFrame([(0.0, 3), (-1.0, 2), (None, 2), (1.0, 0), (2e6, 2_000_000)], "x double, d int")
    got = [r.p for r in odd.select(chi_square_tail(F.col("x"), F.col("d")).alias("p")).collect()]
    assert got[:4] == [1.0, 1.0, None, None] and got[4] == pytest.approx(0.4998, abs=2e-4)


def ranks(values):
    counts, at, out = Counter(values), 0, {}
    for v in sorted(counts):
        out[v] = at + (counts[v] + 1) / 2
        at += counts[v]
    return out, sum(t**3 - t for t in counts.values())


def samples(seed):
    rng = random.Random(seed)
    value = [lambda: rng.gauss(0, 1), lambda: float(rng.choice([0, 0, 0, 1, 2, 9])), lambda: rng.choice([-0.0, 0.0, rng.random()])][seed]
    return [("hot" if rng.random() < 0.6 else f"g{rng.randrange(4)}", value()) for _ in range(3000)]


@pytest.mark.parametrize("seed, bits", [(0, 10), (0, 3), (1, 10), (2, 5)])
def test_rank_tests_equal_brute_force(spark, seed, bits):
    rows = samples(seed)
    df = spark.createDataFrame(rows + [(None, 1.0), ("g1", None), ("g1", float("nan"))], "g string, x double").repartition(5)
    of, tied = ranks([x for _, x in rows])
    cells = rank_cells(df, "x", "g", bits).collect()
    assert sum(c.n for c in cells) == len(rows) and all(c.rank2 == 2 * of[c.v] for c in cells)
    groups = defaultdict(list)
    for g, x in rows:
        groups[g].append(of[x])
    n = len(rows)
    h = 12 / (n * (n + 1)) * sum(sum(r) ** 2 / len(r) for r in groups.values()) - 3 * (n + 1)
    h /= 1 - tied / (n**3 - n)
    got = one(kruskal_wallis(df, "x", "g"))
    assert (got["n"], got["n_groups"], got["df"]) == (n, 5, 4)
    assert got["h"] == pytest.approx(h, rel=1e-8) and got["p_value"] == pytest.approx(tail(h, 4), abs=1e-9)
    assert got["epsilon_squared"] == pytest.approx(h / (n - 1), rel=1e-8)

    a, b = [x for g, x in rows if g == "hot"], [x for g, x in rows if g == "g2"]
    u = sum((x > y) + (x == y) / 2 for x in a for y in b)
    _, tied = ranks(a + b)
    m = len(a) + len(b)
    sigma = math.sqrt(len(a) * len(b) / 12 * (m + 1 - tied / (m * (m - 1))))
    z = math.copysign(max(abs(u - len(a) * len(b) / 2) - 0.5, 0), u - len(a) * len(b) / 2) / sigma
    got = one(mann_whitney(df, "x", "g", "hot", "g2"))
    assert (got["n_first"], got["n_second"], got["u"]) == (len(a), len(b), u)
    assert got["z"] == pytest.approx(z) and got["p_value"] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-9)
    assert got["superiority"] == pytest.approx(u / len(a) / len(b))
    turned = one(mann_whitney(df, "x", "g", "g2", "hot"))
    assert turned["z"] == pytest.approx(-z) and turned["p_value"] == pytest.approx(got["p_value"])


def test_rank_tests_without_meaning(spark):
    def frame(rows):
        return spark.createDataFrame(rows, "g string, x string")

    empty = one(kruskal_wallis(frame([]), "x", "g"))
    assert empty["n"] == empty["n_groups"] == empty["df"] == 0 and empty["h"] is None and empty["p_value"] is None
    single = one(kruskal_wallis(frame([("a", "1"), ("a", "2")]), "x", "g"))
    assert single["h"] is None and single["p_value"] is None
    equal = frame([("a", "1"), ("b", "1"), ("b", "1.0"), ("b", "word"), ("c", None)])
    got = one(kruskal_wallis(equal, "x", "g"))
    assert (got["n"], got["n_groups"], got["h"]) == (3, 2, None)
    got = one(mann_whitney(equal, "x", "g", "a", "b"))
    assert (got["n_first"], got["n_second"], got["u"], got["z"], got["p_value"]) == (1, 2, 1.0, None, None)
    got = one(mann_whitney(equal, "x", "g", "a", "missing"))
    assert (got["n_first"], got["n_second"], got["u"], got["p_value"]) == (1, 0, None, None)


@pytest.mark.parametrize("seed", range(3))
def test_chi_square_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("aaaab"[: 2 + seed] + "xy"), rng.choice([1, 1, 1, 2, 3, 50])) for _ in range([40, 400, 4000][seed])]
    rows += [("rare", 1)]
    got = one(chi_square(spark.createDataFrame(rows + [(None, 1), ("a", None)], "a string, b int"), "a", "b"))
    n, cells = len(rows), Counter(rows)
    of_a, of_b = Counter(a for a, _ in rows), Counter(b for _, b in rows)
    want = {(a, b): of_a[a] * of_b[b] / n for a in of_a for b in of_b}
    chi = sum((cells[c] - e) ** 2 / e for c, e in want.items())
    df = (len(of_a) - 1) * (len(of_b) - 1)
    assert (got["n"], got["n_first"], got["n_second"], got["df"]) == (n, len(of_a), len(of_b), df)
    assert got["chi_square"] == pytest.approx(chi) and got["p_value"] == pytest.approx(tail(chi, df), abs=1e-9)
    assert got["cramers_v"] == pytest.approx(math.sqrt(chi / n / (min(len(of_a), len(of_b)) - 1)))
    assert got["least_expected"] == pytest.approx(min(want.values())) and got["low_expected"] is True
    assert got["low_cells"] == sum(want[c] < 5 for c in cells)


def test_chi_square_edges(spark):
    def run(rows):
        return one(chi_square(spark.createDataFrame(rows, "a string, b string"), "a", "b"))

    nothing = run([])
    assert nothing["n"] == nothing["n_first"] == 0 and nothing["chi_square"] is None and nothing["low_expected"] is None
    assert run([("a", "x"), ("a", "y")])["p_value"] is None  # one value on a side
    same = run([("a", "x"), ("b", "y")] * 50)
    assert same["cramers_v"] == 1.0 and same["chi_square"] == 100.0 and same["low_expected"] is False
    apart = run([(a, b) for a in "ab" for b in "xyz"] * 30)
    assert apart["chi_square"] == 0.0 and apart["p_value"] == 1.0 and apart["cramers_v"] == 0.0


def test_plans_form_no_pairs(spark):
    df = spark.createDataFrame([("a", "x", 1.0)], "a string, b string, x double")
    for test in (chi_square(df, "a", "b"), kruskal_wallis(df, "x", "a"), mann_whitney(df, "x", "a", "a", "b")):
        text = df._sc._jvm.PythonSQLUtils.explainString(test._jdf.queryExecution(), "simple")
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
