"""Kendall's tau-b against all pairs of rows."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest

from postmill.operators.concordance import _sweep, kendall


def brute(rows):
    n, con, dis = len(rows), 0, 0
    for i, (x, y) in enumerate(rows):
        for u, v in rows[:i]:
            side = (x > u) - (x < u), (y > v) - (y < v)
            con += side[0] * side[1] > 0
            dis += side[0] * side[1] < 0
    tx, ty = Counter(x for x, _ in rows).values(), Counter(y for _, y in rows).values()
    pairs = n * (n - 1) / 2
    tau = (con - dis) / math.sqrt((pairs - sum(t * (t - 1) / 2 for t in tx)) * (pairs - sum(t * (t - 1) / 2 for t in ty)))
    five = lambda ts: sum(t * (t - 1) * (2 * t + 5) for t in ts)
    two = lambda ts: sum(t * (t - 1) for t in ts)
    three = lambda ts: sum(t * (t - 1) * (t - 2) for t in ts)
    var = (n * (n - 1) * (2 * n + 5) - five(tx) - five(ty)) / 18 + two(tx) * two(ty) / (2 * n * (n - 1))
    var += three(tx) * three(ty) / (9 * n * (n - 1) * (n - 2))
    return con, dis, tau, (con - dis) / math.sqrt(var)


def samples(kind):
    rng = random.Random(kind)
    if kind == "alike":  # close to one line, so that rows crowd the diagonal
        return [(x, x + rng.gauss(0, 0.05)) for x in (rng.random() for _ in range(900))]
    if kind == "ties":  # a hot x, a hot y, repeated rows
        return [(rng.choice([0.0, -0.0, 0.0, 1.5, 2.0, 7.0]), float(rng.choice([3, 3, 3, 1, 2, 9]))) for _ in range(900)]
    if kind == "hot":  # one x holds a third of all rows, with all y different
        return [(5.0 if i % 3 == 0 else rng.random() * 10, rng.random()) for i in range(900)]
    return [(-x, x) for x in (float(i) for i in range(300))]


@pytest.mark.parametrize("kind, bits", [("alike", 10), ("alike", 2), ("ties", 10), ("ties", 1), ("hot", 3), ("reverse", 2)])
def test_kendall_equals_all_pairs(spark, kind, bits):
    rows = samples(kind)
    noise = [(None, 1.0), (1.0, None), (float("nan"), 1.0)]
    got = kendall(spark.createDataFrame(rows + noise, "x double, y double").repartition(5), "x", "y", bits).collect()
    assert len(got) == 1
    con, dis, tau, z = brute(rows)
    assert (got[0].n, got[0].concordant, got[0].discordant) == (len(rows), con, dis)
    assert got[0].tau_b == pytest.approx(tau) and got[0].z == pytest.approx(z)
    assert got[0].p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-9)


def test_kendall_without_meaning(spark):
    def run(rows):
        got = kendall(spark.createDataFrame(rows, "x string, y string"), "x", "y").collect()
        assert len(got) == 1
        return tuple(got[0])

    assert run([]) == (0, 0, 0, None, None, None)
    assert run([("1", "2")]) == (1, 0, 0, None, None, None)
    assert run([("1", "2"), ("1", "3"), ("word", "4")]) == (2, 0, 0, None, None, None)
    assert run([("1", "2"), ("2", "3")])[:4] == (2, 1, 0, 1.0)


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_sweep_does_not_depend_on_batches(size):
    rng = random.Random(size)
    rows = sorted((0, 0, rng.randrange(2), rng.randrange(2), float(rng.randrange(6)), rng.randrange(8), rng.choice([1, 2, 10**12]))
                  for _ in range(200))
    want = sum(a[6] * b[6] for a in rows for b in rows if a[:4] == b[:4] and a[4] < b[4] and a[5] > b[5])
    types = [pa.int64()] * 4 + [pa.float64()] + [pa.int64()] * 2
    batches = [
        pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[i : i + size]), types)], names=list("abcdefg"))
        for i in range(0, len(rows), size)
    ]
    assert sum(int(v) for b in _sweep(3)(iter(batches)) for v in b.column(0).to_pylist()) == want


def test_plan_forms_no_pairs(spark):
    out = kendall(spark.createDataFrame([(1.0, 2.0)], "x double, y double"), "x", "y")
    text = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
