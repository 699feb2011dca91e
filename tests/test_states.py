"""States of parts, merged, against one pass over all rows."""

import bisect
import random
import statistics

import pytest

from postmill.operators.states import merge_states, profile_states, read_states


def profiles(df):
    return {r["column"]: r for r in read_states(df, [0.1, 0.5, 0.9]).collect()}


def test_merged_days_equal_one_pass(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice(["mon", "tue", None]), 1e9 + rng.gauss(0, 1), f"n{rng.randrange(900)}", rng.choice([None, "", "7", "x"])) for _ in range(6000)]
    df = spark.createDataFrame(rows, "day string, v double, name string, odd string").repartition(6)
    columns = ["v", "name", "odd"]
    profile_states(df, columns, ["day"]).write.parquet(str(tmp_path / "states"))
    states = spark.read.parquet(str(tmp_path / "states"))
    assert states.count() == 9
    whole, merged = profiles(profile_states(df, columns)), profiles(merge_states(states))
    twice = profiles(merge_states(merge_states(states, ["day"]).drop("day")))
    values = sorted(r[1] for r in rows)
    for got in (whole, merged, twice):
        assert set(got) == set(columns)
        v = got["v"]
        assert (v.rows, v.missing, v.least, v.most) == (6000, 0, values[0], values[-1])
        assert v["mean"] == pytest.approx(statistics.fmean(values), abs=1e-6) and v["std"] == pytest.approx(statistics.stdev(values), rel=1e-6)
        for p, q in zip([0.1, 0.5, 0.9], v.approx_quantiles):
            assert abs(bisect.bisect(values, q) / 6000 - p) < 0.03
        assert abs(v.approx_distinct / 6000 - 1) < 0.06
        names = len({r[2] for r in rows})
        assert abs(got["name"].approx_distinct / names - 1) < 0.06
        assert (got["name"]["mean"], got["name"]["std"], got["name"].approx_quantiles) == (None, None, None)
        odd = got["odd"]
        assert odd.missing == sum(r[3] is None for r in rows) and odd.approx_distinct == 3
        assert (odd["mean"], odd["std"], odd.least, odd.approx_quantiles) == (7.0, 0.0, 7.0, [7.0, 7.0, 7.0])
    by_day = {(r.day, r["column"]): r.rows for r in merge_states(states, ["day"]).collect()}
    assert by_day[(None, "v")] == sum(r[0] is None for r in rows)  # NULL is a part of its own


def test_states_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert profile_states(empty, ["v"]).collect() == [] and merge_states(profile_states(empty, ["v"])).collect() == []
    nulls = read_states(merge_states(profile_states(spark.createDataFrame([(None,), (None,)], "v double"), ["v"]))).collect()
    assert [(r.rows, r.missing, r["mean"], r["std"], r.approx_distinct, r.approx_quantiles) for r in nulls] == [(2, 2, None, None, 0, None)]
